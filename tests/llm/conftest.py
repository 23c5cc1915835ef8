import pytest


@pytest.fixture(scope="session", autouse=True)
def work_folder(spark, tmp_path_factory):
    """The shared folder of a one-process session."""
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("work")))
