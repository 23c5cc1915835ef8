"""Every registered query beside its SQL, over the whole small tables."""

import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1] / "tools"))
compare = pytest.importorskip("compare")

from folioweave.plans.catalogue import ORACLES, QUERIES  # noqa: E402

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(DATA).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return compare.duck(DATA)


# SQL has no subword tokenizer; that query is held against the plain rule in test_chunking.
WITHOUT_SQL = {"subword_chunks"}


def test_every_query_has_sql():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, connection, name):
    fine, note = compare.compare(spark, connection, DATA, name)
    assert fine, note
