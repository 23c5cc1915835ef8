import pathlib

import pytest

import corpus_pipeline as P
from folioweave.llm import catalogue, chosen_path, decontaminate

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(DATA).exists(), reason="no test tables")


def test_stages_take_effect_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    held = [docs]
    for _, stage in P.STAGES[:-1]:
        docs = P.stored(stage(spark, docs, DATA))
        assert docs.columns == held[0].columns
        held.append(docs)
    counts = [d.count() for d in held]
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.5 * counts[0]
    items = spark.read.parquet(f"{DATA}/benchmark.parquet")
    assert decontaminate.find(held[-1], items).count() == 0
    classes = chosen_path.join(held[3])
    assert classes.where("doc_id <> class_id").count() == 0
    ran = {r["doc_id"] for r in P.run(spark, DATA).select("doc_id").collect()}
    assert ran == {r["doc_id"] for r in held[-1].select("doc_id").collect()}


def test_line_stage_and_quality_stage_alone(spark):
    docs = spark.createDataFrame([(1, "a\nb\nc", "en", "s", 5), (2, "a\nb\nc", "en", "s", 5), (3, None, "en", "s", 0)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    assert {r["doc_id"] for r in P.drop_repeated_lines(spark, docs, DATA).collect()} == {1, 3}
    assert P.keep_good(spark, docs.limit(0), DATA).count() == 0


def test_catalogue_names_one_query_of_each_operator():
    names = [n for n in catalogue.QUERIES if n != "pipeline"]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(catalogue.ORACLES) <= set(catalogue.QUERIES)
