import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from folioweave.operators import evaluation, sets, vector_search as VS


def vectors(spark, matrix, ids=None):
    rows = [(str(i) if ids is None else ids[i], [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, "id string, embedding array<float>").repartition(5)


def test_nearest_equals_brute_force_with_ties(spark):
    pick = np.random.default_rng(1)
    matrix = pick.integers(-2, 3, size=(400, 3)).astype("float32")
    table = vectors(spark, matrix)
    question = [1.0, 0.5, -1.0]
    q = np.array(question)
    matrix = matrix.astype("float64")
    norms = np.linalg.norm(matrix, axis=1)
    scored = [(-(matrix[i] @ q) / norms[i] / np.linalg.norm(q), str(i)) for i in range(400) if norms[i] > 0]
    found = VS.nearest(table, question, 17).collect()
    exact = [(round(-s, 9), i) for s, i in scored]
    best = sorted(exact, key=lambda p: (-p[0], p[1]))[:17]
    assert [(round(r["similarity"], 9), r["id"]) for r in found] == best


def test_questions_in_blocks_agree(spark, monkeypatch):
    pick = np.random.default_rng(2)
    table = vectors(spark, pick.normal(size=(200, 4)))
    questions = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(pick.normal(size=(9, 4)))],
                                      "question_id long, embedding array<float>")
    one = sorted(map(tuple, VS.nearest_each(table, questions, 3).select("question_id", "id", "rank").collect()))
    monkeypatch.setattr(VS, "QUESTIONS_PER_BLOCK", 4)
    monkeypatch.setattr(VS, "VECTORS_PER_BLOCK", 7)
    assert one == sorted(map(tuple, VS.nearest_each(table, questions, 3).select("question_id", "id", "rank").collect()))
    assert len(one) == 27


def test_zero_vectors_dimensions_and_bounds(spark):
    table = vectors(spark, [[0, 0], [1, 0], [0, 2]])
    assert [r["id"] for r in VS.nearest(table, [1.0, 0.1], 5).collect()] == ["1", "2"]
    assert VS.nearest(table, [0.0, 0.0], 5).count() == 0
    with pytest.raises(Exception, match="dimension"):
        VS.nearest(table, [1.0], 1).collect()
    for name, bad in (("k", 0), ("k", 21), ("limit", 501), ("offset", -1), ("n", True)):
        with pytest.raises(ValueError):
            VS.check_bound(name, bad)
    own = table.select("id", VS.cosine(F.col("embedding"), F.array(F.lit(3.0), F.lit(4.0))).alias("c"))
    assert {r["id"]: r["c"] and round(r["c"], 9) for r in own.collect()} == {"0": None, "1": 0.6, "2": 0.8}


def test_no_pairs_and_no_cross_join_in_the_plan(spark):
    table = vectors(spark, np.eye(4)).withColumn("paper_id", F.col("id"))
    papers = table.select("paper_id", "embedding")
    plan = VS.two_stage(papers, table, [1.0, 0, 0, 0], 2, 2)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "TakeOrderedAndProject" in plan


def test_phrases_both_ways_equal_brute_force(spark):
    pick = np.random.default_rng(4)
    words = ["alpha", "beta", "gamma", "a", "bé", "x-y"]
    texts = [(i, " ".join(pick.choice(words, size=30))) for i in range(60)] + [(60, ""), (61, "a"), (62, "ab")]
    phrases = [texts[i % 60][1][s:s + n] for i, (s, n) in enumerate(
        [(0, 60), (3, 50), (5, 20), (10, 5), (0, 1), (4, 2), (7, 3), (2, 80), (0, 12)])] + ["zz", "alpha beta"]
    frame = spark.createDataFrame(texts, "doc long, text string")
    wanted = spark.createDataFrame(list(enumerate(phrases)), "phrase_id long, phrase string")
    truth = sorted((p, d) for p, phrase in enumerate(phrases) for d, text in texts if phrase in text)
    for limit in (10 ** 6, 3):
        rows = evaluation.find_phrases(frame, wanted, "doc", limit).select("phrase_id", "doc").collect()
        assert sorted(map(tuple, rows)) == truth


def test_phrases_of_odd_rows(spark):
    long = "x" * 5_000_000 + "needle in the very long text" + "y" * 100
    rows = [(1, long), (2, None), (3, ""), (None, "needle"), (4, "needle"), (4, "no"), (4, "needle too")] + [
        (i, "common run of many texts " + str(i % 2)) for i in range(10, 60)]
    wanted = [(1, "needle"), (2, ""), (3, None), (4, "needle in the very long text"), (5, "common run of many texts 1"),
              (6, "common run of many texts 2"), (7, "needle")]
    frame = spark.createDataFrame(rows, "doc long, text string")
    asked = spark.createDataFrame(wanted, "phrase_id long, phrase string")
    got = {(p, d) for p, d in evaluation.find_phrases(frame, asked, "doc").select("phrase_id", "doc").collect()}
    assert got == {(p, d) for p, x in wanted if x for d, t in rows if t and x in t}
    none = evaluation.find_phrases(frame, asked.limit(0), "doc")
    assert none.columns == ["phrase_id", "doc"] and none.count() == 0
    assert evaluation.find_phrases(frame.limit(0), asked, "doc").count() == 0


def test_scores(spark):
    hits = spark.createDataFrame([("q1", 1, "p", 1, "xx needle yy"), ("q1", 2, "p", 1, "needle again"),
                                  ("q2", 1, "p", 1, "nothing"), ("q3", 1, "p", 1, "x")],
                                 "question_id string, rank long, paper_id string, page_number long, text string")
    evidence = spark.createDataFrame([("q1", "p", 1, "needle"), ("q1", "p", 2, "other"), ("q2", "p", 1, "hay")],
                                     "question_id string, paper_id string, page long, text string")
    questions = hits.select("question_id").distinct()
    scores = {r["question_id"]: r for r in evaluation.per_question(questions, hits, evidence).collect()}
    assert (scores["q1"]["recall"], scores["q1"]["reciprocal_rank"]) == (0.5, 1.0)
    assert (scores["q2"]["recall"], scores["q2"]["reciprocal_rank"]) == (0.0, 0.0)
    assert scores["q3"]["recall"] is None
    total = evaluation.summary(spark.createDataFrame(list(scores.values()))).head()
    assert (total["labelled_questions"], total["unlabelled_questions"], total["mean_recall"]) == (2, 1, 0.25)


def test_latency_equals_numpy(spark):
    values = np.random.default_rng(6).exponential(size=999).round(3)
    rows = spark.createDataFrame([("warm", float(v)) for v in values] + [("cold", 1.0)], "state string, seconds double")
    found = {r["state"]: r.asDict() for r in evaluation.latency(rows).collect()}
    assert found["warm"]["p50"] == pytest.approx(np.percentile(values, 50))
    assert found["warm"]["p95"] == pytest.approx(np.percentile(values, 95))
    assert found["cold"] == {"state": "cold", "trials": 1, "p50": 1.0, "p95": 1.0}


def test_latency_of_odd_timings(spark):
    rows = spark.createDataFrame([(None, 1.0), (None, 3.0), ("warm", float("inf")), ("warm", float("nan")),
                                  ("warm", None), ("warm", 2.0)], "state string, seconds double")
    found = {r["state"]: r.asDict() for r in evaluation.latency(rows).collect()}
    assert found[None]["p50"] == 2.0 and found[None]["trials"] == 2
    assert found["warm"]["trials"] == 1 and found["warm"]["p95"] == 2.0


def test_sets(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), ("b", 2)], "id string, v int")
    right = spark.createDataFrame([("b", 2), ("c", 3)], "id string, v int")
    assert sorted(map(tuple, sets.id_coverage(left, right, "id").collect())) == [
        ("a", "left_only"), ("b", "shared"), ("c", "right_only")]
    assert sorted(r["surplus"] for r in sets.row_differences(left, right).collect()) == [-1, 1, 1]
    acts = sets.reconcile(left.distinct().unionByName(spark.createDataFrame([("c", 4)], "id string, v int")), right, "id")
    assert dict(map(tuple, acts.collect())) == {"a": "new", "b": "unchanged", "c": "changed"}
    assert dict(map(tuple, sets.reconcile(right, left.distinct(), "id").collect()))["a"] == "stale"


def test_letters_are_counted_in_batches_as_one_by_one(spark):
    from pyspark.sql import functions as F
    from folioweave.functions import embedding
    texts = [None, "", "aAzZ K\u212a \u00e9\u0130`{" * 7, "zz" * 900_000, None, "b", "q" * embedding._COUNTED]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)
    low = F.lower("t")
    plain = F.array(*[(F.length(low) - F.length(F.replace(low, F.lit(x), F.lit("")))).cast("float")
                      for x in "abcdefghijklmnopqrstuvwxyz"])
    vector = embedding.LetterEmbedder().vector(F.col("t"))
    both = rows.select(plain.alias("one"), vector.alias("batch"))
    assert both.where("NOT one <=> batch").count() == 0 and both.count() == len(texts)
    plan = rows.select(vector.alias("batch"))._jdf.queryExecution().executedPlan().toString()
    assert "replace(" not in plan               # 26 passes over every text before
    assert embedding._counted(pa.array([None, "ab", "b", None])[1:3]).to_pylist() == [
        [1.0, 1.0] + [0.0] * 24, [0.0, 1.0] + [0.0] * 24]
    assert embedding._counted(pa.array([], pa.string())).to_pylist() == []
