import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from folioweave.llm import quality as Q

from cases import clashing, documents, prose


def table_of(spark, n=240):
    rng = random.Random(4)
    good = prose(5, n, 30, 90)
    bad = [" ".join(w + "$$$" for w in t.split()) if rng.random() < 0.5 else " ".join([t.split()[0]] * 40)
           for t in prose(6, n, 30, 90)]
    texts = [x for pair in zip(good, bad) for x in pair]
    labels = [(i, 1 - i % 2) for i in range(len(texts))]
    return documents(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int")


def test_held_out_accuracy_and_whole_range(spark):
    docs, labels = table_of(spark)
    model = Q.fit(clashing(docs), labels)
    got = docs.select("doc_id", Q.score_column(model, F.col("text")).alias("score")).collect()
    held = [r for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    right = [(r["score"] >= 0.5) == (r["doc_id"] % 2 == 0) for r in held]
    assert len(held) > 100 and np.mean(right) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_labels_of_the_held_out_fold_are_never_read(spark):
    docs, labels = table_of(spark, 60)
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    twisted = labels.withColumn("quality", F.when(part == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = Q.fit(docs, labels), Q.fit(docs, twisted)
    assert np.allclose(one.weights, two.weights) and np.allclose(one.probability, two.probability)


def test_nulls_empties_and_no_labels(spark):
    docs = documents(spark, [None, "", "some text", "some text"], [None, 1, 2, 2])
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    model = Q.fit(docs, none)
    got = [r[0] for r in docs.select(Q.score_column(model, F.col("text"))).collect()]
    assert got == [0.5] * 4
    assert Q.fit(documents(spark, []), none).probability.tolist() == [0.5]
    real, labels = table_of(spark, 60)
    odd = labels.unionAll(spark.createDataFrame([(None, 1), (3, None)], labels.schema)).unionAll(labels)
    scored = documents(spark, ["", None, ""]).select(Q.score_column(Q.fit(real, odd), F.col("text")).alias("s"))
    assert len({r["s"] for r in scored.collect()}) == 1


def test_statistics_do_not_depend_on_neighbours():
    texts = [*prose(8, 6), "", "A b. Ç", None, "x" * 5000]
    whole = Q.text_statistics(pa.array(texts))
    for t, row in zip(texts, whole):
        assert np.allclose(Q.text_statistics(pa.array([t], pa.string()))[0], row)


def test_pool_adjacent_is_isotonic_and_keeps_the_mean():
    rng = np.random.default_rng(3)
    n = rng.integers(1, 9, 50)
    good = rng.binomial(n, np.linspace(0.1, 0.9, 50))
    at, probability = Q.pool_adjacent(np.arange(50.0), good, n)
    assert (np.diff(probability) > 0).all() and (np.diff(at) > 0).all()
