"""Small document tables: nulls, empty and long texts, ties, repeated rows, clashing names."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = "id long, t string, row long, node long, start long, spans string, count long, rank long"


def documents(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", None, None) for i, t in zip(ids, texts)], SCHEMA)


def clashing(rows):
    """The rows with further columns whose names operators might use themselves."""
    from pyspark.sql import functions as F
    names = [(n.split()[0], n.split()[1]) for n in CLASHING.split(", ")]
    return rows.withColumns({n: F.lit(None).cast(k) for n, k in names})


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def prose(seed, count, low=20, high=80, vocabulary=400):
    rng = random.Random(seed)
    return [" ".join(words(rng, rng.randrange(low, high), vocabulary)) for _ in range(count)]
