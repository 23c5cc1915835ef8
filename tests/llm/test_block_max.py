from collections import Counter
import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from folioweave.llm import block_max as B

from cases import clashing, documents, prose

TERM = re.compile(B.TERM)


def terms(text):
    return [t.translate({u: u + 32 for u in range(65, 91)}) for t in TERM.findall(text or "")]


def by_force(texts, ids, items, k=B.K):
    """{item: [(doc_id, score)]}: every document scored whole."""
    each = [(i, Counter(terms(t))) for i, t in zip(ids, texts)]
    n_docs, all_terms = sum(bool(c) for _, c in each), sum(sum(c.values()) for _, c in each)
    df = Counter(t for _, c in each for t in c)
    out = {}
    for item, text in items:
        scored = []
        for i, c in each:
            n, score = sum(c.values()), 0
            for t in terms(text):
                if t in c:
                    m = 100 - 75 + (75 * n * n_docs) // all_terms
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((i, score))
        out[item] = sorted(scored, key=lambda x: (-x[1], x[0] is None, x[0]))[:k]
    return out


def ranked(spark, docs, items, tmp_path, only=True, shard_terms=400, k=B.K):
    asked = B.numbered(items, "item_id", "text")
    path = str(tmp_path / "index")
    n, _ = B.build_index(docs, path, B.item_terms(asked) if only else None, shard_terms=shard_terms)
    rows = B.search(spark, path, n, asked, k).join(asked.select("item", "item_id"), "item").collect()
    out = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        out.setdefault(r["item_id"], []).append((r["doc_id"], r["score"]))
    return out, rows


def test_packed_integers_come_back():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2**31, 2**40])
    data, at = B.pack(values)
    assert B.unpack(data).tolist() == values.tolist() and at[-1] == len(data)


def test_equals_brute_force_with_ties_over_many_shards(spark, tmp_path):
    texts = prose(3, 300, 5, 60, 150) + ["w1 w2 w3"] * 40 + ["w1", "W1", "É w1, ÉÉ-w2", None, "", "..."]
    ids = list(range(len(texts)))
    random.Random(5).shuffle(ids)
    items = [(j, t) for j, t in enumerate(prose(9, 12, 3, 20, 150))] + [
        (20, "w1 w1 w2"), (21, "nothing here"), (22, None), (23, ""), (24, "É ééé")]
    docs = clashing(documents(spark, texts, ids)).repartition(3)
    got, rows = ranked(spark, docs, spark.createDataFrame(items, "item_id long, text string"), tmp_path)
    wanted = {i: r for i, r in by_force(texts, ids, items).items() if r}
    assert got == wanted
    assert {r["rank"] for r in rows} == set(range(1, 11))


def test_an_index_of_every_term_gives_the_same(spark, tmp_path):
    texts = prose(4, 60, 5, 40, 80)
    items = spark.createDataFrame([(1, texts[5]), (2, "w1 w2")], "item_id long, text string")
    docs = documents(spark, texts)
    some, _ = ranked(spark, docs, items, tmp_path / "a")
    every, _ = ranked(spark, docs, items, tmp_path / "b", only=False)
    assert some == every
    assert spark.read.parquet(str(tmp_path / "b" / "index")).select("term").distinct().count() > 70


def test_repeated_and_null_ids_and_empty_tables(spark, tmp_path):
    items = spark.createDataFrame([(None, "w1 w2"), (1, "w1 w2"), (1, "w1 w2")], "item_id long, text string")
    docs = documents(spark, ["w1 w2", "w1 w2", "w1 w2", "w9 w8"], [7, None, 7, 1])
    got, rows = ranked(spark, docs, items, tmp_path / "a")
    assert [d for d, _ in got[None]] == [7, 7, None] and len(rows) == 9
    assert ranked(spark, documents(spark, []), items, tmp_path / "b")[0] == {}
    assert ranked(spark, docs, items.limit(0), tmp_path / "c")[0] == {}


def test_blocks_of_common_terms_stay_packed(spark, tmp_path):
    """A rare term decides; the lists of common words are rejected by bounds before unpacking."""
    rng = random.Random(8)
    texts = [" ".join(["common"] + [f"w{rng.randrange(50)}" for _ in range(rng.randrange(3, 9))]
                      + (["rare"] * 3 if i % 3 == 0 and i < 60 else [])) for i in range(8000)]
    items = spark.createDataFrame([(1, "rare common w1 w2")], "item_id long, text string")
    got, rows = ranked(spark, documents(spark, texts).coalesce(1), items, tmp_path, shard_terms=10**9)
    assert got == by_force(texts, range(8000), [(1, "rare common w1 w2")])
    assert rows[0]["unpacked"] <= 3 < 13 <= rows[0]["blocks"]


def test_one_long_text(spark, tmp_path):
    text = "w1 w2 " * 100_000
    got, _ = ranked(spark, documents(spark, [text, "w1"]), spark.createDataFrame(
        [(1, "w2 w1")], "item_id long, text string"), tmp_path)
    assert got == by_force([text, "w1"], [0, 1], [(1, "w2 w1")])
