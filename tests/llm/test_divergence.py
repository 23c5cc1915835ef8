from collections import Counter
import random
import re

import pyarrow as pa
from pyspark.sql import functions as F
import pytest

from folioweave.llm import divergence as D

from cases import clashing

TERM = re.compile(D.TERM)
SCHEMA = "doc_id long, text string, lang string, source string"


def by_force(rows, min_documents=D.MIN_DOCUMENTS, top=D.TOP):
    """All rows of the audit with whole integers."""
    rows = [(t or "", lang or "", source or "") for _, t, lang, source in rows]
    out = set()
    for lang in {r[1] for r in rows}:
        own = [(Counter(w.translate({u: u + 32 for u in range(65, 91)}) for w in TERM.findall(t)), s)
               for t, g, s in rows if g == lang]
        df = Counter(w for c, _ in own for w in c)
        kept = [w for w, n in df.items() if n >= min_documents]
        sums = {s: Counter() for _, s in own}
        for c, s in own:
            sums[s].update({w: c[w] for w in kept if w in c})
        whole = sum(sums.values(), Counter())

        def shares(counts):
            total = sum(counts.values()) + 2 * len(kept)
            return {w: 1 + 10**9 * (counts[w] + 2) // total for w in kept}

        p, q = {s: shares(c) for s, c in sums.items()}, shares(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sums:
            pairs = [(sum(f(p[s][w], p[o][w]) for w in kept), o) for o in sums if o != s]
            words = [(f(p[s][w], q[w]), w) for w in kept if sums[s][w] and p[s][w] > q[w]]
            for part, found, limit in (("pair", pairs, None), ("term", words, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, v, i + 1) for i, (v, item) in enumerate(found[:limit])}
    return out


def corpus(seed=2, count=160):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdeÉéfgh" for b in ("", "x", "yz", "Q")]
    rows = []
    for i in range(count):
        lang = rng.choice(["en", "en", "de", None])
        source = rng.choice(["one", "two", "three", "", None])
        low = {"one": 0, "two": 10}.get(source, 5)
        rows.append((rng.choice([i, None, 3]), rng.choice(
            [None, "", " ".join(rng.choice(words[low:low + 30]) for _ in range(rng.randrange(1, 60)))] + [
                " ".join(rng.choice(words[low:low + 30]) for _ in range(30))] * 6), lang, source))
    return rows + [(900, "alone in its language", "fr", "one"), (901, None, "fr", "two")]


def audited(spark, rows, **options):
    docs = clashing(spark.createDataFrame(rows, SCHEMA))
    got = D.audit(docs, **options).collect()
    assert len(got) == len(set(got))
    return {tuple(r[n] for n in ("lang", "source", "part", "item", "value", "rank")) for r in got}


@pytest.mark.parametrize("options", [{}, {"slice_terms": 7, "range_terms": 3}])
def test_equals_brute_force(spark, monkeypatch, options):
    if options:
        monkeypatch.setattr(D, "SOURCE_BLOCK", 2)          # several blocks of sources
    rows = corpus()
    assert audited(spark, rows, **options) == by_force(rows)


def test_no_kept_word_and_no_rows(spark):
    rows = [(1, "few words", "en", "a"), (2, "few words", "en", "b"), (3, None, None, None)]
    assert audited(spark, rows) == by_force(rows)
    assert {r[4] for r in by_force(rows)} == {0}
    assert audited(spark, []) == set()


def test_document_vectors_are_exact(spark, tmp_path):
    rows = [(i, t, "en", "s") for i, t in enumerate(["b a b", "B a", "c a a a", None, ""])]
    docs = D.read_groups(spark.createDataFrame(rows, SCHEMA))
    vectors, vocabulary = D.document_vectors(docs, str(tmp_path), min_documents=2)
    names = {(r["slice"], r["index"]): r["term"] for r in vocabulary.collect()}
    got = {r["doc_id"]: {names[r["slice"], i]: v for i, v in zip(r["indices"], r["counts"])}
           for r in vectors.collect()}
    assert got == {0: {"a": 1, "b": 2}, 1: {"a": 1, "b": 1}, 2: {"a": 3}}


def test_shares_do_not_overflow(spark):
    row = spark.sql("SELECT 4000000000000000 AS n, 9000000000000000 AS total, 5 AS v")
    assert row.select(D.share("n", "total")).head()[0] == 1 + 10**9 * (4 * 10**15 + 2) // (9 * 10**15 + 10)


@pytest.mark.parametrize("held", [1, 5, 4_000_000])
def test_a_task_adds_its_batches_up(monkeypatch, held):
    rng = random.Random(9)
    monkeypatch.setattr(D, "HELD", held)
    want, batches = Counter(), []
    for _ in range(6):
        rows = [(rng.choice(["en", "de", ""]), rng.choice(["one", ""]), rng.randrange(2),
                 rng.sample(range(6), rng.randrange(5))) for _ in range(rng.randrange(8))]
        counts = [[rng.randrange(1, 9) for _ in r[3]] for r in rows]
        for (lang, source, piece, indices), own in zip(rows, counts):
            for i, n in zip(indices, own):
                want[lang, source, piece, i] += n
        kinds = {"lang": pa.string(), "source": pa.string(), "slice": pa.int32(), "indices": pa.list_(pa.int32())}
        batches.append(pa.RecordBatch.from_arrays(
            [*(pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds.values())),
             pa.array(counts, pa.list_(pa.int32()))], [*kinds, "counts"]))
    got, out = Counter(), list(D._added(iter(batches)))
    for batch in out:
        for r in batch.to_pylist():
            got[r["lang"], r["source"], r["slice"], r["index"]] += r["value"]
    assert got == want
    if held > 100:
        assert [b.num_rows for b in out] == [len(want)]
    assert not list(D._added(iter([])))
