import random

from pyspark.sql import functions as F

from folioweave.llm import chosen_path as C
from folioweave.llm.graph import components

from cases import clashing, documents, prose


def brute(rows):
    sets = {}
    for n, (i, t) in enumerate(rows):
        w = (t or "").split()
        sets[n] = frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else None
    distinct = sorted({s for s in sets.values() if s}, key=repr)
    parent = list(range(len(distinct)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(distinct)
    for a in range(len(distinct)):
        for b in range(a):
            both = len(distinct[a] & distinct[b])
            if both >= 0.8 * (len(distinct[a]) + len(distinct[b]) - both) - 1e-9:
                links[a] += 1
                links[b] += 1
                parent[root(a)] = root(b)
    place = {s: k for k, s in enumerate(distinct)}
    out = []
    for n, (i, _) in enumerate(rows):
        if sets[n] is None:
            out.append((i, i, 0, 1))
            continue
        mine = root(place[sets[n]])
        members = [rows[m][0] for m in sets if sets[m] and root(place[sets[m]]) == mine]
        out.append((i, min((m for m in members if m is not None), default=None), links[place[sets[n]]], len(members)))
    return sorted(out, key=repr)


def joined(rows):
    return sorted(((r["doc_id"], r["class_id"], r["n_links"], r["class_size"]) for r in C.join(rows).collect()), key=repr)


def edited(rng, text, share):
    w = text.split()
    for _ in range(int(len(w) * share)):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 6)}"
    return " ".join(w)


def corpus(seed):
    rng = random.Random(seed)
    base = prose(seed, 25, 60, 200, 5000)
    shared = " ".join(prose(seed + 1, 1, 50, 51, 5000))
    out = [*base, None, "", " \n", "one two", "one two", "one two three four five"]
    for t in base[:10]:
        out += [edited(rng, t, s) for s in (0, 0.01, 0.02, 0.03, 0.05)]
    out += [shared + " " + t for t in prose(seed + 2, 20, 60, 100, 5000)]
    return out


def test_against_brute_force(spark):
    texts = corpus(21)
    ids = [*range(len(texts) - 2), None, 3]
    rows = clashing(documents(spark, texts, ids))
    assert joined(rows) == brute(list(zip(ids, texts)))


def test_large_groups_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(C, "LEAF", 8)
    rng = random.Random(5)
    base = prose(31, 1, 300, 301, 5000)[0]
    texts = [edited(rng, base, 0.01) for _ in range(40)] + [base] * 30
    assert joined(documents(spark, texts)) == brute(list(enumerate(texts)))


def test_first_of_each_and_empty_table(spark):
    texts = corpus(41)[:40]
    rows = clashing(documents(spark, texts + [None], [*range(40), None]))
    kept = C.first_of_each(rows)
    assert kept.columns == rows.columns
    want = {i for i, c, *_ in brute([*enumerate(texts), (None, None)]) if i == c}
    assert {r["doc_id"] for r in kept.collect()} == want
    assert C.join(documents(spark, [])).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 30)] + [(5, 5)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{100 + i: 100 for i in range(1, 30)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def kept(spark, texts, ids):
    return sorted(((r["doc_id"], r["text"]) for r in C.first_of_each(
        clashing(documents(spark, texts, ids)).withColumn("nth", F.lit(1))).collect()), key=str)


def test_one_row_of_each_class_stays_with_null_and_repeated_ids(spark):
    a, b, c, d = prose(21, 4, 30, 40)
    near = a + " end"                                     # one shingle more: same class as a
    # a null id that copies document 5 takes only itself along
    assert kept(spark, [a, a, b, c, None], [5, None, None, None, None]) == sorted(
        [(5, a), (None, b), (None, c), (None, None)], key=str)
    # repeated ids of different texts: every class keeps one
    assert kept(spark, [c, c, a, a], [1, 3, 3, 7]) == sorted([(1, c), (3, a)], key=str)
    # copies that share an id, and copies whose ids are all null
    assert kept(spark, [a, a, a, b, b, c], [4, 4, 4, None, None, 6]) == sorted(
        [(4, a), (None, b), (6, c)], key=str)
    # near copies under one id, under null ids, and wordless rows, which all stay
    got = kept(spark, [a, near, d, d + " end", "", "", " "], [2, 2, None, None, None, 8, 8])
    assert len(got) == 5 and sum(t in (a, near) for _, t in got) == 1
    assert sum(t in (d, d + " end") for _, t in got) == 1
