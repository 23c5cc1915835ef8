import numpy as np

from folioweave.llm import vector_lsh as V

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0)
                                  for i, v in rows], SCHEMA)


def brute(rows, k=20):
    use = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
           if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for q, x in use:
        if q % 20 == 0:
            near = sorted(((-float((x * y).sum()), i) for i, y in use if i != q))[:k]
            out[q] = [i for _, i in near]
    return out


def test_recall_ranks_and_scores(spark):
    x = np.random.default_rng(1).normal(size=(1500, 16)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = V.search(vectors(spark, rows), lambda i: i % 20 == 0).collect()
    want = brute(rows)
    found = {}
    for r in got:
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    recall = np.mean([len(set(want[q]) & {v for _, v, _ in found[q]}) / 20 for q in want])
    assert recall >= 0.9
    for q, hits in found.items():
        hits.sort()
        assert [h[0] for h in hits] == list(range(1, 21))
        assert [(-h[2], h[1]) for h in hits] == sorted((-h[2], h[1]) for h in hits)
        assert all(abs(h[2] - float((x[q].astype(float) * x[h[1]].astype(float)).sum())) < 1e-12 for h in hits)


def test_odd_vectors_and_ties(spark):
    same = [1.0, 0.5, 0.0]
    rows = [(0, same), *[(i, same) for i in range(1, 40)], (100, None), (120, []), (140, [0.0, 0.0, 0.0]),
            (160, [1.0, None, 0.0]), (180, [float("nan"), 1, 1]), (200, [float("inf"), 1, 1]), (None, same),
            (220, [1.0, 2.0])]
    got = V.search(vectors(spark, rows), lambda i: i % 20 == 0).collect()
    by = {q: [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] for q in (0, 20)}
    assert by[0] == list(range(1, 21)) and by[20] == list(range(20))
    assert {r["query_id"] for r in got} == {0, 20}


def test_few_candidates_and_none(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.9, 0.1])]
    got = V.search(vectors(spark, rows), lambda i: i % 20 == 0).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [(0, 1, 1)]
    assert V.search(vectors(spark, []), lambda i: i % 20 == 0).count() == 0


def compared(spark, rows):
    """Smallest share of due rows that a query got, and the recall over all queries."""
    want = brute(rows)
    found = {}
    for r in V.search(vectors(spark, rows), lambda i: i % 20 == 0).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    full = min(len(found.get(q, ())) / len(want[q]) for q in want)
    return full, np.mean([len(set(want[q]) & found.get(q, set())) / len(want[q]) for q in want])


def spread(n, dim=64, seed=2):
    x = np.random.default_rng(seed).normal(size=(n, dim))
    return (x / np.sqrt((x ** 2).sum(1))[:, None]).astype(np.float32)


def test_small_tables_of_spread_vectors_are_whole(spark):
    for n in (10, 15, 21, 40):
        rows = [(20 * i, v.tolist()) for i, v in enumerate(spread(n))]
        assert compared(spark, rows) == (1.0, 1.0)


def test_one_very_long_vector(spark):
    x = spread(2000)
    x[7] *= 100
    full, recall = compared(spark, [(i, v.tolist()) for i, v in enumerate(x)])
    assert full == 1.0 and recall >= 0.9


def test_an_id_of_many_rows_takes_one_place(spark):
    same = [1.0, 0.5, 0.0]
    rows = [(0, same), *[(1, same)] * 30, *[(2, [1.0, 0.5, i / 100]) for i in range(30)],
            *[(i, same) for i in range(3, 40)]]
    got = V.search(vectors(spark, rows), lambda i: i == 0).collect()
    assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"])] == list(range(1, 21))


def met_share(spark, rows):
    """Candidates that queries met and scored, as a share of all pairs; no pair is met twice."""
    frame = vectors(spark, rows)
    total = V.met_candidates(frame, lambda i: i % 20 == 0).agg({"met": "sum"}).head()[0]
    asked = sum(1 for i, _ in rows if i % 20 == 0)
    return total / (asked * (len(rows) - 1))


def test_clustered_vectors_meet_few_candidates(spark):
    random = np.random.default_rng(5)
    centres = spread(50, 32, 6) * 4
    x = (centres[random.integers(0, 50, 3000)] + random.normal(size=(3000, 32)) * 0.2).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    full, recall = compared(spark, rows)
    share = met_share(spark, rows)
    assert full == 1.0 and recall >= 0.9 and share < 0.5


def test_recall_with_norms_that_vary(spark):
    random = np.random.default_rng(7)
    for norms in (random.pareto(1.5, 1500) + 0.01, random.lognormal(0, 2, 1500), 10.0 ** -random.uniform(0, 9, 1500)):
        x = (spread(1500, 24, 8) * norms[:, None]).astype(np.float32)
        full, recall = compared(spark, [(i, v.tolist()) for i, v in enumerate(x)])
        assert full == 1.0 and recall >= 0.9


def test_each_pair_is_met_at_most_once(spark):
    rows = [(i, v.tolist()) for i, v in enumerate(spread(300, 8, 9))]
    found = V.met_candidates(vectors(spark, rows), lambda i: i % 20 == 0)
    pairs = found.where("vec_id IS NOT NULL").select("query_id", "vec_id")
    assert pairs.count() == pairs.distinct().count()
    assert met_share(spark, rows) <= 1.0


def test_small_blocks_give_the_same_rows(spark, monkeypatch):
    rows = [(i, v.tolist()) for i, v in enumerate(spread(400, 12, 10))]
    one = sorted(map(tuple, V.search(vectors(spark, rows), lambda i: i % 20 == 0).collect()))
    monkeypatch.setattr(V, "BLOCK", 16)
    monkeypatch.setattr(V, "QUERY_BLOCK", 5)
    assert one == sorted(map(tuple, V.search(vectors(spark, rows), lambda i: i % 20 == 0).collect()))
