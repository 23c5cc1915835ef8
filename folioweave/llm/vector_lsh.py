"""Nearest vectors by inner product: multiprobe p-stable hashing with exact reranking.

Largest inner product becomes smallest Euclidean distance by one more component. Candidates fall
into rings by norm (bounds M, M / STEP, M / STEP^2, ..); inside a ring of bound B a candidate becomes
(x, sqrt(B^2 - |x|^2)) / B and a query (q, 0) / |q|, both of length one. Each of ``TABLES`` hashes
has functions floor((a.x + b) / WIDTH) with Gaussian, hence 2-stable, a; their number grows with
the logarithm of the table.

A query visits the buckets of all tables in ascending order of the summed squared distances to
the walls it would cross, the usual estimate of success, up to a cut of its own for each ring. The
cut is not a number of buckets but follows from a target: projections of a neighbour with a given
inner product are Gaussian around the query's, so ``DRAWS`` fixed draws say where such a
neighbour is met first in any table. Round one takes a cut that meets a tenth of the neighbours of
cosine one half. Its k-th best score is a bound on the true one; round two takes, for every ring,
the cut at which a neighbour of just that score is met with probability ``TARGET``. A ring whose
bound excludes better scores is skipped; a query without k results visits all buckets.

Candidates lie once in each table under the first functions of their bucket (the route), and
large routes are split by a hash of the id. A query is sent only to routes within its cut. There
each pair is scored once, in the first table whose bucket the query visits; candidates of other
buckets are not scored. Each query keeps its best ``k`` of a block, with scores taken anew in one
fixed order of summation, and a grouped top-k merges blocks and rounds.

Defined results: vectors that are null, empty, zero, or have a null or non-finite component
take no part; vectors whose length differs from the most frequent one (ties: the smaller)
take no part; rows with a null id take no part; rows equal in id are merged (largest score
counts); ties go to the smaller id; with fewer than ``k`` candidates all are returned.
Further columns of the input are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from folioweave.llm.common import stored, table

K, TABLES, WIDTH, TARGET = 20, 4, 1.0, 0.95
START_SHARE, START_COSINE, DRAWS = 0.1, 0.5, 512
# A ring's bound exceeds its norms by at most STEP; the last ring holds all shorter vectors.
RINGS, STEP = 128, 2 ** 0.25
# Buckets of a function are numbered from -EDGE to EDGE - 1; the outermost are unbounded.
EDGE, _NIBBLE = 8, 4
BLOCK, QUERY_BLOCK, SEED = 16384, 4096, 9
_ROWS, _HELD = 512, 1 << 20


class Family:
    """The hash functions for vectors of ``dim`` components and a table of ``n`` rows."""

    def __init__(self, dim: int, n: int):
        random = np.random.default_rng(SEED)
        self.functions = max(4, round(math.log10(max(n, 1))))
        self.route = min(3, self.functions // 2)
        self.a = random.normal(size=(TABLES, dim + 1, self.functions))
        self.b = random.uniform(0, WIDTH, size=(TABLES, self.functions))
        self.draws = random.normal(size=(DRAWS, TABLES, self.functions))

    def places(self, y: np.ndarray) -> np.ndarray:
        """For each vector and table, where it lies along the functions, in bucket widths."""
        return np.stack([y @ self.a[t] + self.b[t] for t in range(TABLES)], axis=1) / WIDTH

    def candidates(self, x: np.ndarray, largest: float) -> tuple[np.ndarray, np.ndarray]:
        """Ring and buckets of every candidate."""
        square = (x ** 2).sum(1)
        ring = np.clip(np.floor(np.log(np.maximum(largest / np.sqrt(square), 1)) / math.log(STEP) + 1e-9), 0, RINGS - 1)
        bound = largest / STEP ** ring
        lift = np.sqrt(np.maximum(bound ** 2 - square, 0))
        return ring.astype(np.int64), _bucket(self.places(np.hstack([x, lift[:, None]]) / bound[:, None]))

    def queries(self, x: np.ndarray) -> np.ndarray:
        return self.places(np.hstack([x / np.sqrt((x ** 2).sum(1))[:, None], np.zeros((len(x), 1))]))

    def codes(self, ring: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """For each table the route: ring, table and first functions as one integer."""
        code = ring[:, None] * TABLES + np.arange(TABLES)
        for f in range(self.route):
            code = (code << _NIBBLE) | (keys[:, :, f].astype(np.int64) + EDGE)
        return code

    def decoded(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ring, table and first functions of routes."""
        first = np.stack([((codes >> (_NIBBLE * (self.route - 1 - f))) & (2 * EDGE - 1)) - EDGE
                          for f in range(self.route)], axis=1)
        head = codes >> (_NIBBLE * self.route)
        return head // TABLES, head % TABLES, first

    def cut(self, place: np.ndarray, cosine: np.ndarray, share: float) -> np.ndarray:
        """For each query, the cost within which that share of neighbours of that cosine is met."""
        out = np.empty(len(place))
        for low in range(0, len(place), 64):
            some = slice(low, low + 64)
            here, near = place[some, None], np.clip(cosine[some], -1, 1)[:, None, None, None]
            along = (near - 1) * (here * WIDTH - self.b)
            there = _bucket(here + (along + np.sqrt(1 - near ** 2) * self.draws) / WIDTH)
            first = (_walls(here, there) ** 2).sum(-1).min(-1)
            out[some] = np.quantile(first, share, axis=1, method="higher")
        return out


def _bucket(places: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(places), -EDGE, EDGE - 1).astype(np.int8)


def _walls(place: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Distance to the nearest wall of each bucket, zero inside it."""
    low = np.where(keys == -EDGE, -np.inf, keys)
    high = np.where(keys == EDGE - 1, np.inf, keys + 1.0)
    return np.maximum(np.maximum(low - place, place - high), 0)


def _cost(place: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Cost of every bucket for every query."""
    return sum(_walls(place[:, f, None], keys[None, :, f]) ** 2 for f in range(keys.shape[1]))


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _binary(values: np.ndarray) -> pa.Array:
    """Each row's bytes as one binary value."""
    rows = np.ascontiguousarray(values).reshape(len(values), -1)
    ends = np.arange(len(rows) + 1, dtype=np.int32) * (rows.shape[1] * rows.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows)])


def _array(column: pa.Array, kind, functions: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, TABLES, functions)


def _hashed(family: Family, dim: int, largest: float):
    """A task that adds buckets and routes to candidates."""
    def run(batches):
        for batch in batches:
            ring, keys = family.candidates(_vectors(batch.column("v"), dim), largest)
            codes = family.codes(ring, keys)
            ends = pa.array(np.arange(len(codes) + 1, dtype=np.int32) * TABLES)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("v"), _binary(keys),
                 pa.ListArray.from_arrays(ends, pa.array(codes.ravel()))], ["id", "v", "keys", "codes"])
    return run


def _routed(family: Family, dim: int, largest: float, codes: np.ndarray, blocks: np.ndarray, second: bool):
    """A task that sends queries to the blocks of every route within their cut."""
    rings, tables, first = family.decoded(codes)

    def cuts(place, norm, least):
        """For every query and ring, the cost already visited and the cost to visit now."""
        start = family.cut(place, np.full(len(place), START_COSINE), START_SHARE)
        before = np.repeat(start[:, None], RINGS, axis=1)
        if not second:
            return np.full_like(before, -1.0), before
        now = before.copy()
        for ring in np.unique(rings):
            cosine = least / (norm * largest / STEP ** float(ring))          # nan: fewer than k results
            within = np.abs(cosine) <= 1
            now[within, ring] = np.maximum(start[within], family.cut(place[within], cosine[within], TARGET))
            now[~(cosine >= -1), ring] = np.inf
        return before, now

    def run(batches):
        for whole in batches:
            for low in range(0, whole.num_rows, 64):
                batch = whole.slice(low, 64)
                x = _vectors(batch.column("v"), dim)
                place = family.queries(x)
                least = batch.column("least").to_numpy(zero_copy_only=False).astype(np.float64)
                before, now = cuts(place, np.sqrt((x ** 2).sum(1)), least)
                places = _binary(place)
                for t in range(TABLES):
                    mine = np.flatnonzero(tables == t)
                    limit, past = now[:, rings[mine]], before[:, rings[mine]]
                    # what visits everything has done so in the first table
                    go = (limit > past) & (_cost(place[:, t, :family.route], first[mine]) <= limit)
                    row, route = np.nonzero(go & (np.isfinite(limit) | (t == 0)))
                    many = blocks[mine[route]]
                    part = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                    row, route = np.repeat(row, many), np.repeat(route, many)
                    at = pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(codes[mine[route]]), pa.array(part.astype(np.int32)), batch.column("part").take(at),
                         batch.column("id").take(at), batch.column("v").take(at), places.take(at),
                         pa.array(past[row, route]), pa.array(limit[row, route])],
                        ["code", "cpart", "qpart", "id", "v", "place", "before", "cut"])
    return run


def _firsts(*columns: np.ndarray) -> np.ndarray:
    """True where sorted rows differ from the row before."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def _top(row: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int):
    """The best ``k`` distinct ids of every row, ties to the smaller id."""
    order = np.lexsort((-score, ids, row))
    order = order[_firsts(row[order], ids[order])]
    order = order[np.lexsort((ids[order], -score[order], row[order]))]
    head = np.flatnonzero(_firsts(row[order]))
    place = np.arange(len(order)) - np.repeat(head, np.diff(np.r_[head, len(order)]))
    order = order[place < k]
    return row[order], ids[order], score[order]


def _few_copies(c: np.ndarray, c_id: np.ndarray, k: int) -> np.ndarray:
    """Rows by id, and of equal vectors only those of the k + 1 smallest ids, which can be results."""
    _, same = np.unique(np.ascontiguousarray(c).view(
        np.dtype((np.void, c.dtype.itemsize * c.shape[1]))).ravel(), return_inverse=True)
    order = np.lexsort((c_id, same))
    order = order[_firsts(same[order], c_id[order])]
    start = np.flatnonzero(_firsts(same[order]))
    nth = np.arange(len(order)) - np.repeat(start, np.diff(np.r_[start, len(order)]))
    keep = order[nth <= k]
    return keep[np.argsort(c_id[keep], kind="stable")]


def _rerank(family: Family, dim: int, k: int):
    """A task that gives each query its best ``k`` ids of a block, and a row with how many it met."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _result([], [], [])
        t = int(family.decoded(left["code"].to_numpy()[:1])[1][0])
        c, q = (_vectors(side["v"].combine_chunks(), dim) for side in (left, right))
        keep = _few_copies(c, left["id"].to_numpy(), k)
        c, c_id, q_id = c[keep], left["id"].to_numpy()[keep], right["id"].to_numpy()
        keys = _array(left["keys"], np.int8, family.functions)[keep]
        place = _array(right["place"], np.float64, family.functions)
        before, cut = right["before"].to_numpy(), right["cut"].to_numpy()
        buckets = [np.unique(keys[:, u], axis=0, return_inverse=True) for u in range(TABLES)]
        slot = [b[1].ravel() for b in buckets]
        order = np.argsort(slot[t], kind="stable")
        ends = np.r_[0, np.cumsum(np.bincount(slot[t]))]
        out, met = [], np.zeros(len(q), np.int64)
        for low in range(0, len(q), _ROWS):
            cost = [_cost(place[low:low + _ROWS, u], buckets[u][0]) for u in range(TABLES)]
            held, size, floor = [], 0, np.full(len(cost[0]), -np.inf)
            for bucket in np.flatnonzero((cost[t] <= cut[low:low + _ROWS, None]).any(0)):
                rows = np.flatnonzero(cost[t][:, bucket] <= cut[low:low + _ROWS])
                cols = order[ends[bucket]:ends[bucket + 1]]
                fresh = q_id[low + rows, None] != c_id[cols]
                for u in range(TABLES):          # not in the round before, nor in an earlier table
                    past = before[low + rows] if u >= t else np.maximum(before, cut)[low + rows]
                    fresh &= cost[u][np.ix_(rows, slot[u][cols])] > past[:, None]
                some, few = fresh.any(1), fresh.any(0)
                if not some.any():
                    continue
                rows, cols, fresh = rows[some], cols[few], fresh[np.ix_(some, few)]
                met[low + rows] += fresh.sum(1)
                score = np.where(fresh, q[low + rows] @ c[cols].T, -np.inf)
                first = np.flatnonzero(_firsts(c_id[cols]))                # each id counts once
                best = np.maximum.reduceat(score, first, axis=1) if len(first) < len(cols) else score
                if best.shape[1] >= k:
                    floor[rows] = np.maximum(floor[rows], np.partition(best, -k, axis=1)[:, -k])
                slack = np.abs(q[low + rows]).sum(1) * np.abs(c).max() * 1e-12
                row, col = np.nonzero(fresh & (score >= (floor[rows] - slack)[:, None]))
                exact = (q[low + rows[row]] * c[cols[col]]).sum(axis=1)
                held.append((rows[row], c_id[cols[col]], exact))
                size += len(row)
                if size > _HELD:
                    held = [_top(*map(np.concatenate, zip(*held)), k)]
                    size = len(held[0][0])
            if held:
                # rows of one query id (several vectors) stay apart until the grouped top-k
                row, ids, exact = _top(*map(np.concatenate, zip(*held)), k)
                out.append((q_id[low + row], ids, exact))
        return _result(out, q_id, met)
    return run


def _result(out, q_id, met) -> pa.Table:
    hits = [np.concatenate([o[i] for o in out]) if out else np.empty(0, kind)
            for i, kind in enumerate((np.int64, np.int64, np.float64))]
    return pa.table({
        "query_id": pa.array(np.r_[hits[0], np.asarray(q_id, np.int64)]),
        "vec_id": pa.concat_arrays([pa.array(hits[1]), pa.nulls(len(met), pa.int64())]),
        "score": pa.concat_arrays([pa.array(hits[2]), pa.nulls(len(met), pa.float64())]),
        "met": pa.concat_arrays([pa.nulls(len(hits[0]), pa.int64()), pa.array(np.asarray(met, np.int64))])})


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (rows.select(F.col(key).cast("long").alias("id"), v.alias("v"))
            .where(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
            .where(F.coalesce(fine, F.lit(False)) & F.exists("v", lambda x: x != 0)))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """One row for each pair, then the best k; blocks hand over at most k rows a query."""
    best = found.where("vec_id IS NOT NULL").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def met_candidates(rows: DataFrame, queries, key: str = "vec_id", vector: str = "embedding",
                   k: int = K) -> DataFrame | None:
    """Results of all blocks of both rounds, and rows with how many candidates a query met in one.

    None without usable vectors. A block's result holds ``query_id, vec_id, score``, the other
    rows ``query_id, met``.
    """
    spark = rows.sparkSession
    held = usable(rows, key, vector)
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    sizes = held.groupBy(F.size("v").alias("dim")).agg(
        F.count("*").alias("n"), F.max(norm).alias("largest"),
        F.sum(F.when(queries(F.col("id")), 1).otherwise(0)).alias("asked")).orderBy(
        F.desc("n"), "dim").limit(1).collect()
    if not sizes:
        return None
    dim, largest = sizes[0]["dim"], sizes[0]["largest"]
    qparts = max(1, math.ceil(sizes[0]["asked"] / QUERY_BLOCK))
    family = Family(dim, sizes[0]["n"])
    same = held.where(F.size("v") == dim)
    candidates = stored(same.mapInArrow(_hashed(family, dim, largest),
                                        "id long, v array<double>, keys binary, codes array<long>"))
    # at most RINGS x TABLES x (2 EDGE)^3 routes, however many rows there are
    routes = sorted(map(tuple, candidates.select(F.explode("codes").alias("code")).groupBy("code").count().collect()))
    codes = np.array([r[0] for r in routes], np.int64)
    blocks = np.array([math.ceil(r[1] / BLOCK) for r in routes], np.int64)
    known = spark.createDataFrame(list(zip(codes.tolist(), blocks.tolist())), "code long, blocks int")
    left = (candidates.select("id", "v", "keys", F.explode("codes").alias("code"))
            .join(F.broadcast(known), "code")
            .select("code", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("cpart"),
                    F.explode(F.sequence(F.lit(0), F.lit(qparts - 1))).alias("qpart"), "id", "v", "keys"))
    asked = same.where(queries(F.col("id"))).select(
        F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(qparts)).cast("int").alias("part"), "id", "v")

    def searched(questions: DataFrame, second: bool) -> DataFrame:
        right = questions.select("part", "id", "v", "least").mapInArrow(
            _routed(family, dim, largest, codes, blocks, second),
            "code long, cpart int, qpart int, id long, v array<double>, place binary, before double, cut double")
        at = ["code", "cpart", "qpart"]
        return stored(left.groupBy(*at).cogroup(right.groupBy(*at)).applyInArrow(
            _rerank(family, dim, k), "query_id long, vec_id long, score double, met long"))

    near = searched(asked.withColumn("least", F.lit(None).cast("double")), False)
    least = _ranked(near, k).where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("least"))
    return near.unionByName(searched(asked.join(least, "id", "left"), True))


def search(rows: DataFrame, queries, key: str = "vec_id", vector: str = "embedding",
           k: int = K) -> DataFrame:
    """The ``k`` nearest rows found for every row that the condition ``queries`` on ``id`` names."""
    found = met_candidates(rows, queries, key, vector, k)
    if found is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return _ranked(found, k).select("query_id", "rank", "vec_id", "score")


def op9_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)


QUERIES = {"op9_vectors": op9_vectors}
ORACLES: dict[str, str] = {}
