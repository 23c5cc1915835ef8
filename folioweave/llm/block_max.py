"""Ranked lexical search: Block-Max MaxScore over a document-partitioned index.

``build_index`` tokenises whole texts and writes, for every shard of documents and every term,
one posting list: blocks of 128 (document, impact) pairs as variable-length bytes, with each
block's last document and largest impact beside it. A shard ends once it holds ``SHARD_TERMS``
terms, so no list grows with the corpus, however common its term. Impacts are the integers
that the scores sum, so bounds are exact.

``search`` sends lists, with the items that use them, to one group for each (shard, block of
items). There, for each item, lists are taken in descending order of their greatest possible
share: those taken before the rest together fall below the k-th best score so far are the
essential lists, and every other document is out. On the remaining lists the maxima of the
candidates' blocks reject candidates first; only blocks that still have one are unpacked.
The shards' best k meet in one window, which Spark cuts to k per item before the shuffle.

Defined results: null and empty texts have no term and are not counted; every row is a document
of its own, also with a repeated id; a null id ranks last among equal scores. Repeated items
each get their rows; null item texts get none. Extra columns are not read. Terms of a shard are
told apart by 64-bit hashes of their bytes; lists meet items by the terms themselves.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from folioweave.llm import terms as T
from folioweave.llm.common import parts, stored, table, work_folder

BLOCK, SHARD_TERMS, ITEM_BLOCK, K = 128, 8_000_000, 256, 10
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unsigned integers as groups of seven bits, and where each one begins."""
    values = values.astype(np.uint64)
    sizes = np.ones(len(values), np.int64)
    for i in range(1, 9):
        sizes += values >= np.uint64(1 << 7 * i)
    at = np.zeros(len(values) + 1, np.int64)
    np.cumsum(sizes, out=at[1:])
    out = np.empty(at[-1], np.uint8)
    for i in range(int(sizes.max(initial=0))):
        has = np.flatnonzero(sizes > i)
        bits = (values[has] >> np.uint64(7 * i)) & np.uint64(127)
        out[at[has] + i] = bits.astype(np.uint8) | ((sizes[has] > i + 1).astype(np.uint8) << 7)
    return out, at


def unpack(data: np.ndarray) -> np.ndarray:
    starts = np.concatenate(([0], np.flatnonzero(data < 128)[:-1] + 1))
    places = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * places), starts)


class _Shard:
    """Postings of the documents of one shard, until it is written."""

    def __init__(self):
        self.ids, self.sizes, self.hashes, self.docs, self.counts = [], [], [], [], []
        self.known, self.names, self.documents, self.terms = [], [], 0, 0

    def add(self, ids: pa.Array, texts: pa.Array) -> None:
        found = T.cut(texts, T.ALPHANUMERIC)
        hashes = found.hashes()
        order = np.argsort(hashes, kind="stable")           # rows stay ascending within a term
        h, rows = hashes[order], found.rows[order]
        new_term = np.r_[True, h[1:] != h[:-1]][:len(h)]
        heads = np.flatnonzero(new_term | np.r_[True, rows[1:] != rows[:-1]][:len(h)])
        self.hashes.append(h[heads])
        self.docs.append(rows[heads] + self.documents)
        self.counts.append(np.diff(np.append(heads, len(h))))
        first = np.flatnonzero(new_term)
        self.known.append(h[first])
        self.names.append(found.strings(order[first]))
        self.ids.append(ids)
        self.sizes.append(np.bincount(found.rows, minlength=len(texts)))
        self.documents += len(texts)
        self.terms += len(h)

    def lists(self, n_docs: int, n_terms: int):
        """(ids in order, terms, postings per term, documents, impacts), all by term and id."""
        ids = pa.concat_arrays(self.ids)
        order = pa.compute.sort_indices(ids, null_placement="at_end").to_numpy()
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        sizes = np.concatenate(self.sizes)
        h = np.concatenate(self.hashes)
        docs, counts = np.concatenate(self.docs), np.concatenate(self.counts)
        by = np.lexsort((number[docs], h))
        h, docs, counts = h[by], docs[by], counts[by].astype(np.int64)
        m = 25 + (75 * sizes[docs] * n_docs) // max(n_terms, 1)
        impacts = (1_000_000_000 * counts) // (1000 * counts + 8 * m)
        known, where = np.unique(np.concatenate(self.known), return_index=True)
        names = pa.concat_arrays(self.names).take(pa.array(where))
        lengths = np.diff(np.append(np.searchsorted(h, known), len(h)))
        return ids.take(pa.array(order)), names, lengths, number[docs], impacts


def _list_arrays(lengths: np.ndarray, docs: np.ndarray, impacts: np.ndarray) -> list[pa.Array]:
    """n_docs, lasts, tops, places and data of all lists of a shard, in one pass."""
    ends = np.cumsum(lengths)
    place = np.arange(len(docs)) - np.repeat(ends - lengths, lengths)
    heads = np.flatnonzero(place % BLOCK == 0)              # of blocks; lists begin new ones
    tails = np.append(heads[1:], len(docs)) - 1
    before = np.empty(len(docs), np.int64)                  # the document that a pair counts from
    before[1:] = docs[:-1]
    before[ends - lengths] = -1
    data, at = pack(np.stack([docs - before, impacts], 1).reshape(-1))
    blocks = -(-lengths // BLOCK)
    cuts = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(blocks, out=cuts[1:])
    begin = at[2 * np.append(ends - lengths, len(docs))]    # of each list's bytes

    def listed(values):
        return pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)),
                                        pa.array(values.astype(np.int32)))

    tops = np.maximum.reduceat(impacts, heads) if len(heads) else impacts
    return [pa.array(lengths.astype(np.int32)), listed(docs[tails]), listed(tops),
            listed(at[2 * heads] - np.repeat(begin[:-1], blocks)),
            pa.Array.from_buffers(pa.binary(), len(lengths), [
                None, pa.py_buffer(begin.astype(np.int32)), pa.py_buffer(data)])]


def _indexed(n_docs: int, n_terms: int, limit: int):
    names = ["shard", "term", "n_docs", "lasts", "tops", "places", "data", "ids"]

    def rows_of(shard: _Shard, name: int):
        ids, terms, lengths, docs, impacts = shard.lists(n_docs, n_terms)
        none = pa.ListArray.from_arrays(pa.array([0, 0], pa.int32()), pa.array([], pa.int32()))
        # the shard's documents: one row under a name that no term can have
        yield pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([f"\0{name}"]), pa.array([len(ids)], pa.int32()), none, none,
             none, pa.array([b""]), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)],
            names)
        arrays = [pa.array(np.full(len(terms), name)), terms, *_list_arrays(lengths, docs, impacts),
                  pa.nulls(len(terms), pa.list_(ids.type))]
        for low in range(0, len(terms), 20_000):
            yield pa.RecordBatch.from_arrays([a.slice(low, 20_000) for a in arrays], names)

    def run(batches):
        shard, name = _Shard(), TaskContext.get().partitionId() << 24
        for batch in batches:
            for low, n in parts(batch.column("text"), 2 << 20):
                shard.add(batch.column("id").slice(low, n), batch.column("text").slice(low, n))
                if shard.terms >= limit:
                    yield from rows_of(shard, name)
                    shard, name = _Shard(), name + 1
        if shard.documents:
            yield from rows_of(shard, name)
    return run


def _totals(batches):
    for batch in batches:
        counts = [np.bincount(T.cut(batch.column("text").slice(low, n), T.ALPHANUMERIC).rows, minlength=n)
                  for low, n in parts(batch.column("text"), 2 << 20)]
        yield pa.RecordBatch.from_pydict({
            "docs": [sum(int(np.count_nonzero(c)) for c in counts)],
            "terms": [sum(int(c.sum()) for c in counts)]})


def corpus_totals(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """How many documents have a term, and how many terms they have together."""
    got = (docs.select(F.col(text).alias("text")).mapInArrow(_totals, "docs long, terms long")
           .agg(F.sum("docs"), F.sum("terms")).head())
    return got[0] or 0, got[1] or 0


def build_index(docs: DataFrame, path: str, only: DataFrame | None = None, key: str = "doc_id",
                text: str = "text", shard_terms: int = SHARD_TERMS) -> tuple[int, int]:
    """Write the posting lists of all documents below ``path``; returns ``corpus_totals``.

    ``only`` (column ``term``) keeps the lists of a standing set of terms; a join decides, so the
    set may be of any size. Without it every term gets its lists.
    """
    n_docs, n_terms = corpus_totals(docs, text)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(
        _indexed(n_docs, n_terms, shard_terms),
        "shard long, term string, n_docs int, lasts array<int>, tops array<int>, places array<int>, "
        f"data binary, ids array<{kind}>")
    if only is not None:
        wanted = only.select(F.col("term").alias("wanted")).distinct()
        rows = (rows.join(wanted, F.col("term") == F.col("wanted"), "left")
                .where("wanted IS NOT NULL OR ids IS NOT NULL").drop("wanted"))
    rows.write.parquet(path)
    return n_docs, n_terms


class Lists:
    """Posting lists of one group; blocks are unpacked when first needed and then kept."""

    def __init__(self, lasts, tops, places, data):
        self.lasts, self.tops, self.places, self.data = lasts, tops, places, data
        self.kept: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def block(self, i: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        if (i, b) not in self.kept:
            places = self.places[i]
            end = places[b + 1] if b + 1 < len(places) else len(self.data[i])
            pairs = unpack(self.data[i][places[b]:end]).reshape(-1, 2)
            base = self.lasts[i][b - 1] if b else -1
            self.kept[i, b] = np.cumsum(pairs[:, 0]) + base, pairs[:, 1]
        return self.kept[i, b]

    def whole(self, i: int):
        got = [self.block(i, b) for b in range(len(self.lasts[i]))]
        return np.concatenate([d for d, _ in got]), np.concatenate([x for _, x in got])


def best(lists: Lists, used: list[tuple[int, int]], size: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best (documents, scores) for lists with their weights, among ``size`` documents."""
    used = sorted(((c * int(lists.tops[i].max()), i, c) for i, c in used), reverse=True)
    rest = np.append(np.cumsum([u for u, _, _ in used[::-1]])[::-1], 0)
    scores = np.zeros(size, np.int64)
    floor, at = 0, 0
    while at < len(used) and rest[at] >= max(floor, 1):     # essential lists: any document may come
        _, i, c = used[at]
        docs, impacts = lists.whole(i)
        scores[docs] += c * impacts
        at += 1
        if size > k:
            floor = max(floor, int(np.partition(scores, size - k)[size - k]))
    near = np.flatnonzero(scores + rest[at] >= max(floor, 1))
    near = near[scores[near] > 0]
    got, left = scores[near], used[at:]
    # what each remaining list can still give a candidate, by the maximum of its block there
    blocks = [np.searchsorted(lists.lasts[i], near) for _, i, _ in left]
    bounds = [c * np.append(lists.tops[i], 0)[b] for (_, i, c), b in zip(left, blocks)]
    ahead = np.sum(bounds, axis=0, dtype=np.int64) if left else np.zeros(len(near), np.int64)
    for n, (_, i, c) in enumerate(left):
        alive = np.flatnonzero(got + ahead >= floor)
        near, got, ahead = near[alive], got[alive], ahead[alive]
        blocks[n:] = [b[alive] for b in blocks[n:]]
        bounds[n:] = [b[alive] for b in bounds[n:]]
        ahead = ahead - bounds[n]
        for b in np.unique(blocks[n]):
            if b < len(lists.lasts[i]):
                docs, impacts = lists.block(i, b)
                mine = np.flatnonzero(blocks[n] == b)
                where = np.minimum(np.searchsorted(docs, near[mine]), len(docs) - 1)
                met = docs[where] == near[mine]
                got[mine[met]] += c * impacts[where[met]]
        if len(got) > k:
            floor = max(floor, int(np.partition(got, len(got) - k)[len(got) - k]))
    order = np.lexsort((near, -got))[:k]
    return near[order], got[order]


def _search(k: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        def arrays(name):
            return [np.asarray(x.values, np.int64) for x in group.column(name)]

        data = [np.frombuffer(x.as_buffer(), np.uint8) for x in group.column("data")]
        lists = Lists(arrays("lasts"), arrays("tops"), arrays("places"), data)
        size = 1 + max(int(x[-1]) for x in lists.lasts)
        items: dict[int, list[tuple[int, int]]] = {}
        for i, (weight, uses) in enumerate(zip(group.column("weight").to_pylist(),
                                               group.column("uses").to_pylist())):
            for use in uses:
                items.setdefault(use["item"], []).append((i, weight * use["times"]))
        found = [(item, *best(lists, used, size, k)) for item, used in items.items()]
        unpacked, blocks = len(lists.kept), sum(map(len, lists.lasts))
        counts = [len(d) for _, d, _ in found]
        n = sum(counts)
        return pa.table({
            "shard": pa.array(np.full(n, group.column("shard")[0].as_py())),
            "block": pa.array(np.full(n, group.column("block")[0].as_py(), np.int32)),
            "item": pa.array(np.repeat(np.array([i for i, _, _ in found], np.int64), counts)),
            "doc": pa.array(np.concatenate([d for _, d, _ in found]).astype(np.int32)),
            "score": pa.array(np.concatenate([s for _, _, s in found])),
            "unpacked": pa.array(np.full(n, unpacked)), "blocks": pa.array(np.full(n, blocks))})
    return run


def item_terms(items: DataFrame, text: str = "text") -> DataFrame:
    """item (a row's number), block, term, times: the terms of all items with their repeats."""
    spelled = F.translate(F.col(text), _UPPER, _UPPER.lower())
    each = items.select("item", "block", F.explode(F.regexp_extract_all(spelled, F.lit(TERM), F.lit(0)))
                        .alias("term"))
    return each.groupBy("item", "block", "term").agg(F.count("*").alias("times"))


def numbered(items: DataFrame, key: str, text: str, block: int = ITEM_BLOCK) -> DataFrame:
    """Items with a number each, dealt evenly into blocks, written down so that both stay."""
    n = max(1, math.ceil(items.count() / block))
    return stored(items.select(F.col(key).alias("item_id"), F.col(text).alias("text")).repartition(n)
                  .select("*", F.spark_partition_id().alias("block"),
                          F.monotonically_increasing_id().alias("item")))


def search(spark: SparkSession, path: str, n_docs: int, items: DataFrame, k: int = K) -> DataFrame:
    """item, doc_id, score, rank and the share of blocks unpacked, from an index at ``path``.

    ``items`` are ``numbered``; ``n_docs`` is the first of ``corpus_totals``.
    """
    index = spark.read.parquet(path)
    lists = index.where("ids IS NULL").drop("ids")
    weight = F.floor(1000 * F.log((2.0 * n_docs + 2.0) / (2.0 * F.sum("n_docs") + 1.0)))
    weights = lists.groupBy("term").agg(weight.cast("long").alias("weight")).where("weight > 0")
    uses = item_terms(items).groupBy("block", "term").agg(
        F.collect_list(F.struct("item", "times")).alias("uses"))
    sent = lists.drop("n_docs").join(uses.join(weights, "term"), "term").drop("term")
    found = sent.groupBy("shard", "block").applyInArrow(
        _search(k), "shard long, block int, item long, doc int, score long, unpacked long, blocks long")
    # at most k for each item of a block; their ids come from the shard's row of documents
    tops = found.groupBy("shard", "block").agg(
        F.collect_list(F.struct("item", "doc", "score", "unpacked", "blocks")).alias("tops"))
    names = index.where("ids IS NOT NULL").select("shard", "ids")
    each = tops.join(names, "shard").select("ids", F.explode("tops").alias("t")).select(
        F.col("t.item").alias("item"), F.element_at("ids", F.col("t.doc") + 1).alias("doc_id"),
        F.col("t.score").alias("score"), F.col("t.unpacked").alias("unpacked"),
        F.col("t.blocks").alias("blocks"))
    ranks = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return each.withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= k)


def op13_block_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = numbered(table(spark, sf_dir, "benchmark"), "item_id", "text")
    path = f"{work_folder(spark)}/index"
    n_docs, _ = build_index(table(spark, sf_dir, "documents"), path, item_terms(items))
    found = search(spark, path, n_docs, items)
    return found.join(items.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
      regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '{TERM}') AS terms FROM documents),
  p AS (SELECT r, doc_id, unnest(terms) AS term FROM d),
  sized AS (SELECT r, count(*) AS n FROM p GROUP BY r),
  total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS all_terms FROM sized),
  tf AS (SELECT r, doc_id, term, count(*) AS tf FROM p GROUP BY r, doc_id, term),
  df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
  i AS (SELECT item_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '{TERM}'))
      AS term FROM benchmark),
  q AS (SELECT item_id, term, count(*) AS times FROM i GROUP BY item_id, term),
  s AS (SELECT item_id, doc_id, r, sum(times * floor(1000 * ln((2.0 * docs + 2) / (2.0 * df + 1)))::BIGINT
      * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // all_terms))))::BIGINT AS score
    FROM q JOIN tf USING (term) JOIN df USING (term) JOIN sized USING (r) CROSS JOIN total
    GROUP BY item_id, doc_id, r),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
    FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {K}
"""

QUERIES = {"op13_block_max": op13_block_max}
ORACLES = {"op13_block_max": SQL}
