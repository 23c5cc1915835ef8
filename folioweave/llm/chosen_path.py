"""N-gram Jaccard join of documents by chosen paths.

A document is the set of its shingles of five words (split at white space, as they are; a
text of one to four words is one shingle). Documents of equal sets are a class; one
representative stands for it. Representatives of Jaccard similarity 0.8 or more are linked.

Each run draws, level by level, one hash order of all shingles; a set's token of the level
is its first shingle in that order, which two sets share with a probability equal to
their similarity. Sets with the same tokens so far form a node of the run's tree; a node of
more than ``LEAF`` sets is split on the next level's token, smaller ones are leaves, and so
are nodes at the last level. Leaves are compared by brute force. Runs repeat until a pair at
the threshold that is split at every level is found with the target recall.

In a leaf, sketches (all tokens of all runs) rule out pairs that agree far too seldom, the
first leaf that holds a pair owns it, and owned pairs are verified exactly on whole shingle
sets. A leaf of more than ``LEAF`` sets, which similar sets make, is cut into blocks, and
pairs of blocks are tasks of bounded size. No pair leaves a task: a task gives each member's
number of links and the edges of a spanning forest.

Defined results: null, empty and blank texts have no shingle, each is its own class without
links; repeated rows are members of one class; a class is named by its smallest id (null ids
never name a class unless all are null); links count linked representatives of other
classes. An empty table gives no rows; further columns of the input are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from folioweave.llm.common import MIX, mix64, parts, ranges_of, stored, table, text_buffer, word_hashes
from folioweave.llm.graph import components

SHINGLE, SIMILARITY, LEVELS, LEAF, RECALL, SEED = 5, 0.8, 3, 256, 0.999, 10
RUNS = math.ceil(math.log(1 - RECALL) / math.log(1 - SIMILARITY ** LEVELS))
# Sketch agreement of a pair at the threshold is below this share once in a million pairs.
AGREE = 0.4

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending inside a text, and the rows' bounds."""
    data, offsets = text_buffer(column)
    starts, ends = ranges_of(~_SPACE[data], offsets)
    words = word_hashes(data, starts, ends)
    first = np.searchsorted(starts, offsets)
    count = np.diff(first)
    many = np.where(count >= SHINGLE, count - SHINGLE + 1, np.minimum(count, 1))
    row = np.repeat(np.arange(len(count)), many)
    at = np.repeat(first[:-1] - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(many.sum())
    value = np.zeros(len(at), np.uint64)
    for k in range(SHINGLE):
        inside = at + k < first[row + 1]
        word = words[np.minimum(at + k, max(len(words) - 1, 0))] if len(words) else value
        value = np.where(inside, (value + word) * MIX, value ^ (value >> np.uint64(29)))
    value = mix64(value)
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    new = np.r_[True, (value[1:] != value[:-1]) | (row[1:] != row[:-1])] if len(value) else np.zeros(0, bool)
    value, row = value[new], row[new]
    return value, np.searchsorted(row, np.arange(len(count) + 1))


def _sketch(batches):
    """Set fingerprint, size and tokens of every text, after the other columns."""
    salts = mix64(np.arange(1, RUNS * LEVELS + 1, dtype=np.uint64) + np.uint64(SEED << 32))
    for batch in batches:
        names = [c for c in batch.schema.names if c != "text"]
        for low, n in parts(batch.column("text")):
            value, bounds = shingles(batch.column("text").slice(low, n))
            size = np.diff(bounds)
            some = np.flatnonzero(size)
            tokens = np.zeros((n, len(salts)), np.int64)
            one, two = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
            if len(some):
                heads = bounds[:-1][some]
                one[some] = np.add.reduceat(mix64(value), heads)
                two[some] = np.add.reduceat(mix64(value ^ MIX), heads)
                for k, salt in enumerate(salts):
                    seen = (value ^ salt) * np.uint64(0xFF51AFD7ED558CCD)
                    seen ^= seen >> np.uint64(32)
                    seen *= np.uint64(0xC4CEB9FE1A85EC53)
                    tokens[some, k] = np.minimum.reduceat(seen, heads).view(np.int64)
            ends = np.arange(n + 1, dtype=np.int32) * len(salts)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).slice(low, n) for c in names], pa.array(one.view(np.int64)), pa.array(two.view(np.int64)),
                 pa.array(size.astype(np.int64)), pa.ListArray.from_arrays(pa.array(ends), pa.array(tokens.ravel()))],
                [*names, "s1", "s2", "size", "tokens"])


def _leaves(sets: DataFrame) -> DataFrame:
    """(node, leaf): the leaf of each set in each run, where other sets share it."""
    runs = [F.struct(F.lit(r).alias("run"), *[
        F.xxhash64(F.lit(r), *[F.col("tokens")[r * LEVELS + d] for d in range(level + 1)]).alias(f"k{level}")
        for level in range(LEVELS)]) for r in range(RUNS)]
    rows = stored(sets.select("node", F.inline(F.array(*runs))))
    out = None
    for level in range(LEVELS):
        key = f"k{level}"
        sizes = rows.groupBy("run", key).agg(F.count("*").alias("n")).where("n > 1")
        joined = rows.join(sizes.hint("merge"), ["run", key])
        last = level == LEVELS - 1
        done = (joined if last else joined.where(F.col("n") <= LEAF)).select(
            "node", "run", F.xxhash64(F.lit(level), key).alias("leaf"), "n")
        out = done if out is None else out.unionAll(done)
        if not last:
            rows = joined.where(F.col("n") > LEAF).drop("n", key)
    return out


def _blocks(leaf: DataFrame) -> DataFrame:
    """Tasks of bounded size: a leaf, or a pair of its blocks."""
    n = F.greatest(F.lit(1), F.ceil(F.col("n") / LEAF)).cast("int")
    mine = F.pmod(F.xxhash64("node", "run"), n).cast("int")
    rows = leaf.withColumn("side", mine).withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
    return rows.select(
        "node", "run", "leaf", "side", F.least("side", "other").alias("low"),
        F.greatest("side", "other").alias("high"), F.xxhash64(
            "run", "leaf", F.least("side", "other"), F.greatest("side", "other")).alias("task"))


def _grouped(batches, key: str):
    """Whole groups of equal keys from key-sorted batches, one at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = batch.column(key).to_numpy()
        if not len(keys):
            continue
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        for low, high in zip(np.r_[0, cuts].tolist(), np.r_[cuts, len(keys)].tolist()):
            if held and held[-1].column(key)[0].as_py() != keys[low]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(low, high - low))
    if held:
        yield pa.Table.from_batches(held)


def _pairs_of(table_: pa.Table):
    """Owned pairs of a task whose sketches do not rule them out, by rows."""
    run = table_["run"][0].as_py()
    leaves = table_["leaves"].combine_chunks().flatten().to_numpy().reshape(-1, RUNS)
    tokens = table_["tokens"].combine_chunks().flatten().to_numpy().reshape(len(leaves), -1)
    side = table_["side"].to_numpy()
    cross = table_["low"][0].as_py() != table_["high"][0].as_py()
    left = np.flatnonzero(side == table_["low"][0].as_py()) if cross else np.arange(len(leaves))
    right = np.flatnonzero(side == table_["high"][0].as_py()) if cross else left
    agree = np.zeros((len(left), len(right)), np.int16)
    for k in range(tokens.shape[1]):
        agree += tokens[left, k][:, None] == tokens[right, k][None, :]
    owned = agree >= AGREE * tokens.shape[1]
    for r in range(run):
        a, b = leaves[left, r], leaves[right, r]
        owned &= ~((a[:, None] == b[None, :]) & (a != 0)[:, None])
    if not cross:
        owned = np.triu(owned, 1)
    i, j = np.nonzero(owned)
    return left[i], right[j]


def _filter_tasks(batches):
    """Members of a task that are in any pair left to verify."""
    for group in _grouped(batches, "task"):
        if group.num_rows < 2:
            continue
        i, j = _pairs_of(group)
        used = np.union1d(i, j)
        if len(used):
            yield from group.take(pa.array(used)).to_batches()


def _verify_tasks(batches):
    """Exact similarity of owned pairs: links of each member and a spanning forest."""
    for group in _grouped(batches, "task"):
        i, j = _pairs_of(group)
        if not len(i):
            continue
        value, bounds = shingles(group["text"].combine_chunks())
        size = np.diff(bounds)
        row = np.repeat(np.arange(group.num_rows), size)
        words, code, seen = np.unique(value, return_inverse=True, return_counts=True)
        common = np.zeros((group.num_rows, group.num_rows), np.float32)
        some = seen[code] > 1
        row, code = row[some], code[some]
        order = np.argsort(code, kind="stable")
        row, code = row[order], np.unique(code[order], return_inverse=True)[1]
        width = 4096                                   # shingles at a time: bounded memory
        for low in range(0, int(code[-1]) + 1 if len(code) else 0, width):
            a, b = np.searchsorted(code, [low, low + width])
            member = np.zeros((group.num_rows, width), np.float32)
            member[row[a:b], code[a:b] - low] = 1
            common += member @ member.T
        both = common[i, j].astype(np.float64)
        linked = both >= SIMILARITY * (size[i] + size[j] - both) - 1e-9
        i, j = i[linked], j[linked]
        if not len(i):
            continue
        links = np.bincount(np.r_[i, j], minlength=group.num_rows)
        parent = list(range(group.num_rows))

        def root(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for a, b in zip(i.tolist(), j.tolist()):
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
        node = group["node"].to_numpy()
        touched = np.flatnonzero(links)
        up = np.array([root(int(x)) for x in touched])
        yield pa.RecordBatch.from_arrays(
            [pa.array(node[touched]), pa.array(node[up]), pa.array(links[touched])],
            ["node", "up", "links"])


def _classes(docs: DataFrame, key: str, text: str, row: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Sketches of all documents, and for each set of shingles its class, links and ``keeper``.

    The keeper is the first of the whole class by (id with null last, text hash, ``row``).
    """
    kind = docs.schema[key].dataType.simpleString()
    content = F.coalesce(F.col(text), F.lit(""))
    numbered = [] if row is None else [F.col(row).alias("row")]
    texts = docs.select(F.col(key).alias("id"), F.xxhash64(content).alias("t"), *numbered, content.alias("text"))
    sketches = stored(texts.mapInArrow(
        _sketch, f"id {kind}, t long, {'row long, ' if numbered else ''}s1 long, s2 long, size long, "
                 "tokens array<long>"))
    order = F.struct(F.col("id").isNull().alias("last"), "id", "t", *["row" for _ in numbered])
    # equal sets: partially aggregated, so a text that a third of all rows share costs little
    held = sketches.where("size > 0")
    sets = stored(held.groupBy("s1", "s2", "size").agg(
        F.min("id").alias("first"), F.min(order).alias("keeper"), F.count("*").alias("members"),
        F.first("tokens").alias("tokens")).withColumn("node", F.monotonically_increasing_id()))
    leaf = stored(_leaves(sets))
    per_set = leaf.groupBy("node").agg(F.map_from_entries(F.collect_list(F.struct("run", "leaf"))).alias("by"))
    shared = per_set.join(sets.select("node", "tokens"), "node").withColumn(
        "leaves", F.transform(F.sequence(F.lit(0), F.lit(RUNS - 1)),
                              lambda r: F.coalesce(F.element_at("by", r.cast("int")), F.lit(0).cast("long")))).drop("by")
    columns = "node long, run int, task long, side int, low int, high int, leaves array<long>, tokens array<long>"
    tasks = _blocks(leaf).join(shared.select("node", "leaves", "tokens"), "node").select(
        "node", "run", "task", "side", "low", "high", "leaves", "tokens")
    tasks = stored(tasks.repartition("task").sortWithinPartitions("task").mapInArrow(_filter_tasks, columns))
    # whole texts of one document of each set that still has a pair to verify
    wanted = tasks.select("node").distinct().join(sets.select("node", "keeper"), "node").select(
        "node", F.col("keeper.id").alias("cid"), F.col("keeper.t").alias("ct"))
    checked = texts.join(wanted, (F.col("t") == F.col("ct")) & F.col("id").eqNullSafe(F.col("cid"))).select(
        "node", "text").dropDuplicates(["node"])
    found = stored(tasks.join(checked, "node").repartition("task").sortWithinPartitions("task")
                   .mapInArrow(_verify_tasks, "node long, up long, links long"))
    links = found.groupBy("node").agg(F.sum("links").alias("n_links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("up").alias("b")))
    named = (sets.select("node", "s1", "s2", "size", "first", "keeper", "members").join(links, "node", "left")
             .join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
             .withColumnRenamed("keeper", "mine"))
    classes = named.groupBy("root").agg(F.min("first").alias("class_id"), F.min("mine").alias("keeper"),
                                        F.sum("members").alias("class_size"))
    return sketches, named.join(classes, "root").select(
        "s1", "s2", "size", "class_id", "class_size", F.coalesce("n_links", F.lit(0)).alias("n_links"), "keeper")


def join(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, class_id, n_links and class_size for every document."""
    sketches, resolved = _classes(docs, key, text)
    alone = sketches.where("size = 0").select(
        F.col("id").alias("doc_id"), F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
        F.lit(1).cast("long").alias("class_size"))
    members = sketches.where("size > 0").select("id", "s1", "s2", "size").join(
        resolved.drop("keeper").hint("merge"), ["s1", "s2", "size"])
    return members.select(F.col("id").alias("doc_id"), "class_id", "n_links", "class_size").unionAll(alone)


def first_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of every class, with all its columns; documents without shingles stay.

    It is the row with the smallest id (null ids last), then text hash, then row number of a
    stored table: rows are told apart also where their ids are null or repeated.
    """
    nth = "nth"
    while nth in map(str.lower, docs.columns):
        nth += "_"
    rows = stored(docs.withColumn(nth, F.monotonically_increasing_id()))
    sketches, resolved = _classes(rows, key, text, nth)
    gone = (sketches.where("size > 0").select("row", "s1", "s2", "size").join(
        resolved.select("s1", "s2", "size", F.col("keeper.row").alias("keeper")).hint("merge"), ["s1", "s2", "size"])
        .where("row <> keeper").select(F.col("row").alias(nth)))
    return rows.join(gone, nth, "left_anti").drop(nth)


def op10_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))


QUERIES = {"op10_chosen_path": op10_chosen_path}
ORACLES: dict[str, str] = {}
