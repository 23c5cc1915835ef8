"""Benchmark passages in documents: CGK embedding, bit-sampling LSH, exact edit distance.

Texts are lower-cased and cut into words (runs of ASCII letters, digits and all non-ASCII
characters). A document holds an item if some stretch of its words is within an edit
distance (word insertions, deletions, replacements) of a fifth of the item's words, rounded
down: similarity 0.8 or more.

A CGK walk reads a word sequence by a pointer that moves on by a random bit of (step,
word) and outputs the word it stands on; sequences at small edit distance fall back into
step, so their outputs differ in few places. Each repetition samples a few output places.
Windows start at every word of every document and at every word of every item (an
item-sized window that begins inside the item finds items whose start was edited), so an
item is found as soon as one of its windows agrees with the document's in the sampled
places of one repetition. Every candidate is verified by exact edit distance over the whole
item. Windows are followed only as long as the sampled words seen so far occur together in
some item, which skips no agreement.

The items are the query set: they are taken in blocks of bounded size, each block against
all documents in one narrow pass; documents are never shuffled.

Defined results: null and wordless documents hold nothing; null and wordless items are never
found; items below five words are found only exactly; rows of the items that are equal are
one; repeated documents give repeated rows; an empty table gives no rows. Documents' further
columns are not read by ``find`` and are kept by ``clean``.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from folioweave.llm.common import mix64, parts, ranges_of, table, text_buffer, word_hashes

SIMILARITY, REPETITIONS, PLACES, STEPS, SEED = 0.8, 6, 7, 16, 5
BLOCK_WORDS, SHORT = 200_000, 12

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = True
_WORD[128:] = True


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts and the first word of each text."""
    data, offsets = text_buffer(column)
    starts, ends = ranges_of(_WORD[data], offsets)
    return word_hashes(data, starts, ends), np.searchsorted(starts, offsets)


def sampled_places(repetition: int) -> np.ndarray:
    random = np.random.default_rng([SEED, repetition])
    return np.sort(np.r_[0, random.choice(np.arange(1, STEPS), PLACES - 1, replace=False)])


def _bits(repetition: int, symbols: int) -> np.ndarray:
    """The random bit of every (step, word) of a repetition's walk."""
    n = np.arange(STEPS * symbols, dtype=np.uint64) + np.uint64(repetition << 40)
    return (mix64(mix64(n) + np.uint64(SEED)) >> np.uint64(17) & np.uint64(1)).astype(
        np.int64).reshape(STEPS, symbols)


_KEY = np.uint64(0x2545F4914F6CDD1D)


class ItemIndex:
    """Sampled embeddings of all windows of a bounded block of items."""

    def __init__(self, texts: list[str]):
        hashes, first = words_of(pa.array(texts, pa.string()))
        self.vocabulary = np.unique(hashes)
        symbols = (np.searchsorted(self.vocabulary, hashes) + 1).astype(np.int32)
        self.items = [symbols[a:b].tolist() for a, b in zip(first[:-1], first[1:])]
        self.sets = [frozenset(i) for i in self.items]
        size = 1 << max(16, math.ceil(math.log2(16 * len(self.vocabulary) + 1)))
        self.known = np.zeros(size, bool)
        self.known[(self.vocabulary & np.uint64(size - 1)).astype(np.int64)] = True
        # items are laid out one after another; zeros keep a walk from leaving its item
        length = np.diff(first)
        item = np.repeat(np.arange(len(length)), length)
        offset = np.arange(len(symbols)) - np.repeat(first[:-1], length)
        end = np.repeat(first[1:], length)
        small = np.repeat(length <= SHORT, length)
        padded = np.concatenate([symbols, np.zeros(STEPS + 1, np.int32)])
        self.walks = []
        for r in range(REPETITIONS):
            bits, places = _bits(r, len(self.vocabulary) + 1), sampled_places(r)
            at, key = np.arange(len(symbols)), np.zeros(len(symbols), np.uint64)
            live = np.ones(len(symbols), bool)
            seen, short = [], []
            depth = 0
            for step in range(int(places[-1]) + 1):
                if step == places[depth]:
                    inside = live & (at < end)
                    # the walk leaves the item: short items keep the places they have
                    cut = np.flatnonzero(live & ~inside & (
                        (offset == 0) | (small & (depth >= 3))))
                    short.append((key[cut], cut))
                    live = inside
                    key = np.where(live, (key + padded[np.minimum(at, len(symbols))].astype(
                        np.uint64)) * _KEY, key)
                    seen.append(np.unique(key[live]))
                    depth += 1
                at = np.where(live, at + bits[step, padded[np.minimum(at, len(symbols))]], at)
            short.append((key[live], np.flatnonzero(live)))
            self.walks.append((places, bits, [_Member(s) for s in seen],
                               [_Find(k, item[w], offset[w]) for k, w in short]))

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes), np.int32)
        if len(self.vocabulary):
            likely = np.flatnonzero(self.known[(hashes & np.uint64(len(self.known) - 1)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.vocabulary, hashes[likely]), len(self.vocabulary) - 1)
            real = self.vocabulary[at] == hashes[likely]
            out[likely[real]] = at[real] + 1
        return out

    def candidates(self, symbols: np.ndarray):
        """(place of the item's first word, item) of all agreements, once each."""
        padded = np.concatenate([symbols, np.zeros(STEPS + 1, np.int32)])
        known = np.flatnonzero(symbols)
        out = []
        for places, bits, members, finds in self.walks:
            start, at, key = known, known, np.zeros(len(known), np.uint64)
            depth = 0
            for step in range(int(places[-1]) + 1):
                if not len(start):
                    break
                here = padded[at]
                if step == places[depth]:
                    if depth and finds[depth].any:
                        out.append(finds[depth].hits(key, start))
                    key = (key + here.astype(np.uint64)) * _KEY
                    live = members[depth].maybe(key) & (here > 0)
                    start, at, key, here = start[live], at[live], key[live], here[live]
                    depth += 1
                at = at + bits[step][here]
            if depth == PLACES and len(start):
                out.append(finds[PLACES].hits(key, start))
        if not out:
            return np.empty((0, 2), np.int64)
        return np.unique(np.vstack(out), axis=0)

    def verify(self, symbols: list[int], item: int, place: int):
        """The best stretch around a place: (distance, first word, end), or None."""
        want = self.items[item]
        k = int(len(want) * (1 - SIMILARITY) + 1e-9)
        low, high = max(0, place - k), min(len(symbols), place + len(want) + k)
        window = symbols[low:high]
        mine = self.sets[item]
        if len(mine.difference(window)) > k:        # each absent word takes an edit
            return None
        best = nearest_stretch(want, window)
        return (best[0], low + best[1], low + best[2]) if best[0] <= k else None


class _Member:
    """Possible membership of keys: a table by hash, no false negatives."""

    def __init__(self, keys: np.ndarray):
        size = 1 << max(14, math.ceil(math.log2(16 * len(keys) + 1)))
        self.shift = np.uint64(64 - int(math.log2(size)))
        self.table = np.zeros(size, bool)
        self.table[(mix64(keys) >> self.shift).astype(np.int64)] = True

    def maybe(self, keys: np.ndarray) -> np.ndarray:
        return self.table[(mix64(keys) >> self.shift).astype(np.int64)]


class _Find:
    def __init__(self, keys: np.ndarray, item: np.ndarray, offset: np.ndarray):
        order = np.argsort(keys, kind="stable")
        self.keys, self.item, self.offset = keys[order], item[order], offset[order]
        self.any = len(keys) > 0

    def hits(self, keys: np.ndarray, start: np.ndarray) -> np.ndarray:
        low, high = np.searchsorted(self.keys, keys), np.searchsorted(self.keys, keys, "right")
        many = high - low
        row = np.repeat(np.arange(len(keys)), many)
        at = np.repeat(low - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(many.sum())
        return np.column_stack([start[row] - self.offset[at], self.item[at]])


def nearest_stretch(want: list[int], window: list[int]) -> tuple[int, int, int]:
    """(edit distance, first, end) of the stretch of ``window`` nearest to ``want``.

    Ties go to the stretch that ends, then begins first.
    """
    n = len(window)
    cost, begin = [0] * (n + 1), list(range(n + 1))
    for i, w in enumerate(want, 1):
        diagonal, from_there = cost[0], begin[0]
        cost[0] = i
        for j, x in enumerate(window, 1):
            best, source = diagonal + (w != x), from_there
            diagonal, from_there = cost[j], begin[j]
            if diagonal + 1 < best or (diagonal + 1 == best and begin[j] < source):
                best, source = diagonal + 1, begin[j]
            if cost[j - 1] + 1 < best or (cost[j - 1] + 1 == best and begin[j - 1] < source):
                best, source = cost[j - 1] + 1, begin[j - 1]
            cost[j], begin[j] = best, source
    end = min(range(n + 1), key=cost.__getitem__)
    return cost[end], begin[end], end


_indexes: dict[str, ItemIndex] = {}


def _index(texts: list[str]) -> ItemIndex:
    """A worker builds the index of a block of items once."""
    name = hashlib.sha256("\0".join(texts).encode()).hexdigest()
    if name not in _indexes:
        _indexes.clear()
        _indexes[name] = ItemIndex(texts)
    return _indexes[name]


def matches(index: ItemIndex, column: pa.Array):
    """(row, item, distance, first word, end) of every item found, its best stretch."""
    hashes, first = words_of(column)
    symbols = index.symbols(hashes)
    found = index.candidates(symbols)
    if not len(found):
        return
    # a shift of an item's start by edits stays below its allowed distance; any word of the
    # match inside the document names the document
    inner = np.clip(found[:, 0], 0, len(symbols) - 1)
    row = np.searchsorted(first, inner, "right") - 1
    spread = np.array([int(len(i) * (1 - SIMILARITY) + 1e-9) for i in index.items])
    best: dict[tuple[int, int], tuple] = {}
    held = (-1, None)
    for (place, item), r in zip(found.tolist(), row.tolist()):
        for near in {r, *_neighbours(first, place, spread[item], len(index.items[item]))}:
            now = best.get((near, item))
            if now is not None and now[0] == 0:
                continue
            if held[0] != near:
                held = (near, symbols[first[near]:first[near + 1]].tolist())
            got = index.verify(held[1], item, place - int(first[near]))
            if got is not None and (now is None or got < now):
                best[(near, item)] = got
    for (r, item), (distance, start, end) in sorted(best.items()):
        yield r, item, distance, start, end


def _neighbours(first: np.ndarray, place: int, spread: int, length: int):
    """Documents beside the one a place names, if edits could have shifted it across."""
    low = np.searchsorted(first, max(place - spread, 0), "right") - 1
    high = np.searchsorted(first, min(place + length // 2, first[-1] - 1), "right") - 1
    return range(int(low), int(high) + 1) if high - low < 4 else (int(low), int(high))


def item_blocks(items: DataFrame, key: str, text: str):
    """The items in blocks of about ``BLOCK_WORDS`` words, one on the driver at a time."""
    content = F.lower(F.coalesce(F.col(text), F.lit("")))
    rows = items.select(F.col(key).alias("item"), content.alias("t")).dropDuplicates()
    # a word takes two characters at least, so characters bound the words
    chars = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = max(1, math.ceil(chars / 2 / BLOCK_WORDS))
    for b in range(blocks):
        mine = rows.where(F.pmod(F.xxhash64("item", "t"), F.lit(blocks)) == b).orderBy("item", "t")
        got = mine.collect()
        if got:
            yield [r["item"] for r in got], [r["t"] for r in got]


def find(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
         item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row for each document and item found in it, with its best stretch of words."""
    kind, item_kind = docs.schema[key].dataType.simpleString(), items.schema[item_key].dataType.simpleString()
    schema = (f"doc_id {kind}, item_id {item_kind}, distance int, item_words int, similarity double, "
              "first_word int, end_word int")
    rows = docs.select(F.col(key).alias("doc_id"), F.lower(F.coalesce(F.col(text), F.lit(""))).alias("t"))
    out = None
    for ids, texts in item_blocks(items, item_key, item_text):
        def run(batches, ids=ids, texts=texts):
            index = _index(texts)
            names = pa.array(ids)
            for batch in batches:
                for low, n in parts(batch.column("t")):
                    got = list(matches(index, batch.column("t").slice(low, n)))
                    if got:
                        r, i, d, a, b = (np.array(x) for x in zip(*got))
                        size = np.array([len(index.items[x]) for x in i])
                        yield pa.RecordBatch.from_arrays(
                            [batch.column("doc_id").take(pa.array(low + r)), names.take(pa.array(i)),
                             pa.array(d.astype(np.int32)), pa.array(size.astype(np.int32)),
                             pa.array(1 - d / size), pa.array(a.astype(np.int32)),
                             pa.array(b.astype(np.int32))],
                            ["doc_id", "item_id", "distance", "item_words", "similarity",
                             "first_word", "end_word"])
        part = rows.mapInArrow(run, schema)
        out = part if out is None else out.unionAll(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def holds_item(texts: list[str], text: Column) -> Column:
    """True where a text holds any item of a block; a narrow Arrow function."""
    def run(column: pa.Array) -> pa.Array:
        index = _index(texts)
        out = np.zeros(len(column), bool)
        for low, n in parts(column):
            for r, *_ in matches(index, column.slice(low, n)):
                out[low + r] = True
        return pa.array(out)
    run.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "boolean")(F.lower(F.coalesce(text, F.lit(""))))


def clean(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id",
          item_text: str = "text") -> DataFrame:
    """The documents that hold no item, whole and with all their columns."""
    for _, texts in item_blocks(items, item_key, item_text):
        docs = docs.where(~holds_item(texts, F.col(text)))
    return docs


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op5_decontaminate": op5_decontaminate}
ORACLES: dict[str, str] = {}
