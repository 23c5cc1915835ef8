"""Language-model scores by deleted interpolation of n-gram relative frequencies.

The probability of a word after another is a mixture of the bigram's relative frequency, the
word's, and a uniform floor. The three weights depend on how often the context was seen (a
bucket for every power of two) and are learned by expectation-maximisation on documents that
were left out of the counts used for it; scores use the counts of all training documents.

Counts travel packed. A batch of documents is one row: its words' hashes and its tokens as
places among them. It asks for the counts of its distinct words and bigrams by sorted key
blocks, one row for each key range; the tasks of a range add up all batches' counts and
answer every batch. A word that stands in every document is one key per batch, so no key
is hot. Batches, answers and statistics are stored in the shared folder. Ranges follow the
amount of text, so a range's task is bounded; the driver sees fixed-size histograms only.

Tokens: words are runs of bytes other than space and the five control spaces, A to Z
lower-cased; an end follows each text and counts as a token; it is also the context of the
first word. Folds are remainders of crc32(id) by ten: 0 is held out, 1 trains the weights.

Defined results: null texts are empty and hold the end alone; rows with a null id are held
out; repeated rows count and score one by one; without training text every token has the
floor's probability. Further columns of the input are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
import zstandard

from folioweave.llm.common import MIX, fold, mix64, parts, ranges_of, stored, table, text_buffer, word_hashes

BUCKETS, ROUNDS, PRIOR, RANGE_BYTES = 24, 60, 100.0, 16 << 20
PER_OCTAVE, OCTAVES = 4, 40
MAIN, TUNING, HELD = 0, 1, 2

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.ones(256, bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False
END = np.uint64(0xE0D0E0D0E0D0E0D1)


def _squeeze(values: np.ndarray) -> bytes:
    """Integers as byte planes, compressed."""
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _expand(blob: bytes, kind) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _squeeze_sorted(keys: np.ndarray) -> bytes:
    return _squeeze(np.diff(keys, prepend=np.uint64(0)))


def _expand_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(_expand(blob, np.uint64), dtype=np.uint64)


def tokens_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens and the number of tokens of each text."""
    data, offsets = text_buffer(column)
    data = _LOWER[data]
    starts, ends = ranges_of(_WORD[data], offsets)
    first = np.searchsorted(starts, offsets)
    n = np.diff(first) + 1
    out = np.full(int(n.sum()), END, np.uint64)
    place = np.arange(len(starts)) + np.repeat(np.arange(len(n)), np.diff(first))
    out[place] = word_hashes(data, starts, ends)
    return out, n


def _pack(kind_of_id):
    def run(batches):
        task, count = TaskContext.get().partitionId(), 0
        for batch in batches:
            for low, rows in parts(batch.column("text"), 8 << 20):
                piece = batch.slice(low, rows)
                hashes, n = tokens_of(piece.column("text"))
                fold_of = piece.column("fold").to_numpy()
                row = np.repeat(fold_of, n)
                for fold_ in np.unique(fold_of).tolist():
                    mine = np.flatnonzero(fold_of == fold_)
                    words, place = np.unique(hashes[row == fold_], return_inverse=True)
                    yield pa.RecordBatch.from_pydict({
                        "batch": pa.array([(task << 32) + count]), "fold": pa.array([fold_], pa.int32()),
                        "ids": pa.array([piece.column("id").take(pa.array(mine)).to_pylist()],
                                        pa.list_(kind_of_id)),
                        "lens": pa.array([n[mine].tolist()], pa.list_(pa.int64())),
                        "n": pa.array([int(n[mine].sum())]),
                        "words": pa.array([_squeeze_sorted(words)], pa.binary()),
                        "tokens": pa.array([_squeeze(place.astype(np.uint32))], pa.binary())})
                    count += 1
    return run


@dataclass
class _Batch:
    """One batch's distinct keys, sorted, and where its words and tokens find theirs."""

    keys: np.ndarray
    counts: np.ndarray
    word_at: np.ndarray         # key of every distinct word
    token: np.ndarray           # distinct word of every token
    context: np.ndarray         # distinct word before every token
    pair_at: np.ndarray         # key of every token's bigram

    @classmethod
    def of(cls, words: bytes, tokens: bytes) -> "_Batch":
        w, token = _expand_sorted(words), _expand(tokens, np.uint32).astype(np.int64)
        end = int(np.searchsorted(w, END))
        context = np.r_[end, token[:-1]]
        pairs, pair, seen = np.unique(context * len(w) + token, return_inverse=True, return_counts=True)
        one = mix64(w ^ MIX) & ~np.uint64(1)
        two = mix64(w[pairs // len(w)] * np.uint64(0x9FB21C651E98DF25) + mix64(w[pairs % len(w)])) | np.uint64(1)
        both = np.r_[one, two]
        order = np.argsort(both, kind="stable")
        at = np.empty(len(both), np.int64)
        at[order] = np.arange(len(both))
        counts = np.r_[np.bincount(token, minlength=len(w)), seen][order]
        return cls(both[order], counts, at[:len(w)], token, context, at[len(w):][pair])


def _ask(bits: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                held = _Batch.of(row["words"], row["tokens"])
                part = (held.keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(held.keys), int)
                heads = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
                for a, b in zip(heads.tolist(), np.r_[heads[1:], len(part)].tolist()):
                    yield pa.RecordBatch.from_pydict({
                        "part": pa.array([int(part[a])], pa.int64()), "batch": pa.array([row["batch"]]),
                        "fold": pa.array([row["fold"]], pa.int32()),
                        "keys": pa.array([_squeeze_sorted(held.keys[a:b])], pa.binary()),
                        "counts": pa.array([_squeeze(held.counts[a:b].astype(np.int64))], pa.binary())})
    return run


_ANSWER = ("batch long, fold int, part long, main binary, train binary, n_main long, n_train long")


def _answer(group: pa.Table) -> pa.Table:
    """Add up a key range over all batches and answer each; one more row tells vocabularies."""
    rows = group.select(["batch", "fold", "keys", "counts"]).to_pylist()
    part = group["part"][0].as_py()
    keys = [_expand_sorted(r["keys"]) for r in rows]
    counts = [_expand(r["counts"], np.int64) for r in rows]
    all_keys, place = np.unique(np.concatenate(keys), return_inverse=True)
    by_fold = np.repeat([r["fold"] for r in rows], [len(k) for k in keys])
    flat = np.concatenate(counts)
    total = [np.bincount(place[by_fold == f], flat[by_fold == f], len(all_keys)).astype(np.int64)
             for f in (MAIN, TUNING)]
    train = total[0] + total[1]
    word = (all_keys & np.uint64(1)) == 0
    bounds = np.r_[0, np.cumsum([len(k) for k in keys])]
    out = {"batch": [r["batch"] for r in rows] + [-1], "fold": [r["fold"] for r in rows] + [-1],
           "part": [part] * (len(rows) + 1),
           "main": [_squeeze(total[0][place[a:b]]) if r["fold"] == TUNING else None
                    for r, a, b in zip(rows, bounds[:-1], bounds[1:])] + [None],
           "train": [_squeeze(train[place[a:b]]) for a, b in zip(bounds[:-1], bounds[1:])] + [None],
           "n_main": [0] * len(rows) + [int((word & (total[0] > 0)).sum())],
           "n_train": [0] * len(rows) + [int((word & (train > 0)).sum())]}
    return pa.table(out, pa.schema([("batch", pa.int64()), ("fold", pa.int32()), ("part", pa.int64()),
                                    ("main", pa.binary()), ("train", pa.binary()), ("n_main", pa.int64()),
                                    ("n_train", pa.int64())]))


def _answered(answers: pa.Table, column: str) -> np.ndarray:
    order = np.argsort(answers["part"].to_numpy())
    return np.concatenate([_expand(answers[column][i].as_py(), np.int64) for i in order.tolist()])


def _bucket(context: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else one more than the logarithm of its count.

    Counts of all training text are scaled to the text that the weights were learned with.
    """
    return np.minimum(np.where(context > 0, 1 + np.log2(np.maximum(context, 1)), 0).astype(np.int64), BUCKETS - 1)


def _frequencies(held: _Batch, counts: np.ndarray, n: int):
    word = counts[held.word_at]
    context = word[held.context]
    return (context, counts[held.pair_at] / np.maximum(context, 1), word[held.token] / max(n, 1),
            word[held.token])


def _step(x: np.ndarray) -> np.ndarray:
    """0 for zero, else a bin of the logarithm."""
    safe = np.where(x > 0, x, 1)
    return np.where(x > 0, 1 + np.clip((np.log2(safe) + OCTAVES) * PER_OCTAVE, 0, OCTAVES * PER_OCTAVE), 0).astype(np.int64)


_BINS = OCTAVES * PER_OCTAVE + 2


def _tune(n_main: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        cells, seen = np.empty(0, np.int64), np.empty(0, np.int64)
        if left.num_rows and right.num_rows:
            held = _Batch.of(left["words"][0].as_py(), left["tokens"][0].as_py())
            context, two, one, _ = _frequencies(held, _answered(right, "main"), n_main)
            cells, seen = np.unique((_bucket(context) * _BINS + _step(two)) * _BINS + _step(one), return_counts=True)
        return pa.table({"cell": pa.array(cells), "n": pa.array(seen)})
    return run


def mixture(cells: np.ndarray, n: np.ndarray, floor: float) -> np.ndarray:
    """Weights (bigram, word, floor) of every context bucket by expectation-maximisation."""
    def value(step):
        return np.where(step > 0, 2.0 ** ((step - 0.5) / PER_OCTAVE - OCTAVES), 0.0)

    def learned(mine, weights, prior, mass):
        for _ in range(ROUNDS):
            share = parts_[mine] * weights
            share *= (n[mine] / share.sum(axis=1))[:, None]
            weights = (share.sum(axis=0) + mass * prior) / (share.sum() + mass)
        weights = np.maximum(weights, [0, 0, 1e-6])
        return weights / weights.sum()

    bucket, two, one = cells // _BINS ** 2, value(cells // _BINS % _BINS), value(cells % _BINS)
    parts_ = np.column_stack([two, one, np.full(len(cells), floor)])
    start = np.array([0.4, 0.5, 0.1])
    pooled = learned(bucket > 0, start, start, 1.0)
    unseen = learned(bucket == 0, np.array([0.0, 0.9, 0.1]), np.array([0.0, 0.9, 0.1]), 1.0)
    # a bucket with little text leans on the weights of all seen contexts
    return np.vstack([unseen, *[learned(bucket == b, pooled, pooled, PRIOR) for b in range(1, BUCKETS)]])


def _score(weights: np.ndarray, n: int, v: int, scale: float):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = {"id": left["ids"].type.value_type, "fold": pa.int32(), "n_tokens": pa.int64(),
                  "n_known": pa.int64(), "base_score": pa.float64(), "score": pa.float64()}
        if not left.num_rows:
            return pa.table({k: pa.array([], t) for k, t in schema.items()})
        held = _Batch.of(left["words"][0].as_py(), left["tokens"][0].as_py())
        context, two, one, count = _frequencies(held, _answered(right, "train"), n)
        mix = weights[_bucket(context * scale)]
        model = np.log10(mix[:, 0] * two + mix[:, 1] * one + mix[:, 2] / (v + 1))
        base = np.log10((count + 0.1) / (n + 0.1 * (v + 1)))
        lens = np.array(left["lens"][0].as_py(), np.int64)
        heads = np.r_[0, np.cumsum(lens)[:-1]]
        return pa.table({
            "id": left["ids"].combine_chunks().flatten(),
            "fold": pa.array(np.full(len(lens), left["fold"][0].as_py(), np.int32)),
            "n_tokens": pa.array(lens), "n_known": pa.array(np.add.reduceat((count > 0).astype(np.int64), heads)),
            "base_score": pa.array(np.add.reduceat(base, heads)), "score": pa.array(np.add.reduceat(model, heads))})
    return run


def score(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Both scores of every document; the weights are learned on the way."""
    kind = docs.schema[key].dataType
    part = F.pmod(fold(key), F.lit(10))
    rows = docs.select(
        F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.when(part > 1, MAIN).when(part == 1, TUNING).otherwise(HELD).alias("fold"))
    from pyspark.sql.pandas.types import to_arrow_type
    packed = stored(rows.mapInArrow(_pack(to_arrow_type(kind)), (
        f"batch long, fold int, ids array<{kind.simpleString()}>, lens array<long>, n long, words binary, tokens binary")))
    sizes = {r["fold"]: r["n"] for r in packed.groupBy("fold").agg(F.sum("n").alias("n")).collect()}
    n_main = sizes.get(MAIN, 0)
    n_train = n_main + sizes.get(TUNING, 0)
    # a token stands for about six bytes of text
    bits = max(0, math.ceil(math.log2(max(1, 6 * sum(sizes.values()) / RANGE_BYTES))))
    asked = packed.select("batch", "fold", "words", "tokens").mapInArrow(
        _ask(bits), "part long, batch long, fold int, keys binary, counts binary")
    answers = stored(asked.groupBy("part").applyInArrow(_answer, _ANSWER))
    known = answers.where("batch = -1").agg(F.sum("n_main"), F.sum("n_train")).first()
    v_main, v_train = known[0] or 0, known[1] or 0
    slim = packed.select("batch", "fold", "words", "tokens").where(F.col("fold") == TUNING)
    cells = (slim.groupBy("batch").cogroup(answers.where(F.col("fold") == TUNING).select("batch", "part", "main")
                                           .groupBy("batch"))
             .applyInArrow(_tune(n_main), "cell long, n long")
             .groupBy("cell").agg(F.sum("n").alias("n")).toPandas())
    weights = mixture(cells["cell"].to_numpy(np.int64), cells["n"].to_numpy(np.float64), 1 / (v_main + 1))
    scored = packed.groupBy("batch").cogroup(
        answers.where("batch <> -1").select("batch", "part", "train").groupBy("batch")).applyInArrow(
        _score(weights, n_train, v_train, n_main / n_train if n_train else 1.0),
        f"id {kind.simpleString()}, fold int, n_tokens long, n_known long, base_score double, score double")
    return scored.select(
        F.col("id").alias("doc_id"), (F.col("fold") == HELD).alias("held_out"), "n_tokens", "n_known",
        F.lit(n_train).cast("long").alias("train_tokens"), "base_score", "score")


def op6_interpolated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))


QUERIES = {"op6_interpolated_lm": op6_interpolated_lm}
ORACLES: dict[str, str] = {}
