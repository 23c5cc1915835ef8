"""Quality scores: random Fourier features, ridge regression, isotonic calibration.

Twenty statistics of a whole text (shares of byte classes, word and line shapes,
repetition) are standardised and mapped to random Fourier features, which approximate a
Gaussian kernel. Every partition sums its share of the normal equations; their sum, of a
fixed size, is solved on the driver. Isotonic regression over fixed score bins turns ridge
scores into probabilities. Folds are remainders of crc32(id) by three: 0 fits the ridge
weights, 2 the calibration, 1 is held out; all labelled rows of a fold are used.

Defined results: null texts are empty, and an empty text has statistics of zero and gets a
score like any other; rows with a null id are scored and never learned from; a label is the
rounded mean of an id's labels, null labels are ignored; without any labelled row of a fold
the score is the known share of good documents, or 0.5. Repeated rows are scored alike.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DoubleType

from folioweave.llm.common import fold, parts, ranges_of, stored, table, text_buffer, word_hashes

FEATURES, RIDGE, SEED, BINS = 256, 1e-3, 20, 2048
STATS = 20

_CLASSES = np.zeros((8, 256), bool)          # lower, upper, digit, space, feed, stop, symbol, high
_CLASSES[0, 97:123] = _CLASSES[1, 65:91] = _CLASSES[2, 48:58] = True
_CLASSES[3, [9, 10, 11, 12, 13, 32]] = True
_CLASSES[4, 10] = True
_CLASSES[5, [ord(c) for c in ".,;:!?'\"()-"]] = True
_CLASSES[7, 128:] = True
_CLASSES[6] = ~_CLASSES[[0, 1, 2, 3, 5, 7]].any(axis=0)


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values, dtype=np.float64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def text_statistics(column: pa.Array) -> np.ndarray:
    """One row of statistics for each text."""
    data, offsets = text_buffer(column)
    n = np.diff(offsets).astype(np.float64)
    safe = np.maximum(n, 1)
    out = np.zeros((len(n), STATS))
    out[:, 0] = np.log1p(n)
    for k in range(8):
        out[:, 1 + k] = _sums(_CLASSES[k][data], offsets) / safe
    starts, ends = ranges_of(~_CLASSES[3][data], offsets)
    first = np.searchsorted(starts, offsets)
    words = np.diff(first).astype(np.float64)
    some = np.maximum(words, 1)
    length = (ends - starts).astype(np.float64)
    mean = _sums(length, first) / some
    out[:, 9] = np.log1p(words)
    out[:, 10] = mean
    out[:, 11] = np.sqrt(np.maximum(_sums(length ** 2, first) / some - mean ** 2, 0))
    if len(starts):
        hashes = word_hashes(data, starts, ends)
        row = np.repeat(np.arange(len(n)), np.diff(first))
        same = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
        out[:, 12] = np.bincount(row[1:][same], minlength=len(n)) / some
        _, seen = np.unique(hashes ^ (row.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)),
                            return_index=True)
        out[:, 13] = np.bincount(row[seen], minlength=len(n)) / some
        tail, head = data[ends - 1], data[starts]
        out[:, 14] = np.bincount(row[_CLASSES[6][tail]], minlength=len(n)) / some
        out[:, 15] = np.bincount(row[_CLASSES[1][head]], minlength=len(n)) / some
        out[:, 16] = np.bincount(row[length == 1], minlength=len(n)) / some
        out[:, 17] = np.bincount(row[length > 20], minlength=len(n)) / some
        out[:, 18] = np.bincount(row[_CLASSES[5][tail]], minlength=len(n)) / some
    out[:, 19] = np.log1p(n / (1 + out[:, 5] * n))
    return out


@dataclass(frozen=True)
class Model:
    """All of fixed size: standardisation, projection, weights and calibration steps."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    at: np.ndarray
    probability: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        return _fourier((stats - self.mean) / self.scale)

    def ridge(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.ridge(stats), self.at, self.probability), 0.0, 1.0)


def _fourier(x: np.ndarray) -> np.ndarray:
    """cos(Wx + b) of a kernel whose width is twice the root of the number of statistics."""
    random = np.random.default_rng(SEED)
    w = random.normal(size=(STATS, FEATURES)) / (2 * np.sqrt(STATS))
    b = random.uniform(0, 2 * np.pi, FEATURES)
    z = np.sqrt(2 / FEATURES) * np.cos(np.clip(x, -8, 8) @ w + b)
    return np.hstack([z, np.ones((len(x), 1))])


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("stats")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, STATS)


def _partial_sums(make):
    """A task that adds up one matrix over its partition and gives its rows by number."""
    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                got = make(batch)
                total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_pydict({
                "i": pa.array(np.arange(len(total), dtype=np.int32)),
                "v": pa.array(list(total), pa.list_(pa.float64()))})
    return run


def _summed(rows: DataFrame, make) -> np.ndarray | None:
    """The sum over all partitions; its size depends on the parameters alone."""
    pieces = rows.mapInArrow(_partial_sums(make), "i int, v array<double>")
    wide = pieces.select("i", F.posexplode("v").alias("j", "x"))
    total = wide.groupBy("i", "j").agg(F.sum("x").alias("x")).toPandas()
    if not len(total):
        return None
    out = np.zeros((total.i.max() + 1, total.j.max() + 1))
    out[total.i, total.j] = total.x
    return out


def pool_adjacent(score: np.ndarray, good: np.ndarray, n: np.ndarray):
    """Isotonic means of bins in ascending order of score."""
    blocks: list[list[float]] = []
    for s, g, c in zip(score, good, n):
        blocks.append([s * c, g, c])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            s2, g2, c2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s2, blocks[-1][1] + g2, blocks[-1][2] + c2]
    held = np.array(blocks)
    return held[:, 0] / held[:, 2], held[:, 1] / held[:, 2]


@F.arrow_udf(ArrayType(DoubleType()))
def _stats_udf(text: pa.Array) -> pa.Array:
    pieces = [text_statistics(text.slice(i, n)) for i, n in parts(text)]
    flat = np.vstack(pieces) if pieces else np.zeros((0, STATS))
    return pa.FixedSizeListArray.from_arrays(pa.array(flat.ravel()), STATS).cast(
        pa.list_(pa.float64()))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
        label: str = "quality") -> Model:
    known = (labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
             .groupBy(F.col(key).alias("k")).agg((F.avg(label) >= 0.5).cast("double").alias("y")))
    rows = docs.select(F.col(key).alias("k"), F.pmod(fold(key), F.lit(3)).alias("part"),
                       F.coalesce(F.col(text), F.lit("")).alias("t")).where("part <> 1")
    stats = stored(rows.select("k", "part", _stats_udf("t").alias("stats")).join(known, "k"))
    fitted, tuned = stats.where("part = 0"), stats.where("part = 2")

    def moments(batch):
        x = _matrix(batch)
        y = batch.column("y").to_numpy()
        return np.vstack([np.full(STATS, len(x)), x.sum(0), (x ** 2).sum(0), np.full(STATS, y.sum())])

    first = _summed(fitted, moments)
    if first is None:
        share = stats.agg(F.avg("y")).first()[0]
        flat = np.array([0.5 if share is None else share])
        return Model(np.zeros(STATS), np.ones(STATS), np.zeros(FEATURES + 1), np.zeros(1), flat)
    count = first[0, 0]
    mean = first[1] / count
    scale = np.sqrt(np.maximum(first[2] / count - mean ** 2, 0))
    scale[scale < 1e-9] = 1.0
    blank = Model(mean, scale, np.zeros(FEATURES + 1), np.zeros(1), np.zeros(1))

    def normal(batch):
        z = blank.features(_matrix(batch))
        y = batch.column("y").to_numpy()
        return np.hstack([z.T @ z, (z.T @ y)[:, None]])

    equations = _summed(fitted, normal)
    gram = equations[:, :-1]
    weights = np.linalg.solve(gram + RIDGE * count * np.eye(len(gram)) / FEATURES, equations[:, -1])
    ridge = Model(mean, scale, weights, np.zeros(1), np.zeros(1))

    def histogram(batch):
        s = np.clip(ridge.ridge(_matrix(batch)), -0.5, 1.5)
        y = batch.column("y").to_numpy()
        slot = np.minimum(((s + 0.5) / 2 * BINS).astype(int), BINS - 1)
        return np.vstack([np.bincount(slot, w, BINS) for w in (np.ones(len(s)), y, s)])

    bins = _summed(tuned, histogram)
    if bins is None:
        return Model(mean, scale, weights, np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    used = bins[0] > 0
    at, probability = pool_adjacent(bins[2][used] / bins[0][used], bins[1][used], bins[0][used])
    return Model(mean, scale, weights, at, probability)


def score_column(model: Model, text: Column) -> Column:
    """The calibrated score of a text column; a narrow Arrow function."""
    def run(column: pa.Array) -> pa.Array:
        pieces = [model.score(text_statistics(column.slice(i, n))) for i, n in parts(column)]
        return pa.array(np.concatenate(pieces) if pieces else np.zeros(0))
    run.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "double")(F.coalesce(text, F.lit("")))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return docs.select(
        "doc_id", F.coalesce(F.pmod(fold("doc_id"), F.lit(3)) == 1, F.lit(True)).alias("held_out"),
        score_column(model, F.col("text")).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


QUERIES = {"op8_quality": op8_quality}
ORACLES: dict[str, str] = {}
