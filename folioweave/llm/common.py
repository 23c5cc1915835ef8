"""Shared helpers: tables, the shared work folder, materialisation and byte-level words."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MIX = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share.

    A checkpoint folder already set on the context is used where that setting is absent.
    Where neither is, a session of one process makes its own; on a cluster that is an error,
    as a machine-local folder would lose data.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="folioweave-")
        context.setCheckpointDir(root)
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(rows: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read again: cuts lineage, survives losses."""
    path = f"{work_folder(rows.sparkSession)}/stage"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def native_text(name: str = "text") -> Column:
    """The text column with null read as the empty string."""
    return F.coalesce(F.col(name), F.lit(""))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over unsigned 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an Arrow string column and the offsets of its rows (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], width)[
        column.offset:column.offset + len(column) + 1].astype(np.int64)
    if column.buffers()[2] is None or len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


_FACTOR = 0x5851F42D4C957F2D
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_SPAN = 1 << 19
_tables: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    held = _tables.get(base)
    if held is None or len(held) < n:
        held = np.full(max(n, _SPAN + 1), base, np.uint64)
        held[0] = 1
        held = np.multiply.accumulate(held)
        if n <= _SPAN + 1:
            _tables[base] = held
    return held[:n]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range [start, end), given in ascending order.

    A polynomial modulo 2^64 from prefix sums, mixed with the length. Bytes are taken half a
    megabyte at a time, so memory does not grow with the batch.
    """
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + _SPAN, "right")))
        part = data[base:ends[j - 1]]
        prefix = np.empty(len(part) + 1, np.uint64)
        prefix[0] = 0
        np.cumsum(_powers(_FACTOR, len(part)) * (part.astype(np.uint64) + np.uint64(1)),
                  out=prefix[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        value = (prefix[e] - prefix[s]) * _powers(_INVERSE, len(part) + 1)[s]
        out[i:j] = mix64(value ^ ((e - s).astype(np.uint64) * MIX))
        i = j
    return out


def ranges_of(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of true bytes; runs never cross the rows' bounds."""
    if not len(mask):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    first = mask.copy()
    first[1:] &= ~mask[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[heads] = mask[heads]
    starts = np.flatnonzero(first)
    last = mask.copy()
    last[:-1] &= ~mask[1:]
    tails = heads[1:] - 1
    last[tails] = mask[tails]
    return starts, np.flatnonzero(last) + 1


def parts(column: pa.Array, limit: int = 4 << 20):
    """(first row, rows) of stretches that each hold few bytes of text; rows stay whole."""
    sizes = np.diff(text_buffer(column)[1])
    begin, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > begin and held + size > limit:
            yield begin, i - begin
            begin, held = i, 0
        held += size
    if begin < len(column):
        yield begin, len(column) - begin


def fold(key: str) -> Column:
    """crc32 of an id as text; null for a null id."""
    return F.crc32(F.col(key).cast("string").cast("binary"))
