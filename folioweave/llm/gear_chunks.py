"""Substring deduplication by content-defined chunks.

A gear hash rolls over the UTF-8 bytes of a text: h = 2h + G[byte] modulo 2^16, so it depends on
the last 16 bytes only. A chunk ends where the hash's top bits are zero, at least ``LEAST`` bytes
after it began and at most ``MOST``; ends follow the content, so an insertion shifts the
chunks around it and leaves the others as they were. Chunks are compared by 128-bit
digests; the first occurrence over the corpus, by (document, text, row, position), stays.
A last chunk below ``LEAST`` bytes is compared together with the chunk before it, or, where it is
the whole text, as a whole text.

Later occurrences that touch form runs. A run of ``RUN`` bytes or more is a repeated passage and is cut
out, and so is any run that is the whole text; a shorter one, such as a phrase or a common line that two texts
happen to share, stays. Rows equal in id and text are told apart by a row number, fixed in a stored
table: the first is treated like any text, the others go whole.

Defined results: null texts are empty; chunks end between characters, so texts stay valid; rows
that share only the id are told apart by their texts; a null id sorts first. An empty table gives no rows.
Further columns are kept; ``spans`` replaces a column of that name.
"""

from __future__ import annotations

from bisect import bisect_left
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

from folioweave.llm.common import mix64, parts, stored, table, text_buffer

LEAST, MOST, BITS, SEED = 16, 256, 5, 2
RUN = 80
WIDTH = 16  # bits of the hash, thus bytes of its window: no more than LEAST, so that a chunk decides its own end
_GEAR = (mix64(np.arange(256, dtype=np.uint64) + np.uint64(SEED << 20)) >> np.uint64(48)).astype(np.uint16)


def ends_of(data: np.ndarray) -> np.ndarray:
    """Places where a chunk may end: the gear hash of the ``WIDTH`` bytes before has zero top bits."""
    h = _GEAR[data]
    for k in (1, 2, 4, 8):
        grown = h.copy()
        grown[k:] += h[:-k] << np.uint16(k) if len(h) > k else 0
        h = grown
    fits = h < np.uint16(1 << (WIDTH - BITS))
    fits[:-1] &= (data[1:] & 0xC0) != 0x80
    return np.flatnonzero(fits) + 1


def chunk_bounds(data: np.ndarray, offsets: np.ndarray):
    """(row, start, end) of all chunks; ends of a row depend on its own bytes alone."""
    places = ends_of(data).tolist() if len(data) else []
    rows, starts, ends = [], [], []
    for row, (low, high) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        at = bisect_left(places, low + LEAST)
        start = low
        while start < high:
            at = bisect_left(places, start + LEAST, at)
            end = places[at] if at < len(places) else high
            if end > start + MOST:
                end = start + MOST
                while end < high and data[end] & 0xC0 == 0x80:
                    end += 1
            end = min(end, high)
            rows.append(row)
            starts.append(start)
            ends.append(end)
            start = end
    return np.array(rows, np.int64), np.array(starts, np.int64), np.array(ends, np.int64)


def _chunks(batches):
    for batch in batches:
        for low, n in parts(batch.column("text"), 1 << 20):  # about 20 bytes of lists for each of text
            data, offsets = text_buffer(batch.column("text").slice(low, n))
            row, start, end = chunk_bounds(data, offsets)
            # a short last chunk is digested with the one before it, and never equals a chunk of other texts' middle
            short = end - start < LEAST
            begin = np.where(short & (start > offsets[row]), np.roll(start, 1), start)
            view = memoryview(data.tobytes())
            digest = np.frombuffer(b"".join(
                hashlib.blake2b(view[a:b], digest_size=16, person=b"last" if last else b"").digest()
                for a, b, last in zip(begin.tolist(), end.tolist(), short.tolist())), np.int64).reshape(-1, 2)
            at = pa.array(low + row)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(at), batch.column("t").take(at),
                 pa.array((start - offsets[row]).astype(np.int32)), pa.array((end - offsets[row]).astype(np.int32)),
                 pa.array(digest[:, 0]), pa.array(digest[:, 1])],
                ["id", "t", "start", "end", "d1", "d2"])


def repeated_chunks(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, t, chunks): later occurrences of chunks, for documents that have any.

    Equal rows are one document here. Half-digests are counted with combining on the map
    side, so a chunk that a third of all documents share is a row per task; only chunks of
    repeated half-digests stay and are compared by whole digests.
    """
    kind = docs.schema[key].dataType.simpleString()
    content = F.coalesce(F.col(text), F.lit(""))
    spots = docs.select(F.col(key).alias("id"), F.xxhash64(content).alias("t"), content.alias("text")).mapInArrow(
        _chunks, f"id {kind}, t long, start int, end int, d1 long, d2 long")
    counts = stored(spots.groupBy("d1").agg(F.count("*").alias("n")).where("n > 1").select("d1"))
    again = stored(spots.join(counts.hint("merge"), "d1"))
    first = stored(again.groupBy("d1", "d2").agg(
        F.count("*").alias("n"), F.min(F.struct("id", "t", "start")).alias("first")).where("n > 1").drop("n"))
    later = again.join(first.hint("merge"), ["d1", "d2"]).where(
        ~F.struct("id", "t", "start").eqNullSafe(F.col("first")))
    return later.groupBy("id", "t").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("chunks"))


_SPANS = "array<struct<start: int, end: int>>"


def runs_of(chunks: list[dict], size: int) -> list[dict]:
    """Touching chunks, in order, joined; long runs and those that are the whole text."""
    runs: list[dict] = []
    for chunk in chunks:
        if runs and runs[-1]["end"] == chunk["start"]:
            runs[-1]["end"] = chunk["end"]
        else:
            runs.append(dict(chunk))
    return [r for r in runs if r["end"] - r["start"] >= min(RUN, size)]


def _runs(chunks: pa.Array, size: pa.Array) -> pa.Array:
    return pa.array([c and runs_of(c, n) for c, n in zip(chunks.to_pylist(), size.to_pylist())],
                    pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))


def _cut(text: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for content, gone in zip(text, spans):
        gone = gone.as_py()
        if not gone:
            out.append(content.as_py())
            continue
        raw, kept, at = content.as_py().encode(), [], 0
        for span in gone:
            kept.append(raw[at:span["start"]])
            at = span["end"]
        out.append(b"".join([*kept, raw[at:]]).decode())
    return pa.array(out, pa.string())


_runs.__annotations__ = {"chunks": pa.Array, "size": pa.Array, "return": pa.Array}
_cut.__annotations__ = {"text": pa.Array, "spans": pa.Array, "return": pa.Array}


def dedup_substrings(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with repeated passages cut out, and the byte ``spans`` that went."""
    names = [c for c in docs.columns if c != "spans"]
    held = stored(docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
                              F.monotonically_increasing_id().alias("place")))
    content = F.coalesce(F.col(f"row.`{text}`"), F.lit(""))
    held = held.withColumns({"id": F.col(f"row.`{key}`"), "t": F.xxhash64(content)})
    gone = repeated_chunks(held.select(F.col("id").alias(key), content.alias(text)), key, text).select(
        "id", "t", "chunks", F.lit(None).cast("long").alias("first"))
    # the first of equal rows; one partial row per task for each
    firsts = held.groupBy("id", "t").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1")
    facts = gone.unionByName(firsts.drop("n").withColumn("chunks", F.lit(None).cast(_SPANS)))
    facts = facts.groupBy(F.col("id").alias("gid"), F.col("t").alias("gt")).agg(
        F.first("chunks", True).alias("chunks"), F.max("first").alias("first"))
    joined = held.join(facts, (F.col("t") == F.col("gt")) & F.col("id").eqNullSafe(F.col("gid")), "left")
    size = F.octet_length(content)
    whole = F.array(F.struct(F.lit(0).alias("start"), size.alias("end")))
    later = (F.col("place") > F.col("first")) & (size > 0)
    chunks = F.when(later, whole.cast(_SPANS)).otherwise(F.col("chunks"))
    told = joined.select("row", F.arrow_udf(_runs, _SPANS)(chunks, size).alias("spans"))
    spans = F.coalesce("spans", F.array().cast(_SPANS))
    kept = F.arrow_udf(_cut, StringType())(content, "spans")
    changed = F.when(F.size(spans) == 0, F.col(f"row.`{text}`")).otherwise(kept)
    return told.select(*[(changed.alias(c) if c == text else F.col(f"row.`{c}`").alias(c)) for c in names],
                       spans.alias("spans"))


def op2_gear_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op2_gear_chunks": op2_gear_chunks}
ORACLES: dict[str, str] = {}
