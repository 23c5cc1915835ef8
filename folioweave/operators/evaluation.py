"""Retrieval quality: where evidence lies, Recall@k, MRR, latency."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from folioweave.sources.files import shared_folder

# Lengths, in bytes, of the runs that phrases are looked up by.
RUNS = (16, 8, 4, 2, 1)
# Runs taken from a phrase, evenly spread; the one in the fewest texts is its key.
PICKS = 8
# The filter over the phrases' runs: bits a run, and the most bits there are (16 MB).
BITS_PER_RUN, MOST_BITS = 16, 1 << 27
_BASE = 0x9E3779B97F4A7C15
_PIECE = 1 << 22


def _run_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` bytes, a power of two, by doubling."""
    found, covered = data.astype(np.uint64) + np.uint64(1), 1
    while covered < size:
        step = np.uint64(pow(_BASE, covered, 1 << 64))
        found = found[:-covered] * step + found[covered:]
        covered *= 2
    found ^= found >> np.uint64(29)
    return found * np.uint64(_BASE)


def _buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offsets of its rows."""
    column = pa.compute.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    if len(column) == 0 or offsets[-1] == offsets[0]:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def _phrase_runs(phrases: DataFrame) -> DataFrame:
    """``phrase, size, runs``: hashes of up to ``PICKS`` runs of each phrase, of the longest size that fits."""
    def cut(batches):
        for batch in batches:
            sizes, runs = [], []
            for phrase in batch.column(0).to_pylist():
                data = np.frombuffer(phrase.encode(), np.uint8)
                size = next(s for s in RUNS if s <= len(data))
                at = np.unique(np.linspace(0, len(data) - size, PICKS).astype(np.int64))
                parts = np.concatenate([data[i:i + size] for i in at])
                sizes.append(size)
                runs.append(np.unique(_run_hashes(parts, size)[::size]).view(np.int64).tolist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int32()),
                                              pa.array(runs, pa.list_(pa.int64()))], ["phrase", "size", "runs"])

    return phrases.mapInArrow(cut, "phrase string, size int, runs array<long>")


def _filter(runs: DataFrame, most_bits: int) -> tuple[int, np.ndarray, list[int]]:
    """A bit for the leading bits of every run, as (bits of an index, bytes, run sizes in use)."""
    known = {row[0]: row[1] for row in runs.groupBy("size").count().collect()}
    wanted = min(max(sum(known.values()) * BITS_PER_RUN, 1 << 15), max(most_bits, 1 << 15))
    bits = wanted.bit_length() - 1
    index = F.shiftrightunsigned("run", 64 - bits) + 1
    rows = runs.groupBy(F.bitmap_bucket_number(index).alias("n")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(index)).alias("b")).collect()  # at most MOST_BITS
    held = np.zeros((1 << bits) // 8, np.uint8)
    for n, part in rows:
        held[(n - 1) * 4096:n * 4096] = np.frombuffer(bytes(part), np.uint8)
    return bits, held, sorted(known)


def _text_runs(texts: DataFrame, key: str, bits: int, held, sizes: list[int]) -> DataFrame:
    """``key, size, run`` for the runs of each text that pass the filter, mostly once a text."""
    def scan(batches):
        maybe = held.value
        for batch in batches:
            data, offsets = _buffer(batch.column(1))
            for size in sizes:
                for low in range(0, len(data) - size + 1, _PIECE):
                    hashes = _run_hashes(data[low:low + _PIECE + size - 1], size)
                    index = (hashes >> np.uint64(64 - bits)).astype(np.int64)
                    at = np.flatnonzero((maybe[index >> 3] >> (index & 7).astype(np.uint8)) & 1)
                    row = np.searchsorted(offsets, low + at, "right") - 1
                    inside = low + at + size <= offsets[row + 1]
                    pair = np.stack([row[inside], hashes[at[inside]].view(np.int64)], axis=1)
                    pair = np.unique(pair, axis=0)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(pair[:, 0])), pa.array(np.full(len(pair), size, np.int32)),
                         pa.array(pair[:, 1])], names=[key, "size", "run"])

    return texts.select(key, "text").mapInArrow(scan, T.StructType([
        texts.schema[key], T.StructField("size", T.IntegerType()), T.StructField("run", T.LongType())]))


def find_phrases(texts: DataFrame, phrases: DataFrame, key: str, most_bits: int = MOST_BITS) -> DataFrame:
    """All distinct ``(phrase_id, key)`` where a text of the key contains the phrase.

    ``texts`` has ``key, text`` and ``phrases`` has ``phrase_id, phrase``; both stay tables of any
    size. Phrases hand over a few runs of bytes each. One narrow pass over the texts keeps the runs
    that pass a filter of bounded size; a phrase is keyed by that run of it which the fewest texts
    hold, and is out if any of its runs is nowhere. Texts and phrases meet on that run, runs of many
    texts are split as skewed joins are, and an exact comparison decides. Null texts and null or
    empty phrases match nothing.
    """
    spark = texts.sparkSession
    phrases = phrases.where(F.length("phrase") > 0).select("phrase_id", "phrase")
    cut = _phrase_runs(phrases.select("phrase").distinct())
    runs = cut.select("phrase", "size", F.size("runs").alias("wanted"), F.explode("runs").alias("run"))
    bits, held, sizes = _filter(runs.select("size", "run").distinct(), most_bits)
    if not sizes:
        return phrases.select("phrase_id").limit(0).join(texts.select(key).limit(0))
    path = f"{shared_folder(spark)}/runs"
    _text_runs(texts, key, bits, spark.sparkContext.broadcast(held), sizes).write.parquet(path)
    hits = spark.read.parquet(path)
    met = hits.groupBy("size", "run").agg(F.count("*").alias("texts"))
    keyed = runs.join(met, ["size", "run"]).groupBy("phrase").agg(
        F.max("wanted").alias("wanted"), F.count("*").alias("found"),
        F.min(F.struct("texts", "size", "run")).alias("best")).where("found = wanted")
    pairs = hits.join(keyed.select("phrase", "best.size", "best.run"), ["size", "run"]).select(
        F.col(key).alias("_key"), "phrase")
    held_by = texts.select(key, "text").join(pairs, F.col(key).eqNullSafe(F.col("_key"))).where(
        F.contains("text", "phrase")).select(key, "phrase").distinct()
    return held_by.join(phrases, "phrase").select("phrase_id", key)


def found_evidence(hits: DataFrame, evidence: DataFrame) -> DataFrame:
    """Distinct evidence items shown by a question's hits, at their best rank.

    Overlapping passages that show the same item count once. ``hits`` has
    ``question_id, rank, paper_id, page_number, text``; ``evidence`` has
    ``question_id, paper_id, page, text``.
    """
    wanted = evidence.select("question_id", "paper_id", F.col("page").alias("page_number"),
                             F.col("text").alias("evidence"))
    shown = hits.join(wanted, ["question_id", "paper_id", "page_number"]).where(
        F.contains("text", "evidence"))
    return shown.groupBy("question_id", "paper_id", "page_number", "evidence").agg(
        F.min("rank").alias("rank"))


def per_question(questions: DataFrame, hits: DataFrame, evidence: DataFrame) -> DataFrame:
    """Recall and reciprocal rank per question; both null without labelled evidence."""
    total = evidence.select("question_id", "paper_id", "page", "text").distinct().groupBy(
        "question_id").agg(F.count("*").alias("evidence_items"))
    found = found_evidence(hits, evidence).groupBy("question_id").agg(
        F.count("*").alias("found_items"), F.min("rank").alias("first_rank"))
    joined = questions.select("question_id").join(total, "question_id", "left").join(
        found, "question_id", "left")
    items = F.coalesce("evidence_items", F.lit(0)).cast("long")
    got = F.coalesce("found_items", F.lit(0)).cast("long")
    labelled = items > 0
    return joined.select(
        "question_id", items.alias("evidence_items"), got.alias("found_items"),
        F.when(labelled, got / items).alias("recall"),
        F.when(labelled, F.coalesce(1.0 / F.col("first_rank"), F.lit(0.0)))
        .alias("reciprocal_rank"))


def summary(scores: DataFrame) -> DataFrame:
    """Means over labelled questions; questions without evidence are counted apart."""
    return scores.agg(
        F.count("recall").alias("labelled_questions"),
        F.count_if(F.col("recall").isNull()).alias("unlabelled_questions"),
        F.avg("recall").alias("mean_recall"),
        F.avg("reciprocal_rank").alias("mean_reciprocal_rank"))


def latency(timings: DataFrame, shares: tuple[float, ...] = (0.5, 0.95)) -> DataFrame:
    """Exact interpolated percentiles of ``(state, seconds)`` per caching state.

    The aggregate counts equal values on the map side. A null state is a state of its own;
    null and non-finite timings are not trials.
    """
    seconds = F.col("seconds").cast("double")
    known = timings.select("state", seconds.alias("seconds")).where(
        F.abs("seconds") < float("inf"))
    found = known.groupBy("state").agg(
        F.count("*").alias("trials"), F.percentile("seconds", list(shares)).alias("found"))
    return found.select("state", "trials", *[
        F.col("found")[i].alias(f"p{round(share * 100)}") for i, share in enumerate(shares)])
