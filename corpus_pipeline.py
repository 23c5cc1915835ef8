"""A training corpus from raw documents: five stages, each one operator of ``folioweave.llm``.

``STAGES`` lists (name, function). Every function takes (spark, docs, sf_dir) and returns the
documents that stay, with the columns of ``documents``; the last returns their encoding.
Stages take null texts as empty, keep repeated rows unless they are what the stage removes,
and give no rows for no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from folioweave.llm import chosen_path, decontaminate, line_windows, piece_lattice, quality
from folioweave.llm.common import stored, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score, learned from the labels, is 0.5 or more."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality.score_column(model, F.col("text")) >= 0.5)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages seen before; one that loses all its lines goes."""
    deduped = line_windows.dedup_lines(docs)
    return deduped.where("n_removed < n_lines").select(docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id (null last), of every group of near duplicates."""
    return chosen_path.first_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of the best segmentation, the best ones' scores, and the round trip."""
    return piece_lattice.segment(docs)


STAGES = [("quality", keep_good), ("lines", drop_repeated_lines), ("near_duplicates", keep_one_of_each),
          ("benchmark", drop_benchmark), ("pieces", encode)]

# Learned scores, hashing to a target recall and segmentation have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is stored before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
