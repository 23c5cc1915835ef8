"""Exact cosine search.

Vectors are scored in Arrow batches with NumPy. Every task keeps only its own best ``k`` per
question, so no pair of question and vector is ever emitted.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql import types as T

from folioweave import fixed_values as V

# Sizes of the blocks that meet in one task.
QUESTIONS_PER_BLOCK, VECTORS_PER_BLOCK = 1024, 65536
SIMILARITY_DIGITS = 12
# Result rows small enough to be sent to every task.
BROADCAST_ROWS = 200_000


def check_bound(name: str, value: int) -> int:
    low, high = V.BOUNDS[name]
    if type(value) is not int or value < low or (high is not None and value > high):
        raise ValueError(f"{name} must be an integer between {low} and {high}")
    return value


def check_count(name: str, value: int) -> int:
    """Library calls take any positive count; only routes have upper bounds."""
    if type(value) is not int or value < 1:
        raise ValueError(f"{name} must be a positive integer")
    return value


def cosine(left: Column, right: Column) -> Column:
    """Cosine of two vector columns in double precision; null for a zero vector."""
    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
                           F.lit(0.0), lambda total, x: total + x)

    return F.try_divide(dot(left, right), F.sqrt(dot(left, left)) * F.sqrt(dot(right, right)))


def rounded_vector(vector: Column, digits: int = 5) -> Column:
    return F.transform(vector, lambda x: F.round(x.cast("double"), digits))


def _near(scores: np.ndarray, k: int, least: float) -> np.ndarray:
    """Positions that can still be among the best ``k``, ties at the cut included."""
    if len(scores) > k:
        least = max(least, np.partition(scores, len(scores) - k)[len(scores) - k])
    return np.flatnonzero(scores >= least)


def _best(pieces, unit: np.ndarray, lengths: np.ndarray, k: int) -> list[list[tuple]]:
    """For each question, the ordered best ``(-similarity, id)`` over pieces of the vectors."""
    wide = unit.shape[1]
    held: list[list[tuple]] = [[] for _ in lengths]
    for ids, column in pieces:
        size = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)
        present = size == size  # a null vector has no length
        if (size[present] != wide).any():
            raise ValueError("stored and question vectors differ in dimension")
        if not present.all():
            ids = ids.filter(pa.array(present))
        matrix = column.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(-1, wide)
        norms = np.linalg.norm(matrix, axis=1)
        usable = np.flatnonzero(norms > 0)
        if not len(usable):
            continue
        # Rounding keeps the order of summation from deciding between equal vectors.
        table = np.round((matrix[usable] @ unit.T) / norms[usable, None], SIMILARITY_DIGITS)
        for q, best in enumerate(held):
            if lengths[q] == 0:
                continue
            scores = table[:, q]
            near = _near(scores, k, -best[-1][0] if len(best) == k else -np.inf)
            if len(near):
                # Only the few rows that can still win turn into Python values.
                found = ids.take(pa.array(usable[near])).to_pylist()
                held[q] = sorted([*best, *zip((-scores[near]).tolist(), found)])[:k]
    return held


def _unit(questions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.linalg.norm(questions, axis=1)
    return np.divide(questions, lengths[:, None], out=np.zeros_like(questions),
                     where=lengths[:, None] > 0), lengths


def _listed(best, names, name_type: pa.DataType, id_type: pa.DataType, id_column: str) -> pa.Table:
    rows = [(name, found, -score) for name, hits in zip(names, best) for score, found in hits]
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.table([pa.array(columns[0], name_type), pa.array(columns[1], id_type),
                     pa.array(columns[2], pa.float64())],
                    names=["question_id", id_column, "similarity"])


def _arrow_key(kind: T.DataType) -> pa.DataType:
    if not isinstance(kind, (T.StringType, T.LongType)):
        raise ValueError("identifiers must be strings or longs")
    return pa.string() if isinstance(kind, T.StringType) else pa.int64()


def _result(vectors: DataFrame, id_column: str, name_type: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("question_id", name_type), vectors.schema[id_column],
                         T.StructField("similarity", T.DoubleType())])


def nearest(vectors: DataFrame, question: list[float], k: int, id_column: str = "id",
            vector_column: str = "embedding") -> DataFrame:
    """The ``k`` nearest rows to one question vector: ``(id, similarity)``, best first."""
    unit, lengths = _unit(np.array([question], dtype="float64"))
    id_type = _arrow_key(vectors.schema[id_column].dataType)

    def score(batches):
        best = _best(((batch.column(0), batch.column(1)) for batch in batches), unit, lengths, k)
        yield from _listed(best, [0], pa.int64(), id_type, id_column).to_batches()

    scored = vectors.select(id_column, vector_column).mapInArrow(
        score, _result(vectors, id_column, T.LongType()))
    return (scored.select(id_column, "similarity")
            .orderBy(F.desc("similarity"), F.asc(id_column)).limit(k))


def ranked(hits: DataFrame, id_column: str = "id") -> DataFrame:
    """Rank 1..k of one question's hits (a handful of rows)."""
    return hits.withColumn("rank", F.row_number().over(
        W.orderBy(F.desc("similarity"), F.asc(id_column))).cast("long"))


def nearest_each(vectors: DataFrame, questions: DataFrame, k: int, id_column: str = "id",
                 vector_column: str = "embedding", question_column: str = "question_id",
                 question_vector: str = "embedding") -> DataFrame:
    """The ``k`` nearest rows for every question, with ranks.

    Questions stay a table. Both sides are cut into blocks by hashes of their ids; a task
    scores one block of questions against one block of vectors and keeps ``k`` a question,
    and a grouped top-k, which combines before its shuffle, merges the blocks.
    """
    asked = questions.count()
    if not asked:
        raise ValueError("there are no questions to search for")
    name_type, id_type = (_arrow_key(rows.schema[name].dataType) for rows, name in (
        (questions, question_column), (vectors, id_column)))
    v_parts = max(1, math.ceil(vectors.count() / VECTORS_PER_BLOCK))
    q_parts = math.ceil(asked / QUESTIONS_PER_BLOCK)

    def dealt(rows, key, vector, own, parts, other, other_parts):
        return rows.select(key, vector, F.pmod(F.xxhash64(key), F.lit(parts)).cast("int").alias(own)).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(other_parts - 1))))

    left = dealt(vectors, id_column, vector_column, "v_part", v_parts, "q_part", q_parts)
    right = dealt(questions, question_column, question_vector, "q_part", q_parts, "v_part", v_parts)

    def score(stored: pa.Table, block: pa.Table) -> pa.Table:
        names, best = block[question_column].to_pylist(), []
        if stored.num_rows and names:
            unit, lengths = _unit(np.array(block[question_vector].to_pylist(), dtype="float64"))
            pieces = ((b.column(id_column), b.column(vector_column)) for b in stored.to_batches(8192))
            best = _best(pieces, unit, lengths, k)
        return _listed(best, names, name_type, id_type, id_column)

    found = left.groupBy("v_part", "q_part").cogroup(right.groupBy("v_part", "q_part")).applyInArrow(
        score, _result(vectors, id_column, questions.schema[question_column].dataType))
    order = W.partitionBy("question_id").orderBy(F.desc("similarity"), F.asc(id_column))
    return found.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= k)


def with_payload(hits: DataFrame, table: DataFrame, id_column: str, most_rows: int) -> DataFrame:
    """Attach stored columns to hits. ``most_rows`` is the proven bound on the hits."""
    small = F.broadcast(hits) if most_rows <= BROADCAST_ROWS else hits
    return table.join(small, id_column)


def two_stage(paper_vectors: DataFrame, chunk_vectors: DataFrame, question: list[float],
              n_papers: int, k: int, paper_id: str = "paper_id", chunk_id: str = "id",
              vector_column: str = "embedding") -> DataFrame:
    """Best papers first, then the best passages inside them; one lazy plan.

    Stage one yields at most ``n_papers`` rows, which is checked before they are sent to
    every task; passages of other papers never reach the scorer.
    """
    check_count("n", n_papers)
    check_count("k", k)
    papers = nearest(paper_vectors, question, n_papers, paper_id, vector_column).select(paper_id)
    few = F.broadcast(papers) if n_papers <= BROADCAST_ROWS else papers
    inside = chunk_vectors.join(few, paper_id, "left_semi")
    return nearest(inside, question, k, chunk_id, vector_column)
