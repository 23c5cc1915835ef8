"""Set comparison of tables: coverage, equality, reconciliation.

Sides are tagged, unioned and grouped by key, which needs one shuffle of small partial
rows where outer joins and two-way EXCEPT would shuffle whole rows twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from folioweave.functions.identity import row_hash


def id_coverage(left: DataFrame, right: DataFrame, key: str,
                names: tuple[str, str, str] = ("shared", "left_only", "right_only")) -> DataFrame:
    """Every identifier with the side(s) it occurs on."""
    def side(rows, number):
        return rows.select(key, F.lit(number == 0).alias("on_left"),
                           F.lit(number == 1).alias("on_right"))

    both = side(left, 0).unionByName(side(right, 1)).groupBy(key).agg(
        F.bool_or("on_left").alias("on_left"), F.bool_or("on_right").alias("on_right"))
    label = (F.when(F.col("on_left") & F.col("on_right"), names[0])
             .when(F.col("on_left"), names[1]).otherwise(names[2]))
    return both.select(key, label.alias("side"))


def unseen(feed: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Feed rows whose identifier is not known yet."""
    return feed.join(known.select(key), key, "left_anti")


def row_differences(left: DataFrame, right: DataFrame,
                    columns: list[str] | None = None) -> DataFrame:
    """Row hashes with unequal multiplicity: empty exactly when the multisets are equal."""
    columns = columns or left.columns
    weighted = left.select(row_hash(columns).alias("row"), F.lit(1).alias("w")).unionByName(
        right.select(row_hash(columns).alias("row"), F.lit(-1).alias("w")))
    return weighted.groupBy("row").agg(F.sum("w").alias("surplus")).where("surplus <> 0")


def reconcile(desired: DataFrame, stored: DataFrame, key: str | list[str],
              columns: list[str] | None = None) -> DataFrame:
    """``(key, action)``: new, changed, unchanged or stale; ``key`` is one column or several.

    Only keys and content hashes are shuffled, never documents or vectors.
    """
    keys = [key] if isinstance(key, str) else list(key)
    columns = columns or [n for n in desired.columns if n not in keys]
    empty = F.lit(None).cast("string")
    sides = desired.select(*keys, row_hash(columns).alias("want"), empty.alias("have")).unionByName(
        stored.select(*keys, empty.alias("want"), row_hash(columns).alias("have")))
    merged = sides.groupBy(*keys).agg(F.max("want").alias("want"), F.max("have").alias("have"))
    action = (F.when(F.col("have").isNull(), "new").when(F.col("want").isNull(), "stale")
              .when(F.col("want") == F.col("have"), "unchanged").otherwise("changed"))
    return merged.select(*keys, action.alias("action"))


def keep_last(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, the latest by ``order``; combines before the shuffle."""
    whole = F.struct(*[F.col(n) for n in rows.columns])
    return rows.groupBy(key).agg(F.max_by(whole, F.col(order)).alias("row")).select("row.*")


def merge_rows(kept: DataFrame, added: DataFrame, key: str) -> DataFrame:
    """Stored rows without the keys that ``added`` replaces, plus ``added``."""
    return kept.join(added.select(key), key, "left_anti").unionByName(added)
