"""Session settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the operators are planned around. A cluster profile overrides the sizes
# (shuffle partitions, executor memory); none of the operators depends on them for
# correctness.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even where the split costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Deep listing offsets fall back to a range-partitioned sort instead of one big heap.
    "spark.sql.execution.topKSortFallbackThreshold": "100000",
    # Page and passage rows are wide; small Arrow batches keep Python workers flat.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def build_session(master: str | None = None, app: str = "folioweave",
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
