"""Idempotent incremental chunking of arriving page files.

The batch library's "add only what is not known yet" as a file stream: every micro-batch
keeps pages whose key is new, cuts them, and appends. Re-delivered files add nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from folioweave import schemas
from folioweave.operators import sets
from folioweave.operators.chunking import ChunkSettings, chunk_pages
from folioweave.sources.files import Files


BUCKETS = 64


def _bucket() -> Column:
    return F.pmod(F.xxhash64("paper_id"), F.lit(BUCKETS)).cast("int").alias("bucket")


def _page() -> Column:
    return F.struct("paper_id", F.col("page_number").cast("long").alias("page_number"))


def page_stream(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema(schemas.PAGES).json(folder)


def chunk_stream(spark: SparkSession, folder: str, target: str, checkpoint: str,
                 settings: ChunkSettings | None = None, tokenizer=None):
    """Append passages of new pages to the table at ``target``; returns the query.

    Passages go to one directory per batch. A batch that is retried after a lost executor
    or a restart overwrites its own directory, so each page is stored exactly once.
    """
    settings = settings or ChunkSettings()
    files = Files(spark)

    def add(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        pages = batch.dropDuplicates(["paper_id", "page_number"])
        # Earlier batches only: a retried batch must not see its own first attempt. Batch and
        # bucket are partition columns, so only files of the papers' buckets are read. A page
        # that comes again is left out whole, whatever its new text.
        if files.exists(target):
            buckets = [r["bucket"] for r in pages.select(_bucket()).distinct().collect()]
            known = session.read.parquet(target).where(
                (F.col("batch") < number) & F.col("bucket").isin(*buckets))
            pages = sets.unseen(pages.withColumn("key", _page()), known.select(
                _page().alias("key")).distinct(), "key").drop("key")
        chunks = chunk_pages(pages, settings, tokenizer).withColumn("bucket", _bucket())
        chunks.write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/batch={number}")

    return (page_stream(spark, folder).writeStream.foreachBatch(add)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
