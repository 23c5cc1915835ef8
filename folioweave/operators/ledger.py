"""The source ledger: from which file, by which reader, every paper's pages came.

One entry for each requested paper. In ``pdf_pipeline`` mode an entry holds the hash of the paper's
file and the reader that opened it; a missing file has neither. In ``existing_pages`` mode
pages come from one table, so entries name no file hash and no reader.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from folioweave import schemas
from folioweave.functions import identity
from folioweave.functions.text import is_blank

READ, MISSING = "read", "missing_pdfs"
CLASSES = {"pdf_pipeline": (READ, MISSING, "parsing_failures", "papers_without_usable_text"),
           "existing_pages": (READ, "missing_page_papers")}


def of_pages(papers: DataFrame, pages: DataFrame) -> DataFrame:
    """The ledger of pages that were there before."""
    none = F.lit(None).cast("string")
    read = pages.select("paper_id").distinct().withColumn("found", F.lit(True))
    status = F.when(F.col("found"), READ).otherwise("missing_page_papers")
    return papers.select("paper_id", "source_path").join(read, "paper_id", "left").select(
        "paper_id", "source_path", none.alias("sha256"), none.alias("reader"), none.alias("reader_version"),
        status.alias("status")).select(*schemas.SOURCES.names)


def _side(rows: DataFrame, **own: Column) -> DataFrame:
    """The rows with the columns of all sides; what a side lacks is null."""
    kinds = {"papers": "long", "entries": "long", "pages": "long", "wanted": "string",
             **{n: "string" for n in schemas.SOURCES.names[1:]}}
    return rows.select("paper_id", *[
        own.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in kinds.items()])


def violations(papers: DataFrame, pages: DataFrame, ledger: DataFrame, mode: str) -> DataFrame:
    """``rule, key, detail`` of every entry that contradicts papers, pages or its input mode.

    All three tables meet in one grouping by paper; pages are counted before the shuffle. Of
    entries that repeat a paper, the least of each field is judged, beside the repetition itself.
    """
    one = F.lit(1)
    sides = [_side(papers, papers=one, wanted=F.col("source_path")),
             _side(pages, pages=one),
             _side(ledger, entries=one, **{n: F.col(n) for n in schemas.SOURCES.names[1:]})]
    met = reduce(DataFrame.unionByName, sides).groupBy("paper_id").agg(
        *[F.sum(n).alias(n) for n in ("papers", "entries", "pages")],
        *[F.min(n).alias(n) for n in ("wanted", *schemas.SOURCES.names[1:])])
    from_files = mode == "pdf_pipeline"
    opened = F.col("status") != MISSING if from_files else F.lit(False)
    known, requested = F.col("entries").isNotNull(), F.col("papers").isNotNull()
    named = ~is_blank(F.col("reader")) & ~is_blank(F.col("reader_version"))
    absent = F.col("reader").isNull() & F.col("reader_version").isNull()
    rules = {
        "entry_missing": ~requested | known, "entry_unknown": ~known | requested,
        "entry_repeated": ~known | (F.col("entries") == 1),
        "source_path": ~known | ~requested | F.col("source_path").eqNullSafe(F.col("wanted")),
        "class_of_mode": ~known | F.col("status").isin(*CLASSES[mode]),
        "file_hash": ~known | F.when(opened, identity.is_hash(F.col("sha256"))).otherwise(F.col("sha256").isNull()),
        "reader": ~known | F.when(opened, named).otherwise(absent),
        "pages": ~known | ~requested | ((F.col("status") == READ) == F.col("pages").isNotNull())}
    broken = F.array_compact(F.array(*[
        F.when(~F.coalesce(holds, F.lit(False)), F.lit(rule)) for rule, holds in rules.items()]))
    return met.select(F.explode_outer(broken).alias("rule"), F.col("paper_id").alias("key"),
                      F.col("status").alias("detail")).where("rule IS NOT NULL")


def files_digest(ledger: DataFrame) -> str:
    """One digest of all files' paths and hashes, free of order."""
    return identity.table_digest(ledger.where("sha256 IS NOT NULL").select("source_path", "sha256")).head()["sha256"]
