"""Corpus facts and reports: every figure is derived from records.

Sides are tagged and unioned so that one partially-aggregated shuffle serves what would
otherwise be several joins. Lists of identifiers stay tables (``paper_coverage``,
``blank_pages``); the one-row report holds counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from folioweave import fixed_values as V
from folioweave.functions.text import is_blank


def _zero(name: str) -> Column:
    return F.lit(0).cast("long").alias(name)


def _tagged(rows: DataFrame, **flags: Column) -> DataFrame:
    names = ("requested", "page_count", "usable_pages", "empty_pages", "characters",
             "chunk_count")
    reason = F.col("status") if "reason" in flags else F.lit(None).cast("string")
    return rows.select("paper_id", *[
        flags[n].cast("long").alias(n) if n in flags else _zero(n) for n in names],
        reason.alias("reason"))


def paper_coverage(papers: DataFrame, pages: DataFrame, chunks: DataFrame | None = None,
                   failures: DataFrame | None = None) -> DataFrame:
    """One row per requested paper: zero-filled counts and why a paper is left out.

    ``failures`` (``paper_id, status``) says why a paper without usable pages has none, as
    its reader found; without an entry the pages alone decide.
    """
    one = F.lit(1)
    parts = [_tagged(papers, requested=one),
             _tagged(pages, page_count=one, usable_pages=~is_blank(F.col("text")),
                     empty_pages=F.length("text") == 0, characters=F.length("text"))]
    if chunks is not None:
        parts.append(_tagged(chunks, chunk_count=one))
    if failures is not None:
        parts.append(_tagged(failures, reason=one))
    totals = reduce(DataFrame.unionByName, parts).groupBy("paper_id").agg(
        F.max("requested").alias("requested"), F.max("reason").alias("reason"),
        *[F.sum(n).alias(n) for n in ("page_count", "usable_pages", "empty_pages",
                                      "characters", "chunk_count")])
    status = (F.when(F.col("usable_pages") > 0, "included")
              .when(F.col("reason").isNotNull(), F.col("reason"))
              .when(F.col("page_count") == 0, "missing_page_papers")
              .otherwise("papers_without_usable_text"))
    return totals.where("requested = 1").withColumn("status", status).drop("requested", "reason")


def blank_pages(pages: DataFrame) -> DataFrame:
    return pages.where(is_blank(F.col("text"))).select("paper_id", "page_number")


def outcome(included: Column, requested: Column, produced: Column) -> Column:
    """``failure`` without output, ``success`` at full coverage, else partial."""
    return (F.when(produced == 0, V.FAILURE).when(included == requested, V.SUCCESS)
            .otherwise(V.PARTIAL_FAILURE))


def exit_code(name: Column) -> Column:
    """Documented exit code of an outcome; an unknown outcome is an error."""
    code = F.raise_error(F.concat(F.lit("unknown outcome: "), name)).cast("int")
    for known, value in V.EXIT_CODES.items():
        code = F.when(name == known, F.lit(value)).otherwise(code)
    return code


def _one_row(*parts: DataFrame) -> DataFrame:
    """Fold several one-row aggregates into one row without joining them."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(n).alias(n) for n in stacked.columns])


def quality_facts(papers: DataFrame, pages: DataFrame, chunks: DataFrame,
                  profile: str = V.DEFAULT_CHUNK_SETTINGS["profile"]) -> DataFrame:
    coverage = paper_coverage(papers, pages)
    by_paper = coverage.agg(
        F.count("*").alias("requested_papers"),
        F.count_if(F.col("status") == "included").alias("included_papers"),
        F.count_if(F.col("status") != "included").alias("excluded_papers"))
    by_page = pages.agg(F.count("*").alias("pages_loaded"),
                        F.count_if(is_blank(F.col("text"))).alias("blank_pages"))
    by_chunk = chunks.agg(
        F.count("*").alias("chunks_written"),
        F.count_distinct("chunk_id").alias("unique_chunk_ids"),
        F.count_if(is_blank(F.col("text"))).alias("whitespace_chunk_count"),
        F.coalesce(F.max(F.length("text")), F.lit(0)).cast("long")
        .alias("maximum_chunk_characters"))
    facts = _one_row(by_paper, by_page, by_chunk)
    return facts.select(
        outcome(F.col("included_papers"), F.col("requested_papers"),
                F.col("chunks_written")).alias("outcome"), "*",
        F.when(F.col("chunks_written") > 0, F.lit(True)).alias("storage_round_trip_valid"),
        F.lit(V.TOKENIZER_VALIDATION[profile == "tokenizer"]).alias("tokenizer_validation"))


def extraction_report(papers: DataFrame, pages: DataFrame,
                      failures: DataFrame | None = None) -> DataFrame:
    """One row of extraction counters; ``failures`` as in ``paper_coverage``."""
    coverage = paper_coverage(papers, pages, None, failures)
    status, none = F.col("status"), F.col("page_count") == 0
    # "Usable" here means any non-empty cleaned page, as the extraction counters define it.
    has_text = F.col("characters") > 0
    failed = none & (status == "parsing_failures")
    absent = none & status.isin("missing_pdfs", "missing_page_papers")
    counted = coverage.agg(
        F.count("*").alias("papers_attempted"), F.count_if(has_text).alias("papers_succeeded"),
        F.coalesce(F.sum("page_count"), F.lit(0)).alias("pages_extracted"),
        F.coalesce(F.sum("empty_pages"), F.lit(0)).alias("empty_page_count"),
        F.count_if(absent).alias("missing_pdfs"), F.count_if(failed).alias("parsing_failures"),
        F.count_if(~has_text & ~failed & ~absent).alias("papers_without_usable_text"),
        F.coalesce(F.sum("characters"), F.lit(0)).alias("extracted_characters"))
    complete = F.col("papers_succeeded") == F.col("papers_attempted")
    result = (F.when(F.col("extracted_characters") == 0, V.FAILURE)
              .when(complete & (F.col("parsing_failures") == 0), V.SUCCESS)
              .otherwise(V.PARTIAL_FAILURE))
    return counted.select(result.alias("outcome"), "*", (
        F.col("pages_extracted") - F.col("empty_page_count")).alias("usable_page_count"))


def source_availability(papers: DataFrame, listing: DataFrame) -> DataFrame:
    """Is each paper's file present and non-empty? ``listing`` has ``path, length``."""
    present = listing.where("length > 0").select(F.col("path").alias("source_path"),
                                                 F.lit(True).alias("available"))
    return papers.join(present, "source_path", "left").select(
        "paper_id", "source_path", F.coalesce("available", F.lit(False)).alias("available"))


def catalog_report(papers: DataFrame, listing: DataFrame) -> DataFrame:
    found = source_availability(papers, listing).agg(
        F.count("*").alias("manifest_papers"), F.count_if("available").alias("available_pdfs"),
        F.count_if(~F.col("available")).alias("missing_pdfs"))
    return found.select(outcome(F.col("available_pdfs"), F.col("manifest_papers"),
                                F.col("available_pdfs")).alias("outcome"), "*")


def breaks_token_budget(token_budget: int, ceiling: int) -> Column:
    content, complete = F.col("content_token_count"), F.col("input_token_count")
    return (content.isNull() | complete.isNull() | (content > token_budget)
            | (complete > ceiling))


def token_budget_breaches(chunks: DataFrame, token_budget: int, ceiling: int) -> DataFrame:
    """Chunks whose stored counts are absent or above the declared budgets."""
    return chunks.where(breaks_token_budget(token_budget, ceiling))
