"""Per-paper corpus statistics, themes and keywords."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from folioweave import fixed_values as V
from folioweave.functions import text as X
from folioweave.functions.keywords import top_keywords


def summarize(papers: DataFrame) -> DataFrame:
    """One summary row per paper; narrow, no shuffle.

    Input columns: ``file_name, metadata_title, author, pages, text``.
    """
    described = papers.withColumns({
        "title": X.clean_title(F.col("metadata_title"), F.col("file_name")),
        "abstract": X.extract_abstract(F.col("text"))})
    words = top_keywords(F.concat_ws(" ", "title", "abstract"))
    return described.select(
        "file_name", "title", F.coalesce(F.nullif(F.col("author"), F.lit("")),
                                         F.lit("Unknown")).alias("authors"),
        "pages", X.word_count(F.col("text")).alias("word_count"),
        F.substring("abstract", 1, V.ABSTRACT_PREVIEW).alias("abstract_preview"),
        F.array_join(words, ", ").alias("top_keywords"),
        X.theme(F.col("title"), F.col("abstract")).alias("theme"),
        (~X.is_blank(F.col("text"))).alias("text_extracted"))


def longest_first(summary: DataFrame) -> DataFrame:
    return summary.orderBy(F.desc("word_count"), F.asc("file_name"))


def theme_distribution(summary: DataFrame) -> DataFrame:
    return (summary.groupBy("theme").agg(F.count("*").alias("papers"))
            .orderBy(F.desc("papers"), F.asc("theme")))


def averages(summary: DataFrame) -> DataFrame:
    return summary.agg(F.count("*").alias("papers"), F.avg("pages").alias("mean_pages"),
                       F.avg("word_count").alias("mean_words"),
                       F.count_if(~F.col("text_extracted")).alias("without_text"))


def chart_rows(summary: DataFrame) -> DataFrame:
    """Input of the word-count chart: shortened labels beside counts, longest first."""
    return longest_first(summary).select(X.shorten(F.col("title")).alias("label"), "word_count")


def write_summary(summary: DataFrame, path: str) -> None:
    """CSV report, longest paper first; part files keep the order and carry headers."""
    longest_first(summary).write.mode("overwrite").option("header", True).csv(path)
