"""Listings, lookups and display projections of the stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from folioweave.functions.text import squeeze
from folioweave.operators.vector_search import check_bound, rounded_vector


def newest_first(rows: DataFrame, by: str, key: str, limit: int = 50,
                 offset: int = 0) -> DataFrame:
    """One page of a newest-first listing; ties run by identifier, descending."""
    check_bound("limit", limit)
    check_bound("offset", offset)
    return rows.orderBy(F.desc(by), F.desc(key)).offset(offset).limit(limit)


def most_recent(rows: DataFrame, by: str, key: str, n: int) -> DataFrame:
    check_bound("n", n)
    return rows.orderBy(F.desc(by), F.desc(key)).limit(n)


def lookup(rows: DataFrame, key: str, value) -> DataFrame:
    """Point lookup; an empty result means not found. The filter reaches the scan."""
    return rows.where(F.col(key) == F.lit(value))


def abstract_of(document: Column, title: Column) -> Column:
    """The stored document without its leading ``"<title>. "``."""
    lead = F.concat(title, F.lit(". "))
    return F.when(F.startswith(document, lead),
                  F.substring(document, F.length(lead) + 1, F.length(document))
                  ).otherwise(document)


def document_text(title: Column, abstract: Column) -> Column:
    return F.concat(title, F.lit(". "), abstract)


def reading_order(chunk_vectors: DataFrame, paper_id: str) -> DataFrame:
    """All passages of one paper with display vectors, in reading order."""
    own = lookup(chunk_vectors, "paper_id", paper_id)
    return own.select("id", F.col("document").alias("text"), "page_number", "start_character",
                      "end_character", rounded_vector(F.col("embedding")).alias("embedding")
                      ).orderBy("page_number", "start_character")


def citation_block(paper_id: Column, page_number: Column, text: Column) -> Column:
    return F.concat(F.lit("["), paper_id, F.lit(" p."), page_number.cast("string"),
                    F.lit("]\n"), text)


def tool_block(rank: Column, score: Column, title: Column, paper_id: Column,
               page_number: Column, text: Column) -> Column:
    return F.format_string("[%d] similarity %.3f | \"%s\" (arXiv %s), page %d\n%s",
                           rank, score, title, paper_id, page_number, squeeze(text))


def joined_blocks(hits: DataFrame, block: Column, rank: str = "rank") -> DataFrame:
    """Blocks of one search (at most 20 rows by contract) as one prompt text."""
    lines = F.sort_array(F.collect_list(F.struct(F.col(rank).alias("r"), block.alias("b"))))
    return hits.agg(F.array_join(F.transform(lines, lambda x: x["b"]), "\n\n").alias("context"),
                    F.count("*").alias("passages"))
