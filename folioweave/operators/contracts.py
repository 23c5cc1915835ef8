"""Contracts as violation queries: a dataset is valid when the result is empty."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql import types as T

from folioweave import fixed_values as V
from folioweave.functions import identity
from folioweave.functions.text import is_blank, strip

PAGE_KEY = ("paper_id", "page_number")


def _broken(rules: dict[str, Column]) -> Column:
    """Names of the rules that fail on a row; a rule that yields null has failed."""
    return F.array_compact(F.array(*[
        F.when(~F.coalesce(holds, F.lit(False)), F.lit(name)) for name, holds in rules.items()]))


def _exploded(rows: DataFrame, key: Column, broken: Column) -> DataFrame:
    """One row per broken rule.

    The outer form keeps Catalyst from inferring a filter on the array, which would
    evaluate every rule twice.
    """
    listed = rows.select(F.explode_outer(broken).alias("rule"), key.alias("key"),
                         F.lit(None).cast("string").alias("detail"))
    return listed.where(F.col("rule").isNotNull())


def _listed(rows: DataFrame, key: Column, rules: dict[str, Column]) -> DataFrame:
    return _exploded(rows, key, _broken(rules))


def _page_key() -> Column:
    return F.concat_ws("#", F.col("paper_id"), F.col("page_number").cast("string"))


def normalize_papers(papers: DataFrame) -> DataFrame:
    """Strip the text fields the contract strips before it checks them."""
    plain = [n for n in V.PAPER_FIELDS if n != "authors" and n in papers.columns]
    cleaned = {name: strip(F.col(name)) for name in plain}
    if "authors" in papers.columns:
        cleaned["authors"] = F.transform("authors", lambda a: strip(a))
    return papers.withColumns(cleaned)


def missing_fields(columns: tuple[str, ...] = V.PAPER_FIELDS) -> Column:
    """Sorted names of absent required fields."""
    return F.array_sort(F.array_compact(F.array(*[
        F.when(F.col(name).isNull(), F.lit(name)) for name in columns])))


def citation_rules() -> dict[str, Column]:
    """Row rules on a citation; columns are expected stripped."""
    pid = F.col("paper_id")
    return {
        "paper_id": identity.is_paper_id(pid),
        "paper_version": identity.is_version_of(F.col("paper_version"), pid),
        "title": F.length(F.col("title")) > 0,
        "authors": (F.size("authors") > 0) & F.forall(
            "authors", lambda a: F.coalesce(F.length(a) > 0, F.lit(False))),
        "published": identity.is_calendar_date(F.col("published")),
        "pdf_url": identity.is_pdf_url(F.col("pdf_url"), pid),
    }


def paper_rules() -> dict[str, Column]:
    return {**citation_rules(),
            "source_path": (F.length("source_path") > 0)
            & identity.is_relative_path(F.col("source_path"))}


def page_rules() -> dict[str, Column]:
    return {**citation_rules(), "page_number": F.col("page_number") >= 1,
            "text": F.col("text").isNotNull()}


def chunk_rules() -> dict[str, Column]:
    content, complete = F.col("content_token_count"), F.col("input_token_count")
    span = F.col("end_character") - F.col("start_character")
    both_or_neither = content.isNull() == complete.isNull()
    ordered = content.isNull() | ((content >= 0) & (content <= complete))
    return {
        **page_rules(),
        "schema_version": F.col("schema_version") == V.SCHEMA_VERSION,
        "text_empty": F.length("text") > 0,
        "offsets": (F.col("start_character") >= 0) & (span >= 1),
        "offset_length": span == F.length("text"),
        "page_text_sha256": identity.is_hash(F.col("page_text_sha256")),
        "chunking_profile_sha256": identity.is_hash(F.col("chunking_profile_sha256")),
        "token_counts": both_or_neither & F.coalesce(ordered, F.lit(False)),
        "chunk_id": F.col("chunk_id") == identity.chunk_id(),
    }


def duplicates(rows: DataFrame, keys: list[str], rule: str) -> DataFrame:
    """Keys held by more than one row; counts combine before the shuffle."""
    grouped = rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    return grouped.select(F.lit(rule).alias("rule"),
                          F.concat_ws("#", *[F.col(k).cast("string") for k in keys]).alias("key"),
                          F.col("n").cast("string").alias("detail"))


def paper_violations(papers: DataFrame) -> DataFrame:
    """Row rules, duplicate identities and shared source files of a manifest."""
    papers = normalize_papers(papers)
    lexical = papers.withColumn("source_file", lexical_path(F.col("source_path")))
    shared = (lexical.groupBy("source_file")
              .agg(F.count("*").alias("n"), F.min("paper_id").alias("first")).where("n > 1")
              .select(F.lit("source_path_shared").alias("rule"), F.col("source_file").alias("key"),
                      F.col("first").alias("detail")))
    return (_listed(papers, F.col("paper_id"), paper_rules())
            .unionByName(duplicates(papers, ["paper_id"], "paper_id_duplicate"))
            .unionByName(shared))


def lexical_path(path: Column) -> Column:
    """Path without empty and ``.`` parts, so different spellings compare equal."""
    parts = F.filter(F.split(path, "/"), lambda p: (p != "") & (p != "."))
    return F.array_join(parts, "/")


def citation_hash() -> Column:
    return identity.sha256(F.to_json(F.struct(*[F.col(n) for n in V.CITATION_FIELDS]),
                                     {"ignoreNullFields": "false"}))


def page_facts(pages: DataFrame) -> DataFrame:
    """Per-paper page facts in one aggregation.

    Rows collapse map-side to one per (paper, page) and then one per paper, so a paper
    with very many pages costs one small partial row per task.
    """
    return (pages.withColumn("citation", citation_hash()).groupBy("paper_id").agg(
        F.count("*").alias("page_rows"),
        F.count_distinct("page_number").alias("distinct_pages"),
        F.min("page_number").alias("first_page"), F.max("page_number").alias("last_page"),
        F.min("citation").alias("citation_low"), F.max("citation").alias("citation_high")))


def contiguity(pages: DataFrame) -> DataFrame:
    """Do a paper's page numbers run 1..n without gap or repeat?"""
    facts = page_facts(pages)
    whole = ((F.col("first_page") == 1) & (F.col("last_page") == F.col("page_rows"))
             & (F.col("distinct_pages") == F.col("page_rows")))
    return facts.withColumn("contiguous", whole)


def page_violations(pages: DataFrame, papers: DataFrame) -> DataFrame:
    """Row rules, repeated pages, page gaps and citations that differ from the manifest.

    The manifest join sees one row per paper on both sides, never one per page.
    """
    manifest = normalize_papers(papers).select("paper_id", citation_hash().alias("manifest"))
    per_paper = contiguity(pages).join(manifest, "paper_id", "left")
    same = ((F.col("citation_low") == F.col("manifest"))
            & (F.col("citation_high") == F.col("manifest")))
    return (_listed(pages, _page_key(), page_rules())
            .unionByName(_listed(per_paper, F.col("paper_id"), {
                "page_citation": same,
                "page_duplicate": F.col("page_rows") == F.col("distinct_pages"),
                "page_sequence": F.col("contiguous")})))


def coverage_sweep(chunks: DataFrame, pages: DataFrame) -> DataFrame:
    """Chunks and pages side by side with the running state of each page's coverage.

    One shuffle on (paper, page) serves the join and the windows. Of a page only its length,
    hash and blankness travel, so a page of many chunks costs each of them a few bytes.
    """
    text = F.col("text")
    source = pages.select(*PAGE_KEY, F.length(text).alias("page_length"), is_blank(text).alias("page_blank"),
                          identity.sha256(text).alias("page_sha256"),
                          citation_hash().alias("page_citation"))
    own = chunks.withColumn("chunk_citation", citation_hash())
    joined = own.join(source, list(PAGE_KEY), "full_outer")
    order = W.partitionBy(*PAGE_KEY).orderBy("start_character", "end_character", "chunk_id")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*PAGE_KEY)
    return joined.withColumns({
        "reached_before": F.coalesce(F.max("end_character").over(before), F.lit(0)),
        "previous_start": F.coalesce(F.lag("start_character").over(order), F.lit(-1)),
        "reached": F.max("end_character").over(whole),
        "previous_id": F.lag("chunk_id").over(order),
        "position": F.row_number().over(order)})


def _cut_correctly(text: pd.Series, spans: pd.Series) -> pd.Series:
    """For each page, which of its spans hold exactly the characters they name."""
    def checked(page, own):
        return [page is not None and 0 <= s["start"] <= s["end"] <= len(page)
                and page[s["start"]:s["end"]] == s["text"] for s in own]

    return pd.Series([checked(p, s) for p, s in zip(text, spans)])


_cut_correctly.__annotations__ = {"text": pd.Series, "spans": pd.Series, "return": pd.Series}


def checked_slices(chunks: DataFrame, pages: DataFrame) -> DataFrame:
    """``chunk_id, right``: does a chunk's page hold its text at its place?

    A page meets its spans once, as one array, so its text is read once however many chunks
    it has. A null span or text is wrong; chunks of unknown pages are not listed.
    """
    span = F.struct("chunk_id", F.coalesce("start_character", F.lit(-1)).alias("start"),
                    F.coalesce("end_character", F.lit(-1)).alias("end"), "text")
    spans = chunks.groupBy(*PAGE_KEY).agg(F.collect_list(span).alias("spans"))
    check = F.pandas_udf(_cut_correctly, T.ArrayType(T.BooleanType()))
    met = pages.select(*PAGE_KEY, "text").join(spans, list(PAGE_KEY))
    both = F.arrays_zip(F.col("spans.chunk_id").alias("chunk_id"), F.col("right").alias("right"))
    return met.withColumn("right", check("text", "spans")).select(F.inline(both))


def chunk_violations(chunks: DataFrame, pages: DataFrame) -> DataFrame:
    """Row rules, linkage, exact slices, hashes, unique identifiers and full coverage.

    All but the slices are judged in the one pass of ``coverage_sweep``. Identifiers are
    derived from content, so two rows can share a valid one only on the same span of the
    same page, where they are neighbours; anything else breaks the ``chunk_id`` row rule. Row
    rules are judged before the sweep's shuffle, which then carries no passage's text.
    """
    is_chunk, usable = F.col("chunk_id").isNotNull(), ~F.col("page_blank")
    swept = coverage_sweep(chunks.withColumn("row_rules", F.when(is_chunk, _broken(chunk_rules()))), pages)
    start = F.col("start_character")
    linked = {
        "citation": F.col("chunk_citation") == F.col("page_citation"),
        "page_hash": F.col("page_text_sha256") == F.col("page_sha256"),
        "gap": start <= F.col("reached_before"),
        "repeated_span": start > F.col("previous_start"),
        "chunk_id_duplicate": ~F.col("chunk_id").eqNullSafe(F.col("previous_id"))}
    none = F.array().cast("array<string>")
    broken = F.concat(
        F.when(is_chunk, F.col("row_rules")).otherwise(none),
        F.when(is_chunk, _broken({"source_page": usable})).otherwise(none),
        F.when(is_chunk & F.col("page_length").isNotNull(), _broken(linked)).otherwise(none),
        F.when(usable & (F.col("position") == 1),
               _broken({"page_end": F.col("reached") == F.col("page_length")})).otherwise(none))
    key = F.coalesce(F.col("chunk_id"), _page_key())
    wrong = checked_slices(chunks.where("chunk_id IS NOT NULL"), pages).where("NOT right").select(
        F.lit("slice").alias("rule"), F.col("chunk_id").alias("key"),
        F.lit(None).cast("string").alias("detail"))
    return _exploded(swept, key, broken).unionByName(wrong)


def require_empty(violations: DataFrame, what: str) -> None:
    """Fail closed: raise with a few examples when any violation exists."""
    found = violations.limit(5).collect()
    if found:
        shown = "; ".join(f"{row['rule']}: {row['key']}" for row in found)
        raise ValueError(f"{what} violates its contract ({shown})")
