"""PDF files to cleaned pages through an injected reader."""

from __future__ import annotations

from collections.abc import Callable
import hashlib
from importlib import metadata
import io

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from folioweave import fixed_values as V, schemas
from folioweave.functions.text import clean_text
from folioweave.operators import ledger

# path, 1-based page number (null for a file without pages), text, error
PAGE_ROWS = "path string, page_number long, raw_text string, error string, sha256 string"


def pypdf_pages(content: bytes) -> list[str | None]:
    """Page texts by the optional ``pypdf`` library; empty-password files are opened."""
    try:
        from pypdf import PdfReader
    except ImportError as error:
        raise RuntimeError("pypdf is needed to read PDF files") from error
    reader = PdfReader(io.BytesIO(content), strict=False)
    if reader.is_encrypted and not reader.decrypt(""):
        raise ValueError("the file asks for a password")
    return [page.extract_text() for page in reader.pages]


pypdf_pages.library = "pypdf"


def reader_name(reader: Callable) -> str:
    return f"{reader.__module__}.{reader.__qualname__}"


def reader_version(reader: Callable) -> str:
    """The version of a reader: its own, that of its library, or a hash of its compiled code."""
    own = getattr(reader, "version", None)
    if own:
        return str(own)
    try:
        return metadata.version(getattr(reader, "library", reader.__module__.split(".")[0]))
    except metadata.PackageNotFoundError:
        code = getattr(reader, "__code__", None)
        body = repr((code.co_code, code.co_names, [c for c in code.co_consts if not hasattr(c, "co_code")])
                    if code else reader_name(reader))
        return f"code {hashlib.sha256(body.encode()).hexdigest()[:16]}"


def file_hashes(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """``path, sha256`` of every file's content as it is now, read in parallel."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", True).load(folder).where("length > 0")
            .select("path", F.sha2("content", 256).alias("sha256")))


def list_files(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """Files of a folder with their sizes; contents are not read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", True).load(folder)
            .select("path", "length", "modificationTime"))


def read_pages(spark: SparkSession, folder: str,
               reader: Callable[[bytes], list[str | None]] = pypdf_pages,
               pattern: str = "*.pdf") -> DataFrame:
    """One row per physical page, or one row without page for a file that has none.

    Such a row carries the reader's error, or no error for a file of zero pages. Every row
    holds its file's hash, so the file is read once for pages and provenance.

    A file is all or nothing: a reader that fails midway keeps none of its pages.
    """
    content = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
               .option("recursiveFileLookup", True).load(folder)
               .where("length > 0").select("path", "content"))

    def extract(batches):
        for batch in batches:
            for path, value in zip(batch["path"], batch["content"]):
                try:
                    texts, error = list(reader(bytes(value))), None
                except Exception as problem:
                    texts, error = [], str(problem) or type(problem).__name__
                digest = hashlib.sha256(bytes(value)).hexdigest()
                numbers = list(range(1, len(texts) + 1)) or [None]
                yield pd.DataFrame({"path": path, "page_number": pd.array(numbers, dtype="Int64"),
                                    "raw_text": texts or [None], "error": error,
                                    "sha256": digest})

    return content.mapInPandas(extract, PAGE_ROWS)


def relative_paths(rows: DataFrame, root: str) -> DataFrame:
    """File URIs as paths below ``root``, the form that ``source_path`` has."""
    local = F.regexp_replace("path", r"\A[a-z]+:/+", "/")
    start = F.lit(len(root.rstrip("/")) + 2)
    return rows.withColumn("path", F.substring(local, start, F.length(local)))


def pages_of_papers(papers: DataFrame, page_rows: DataFrame, root: str) -> DataFrame:
    """Cleaned pages of the papers whose ``source_path`` lies under ``root``."""
    placed = relative_paths(page_rows.where("page_number IS NOT NULL"), root).select(
        F.col("path").alias("source_path"), "page_number",
        clean_text(F.col("raw_text")).alias("text"))
    return papers.join(placed, "source_path").select(*schemas.PAGES.names)


def paper_failures(papers: DataFrame, page_rows: DataFrame, root: str) -> DataFrame:
    """``paper_id, status`` of every paper whose file gave no page, by the reader's finding."""
    files = relative_paths(page_rows, root).groupBy(F.col("path").alias("source_path")).agg(
        F.count("page_number").alias("pages"), F.max("error").alias("error"), F.lit(True).alias("found"))
    status = (F.when(F.col("found").isNull(), "missing_pdfs")
              .when(F.col("error").isNotNull(), "parsing_failures")
              .otherwise("papers_without_usable_text"))
    return papers.join(files, "source_path", "left").where("coalesce(pages, 0) = 0").select(
        "paper_id", status.alias("status"))


def source_ledger(papers: DataFrame, page_rows: DataFrame, root: str,
                  reader: Callable = pypdf_pages) -> DataFrame:
    """One entry for each paper: its file's hash, who read it, and what came of it."""
    files = relative_paths(page_rows, root).groupBy(F.col("path").alias("source_path")).agg(
        F.max("sha256").alias("sha256"), F.count("page_number").alias("pages"), F.max("error").alias("error"))
    found = F.col("sha256").isNotNull()
    status = (F.when(~found, ledger.MISSING).when(F.col("pages") > 0, ledger.READ)
              .when(F.col("error").isNotNull(), "parsing_failures").otherwise("papers_without_usable_text"))
    return papers.join(files, "source_path", "left").select(
        "paper_id", "source_path", "sha256", F.when(found, F.lit(reader_name(reader))).alias("reader"),
        F.when(found, F.lit(reader_version(reader))).alias("reader_version"), status.alias("status"))


def has_pdf_header(content) -> bool:
    return bytes(content).startswith(V.PDF_MAGIC)
