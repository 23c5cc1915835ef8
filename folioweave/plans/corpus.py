"""The paper corpus that the driver tables stand for.

One document is one paper. Eight text lines make one physical page, so page numbers come
from the document itself (no window over a large group). Raw page text carries layout
noise of the kind that PDF readers leave behind; cleaning removes it again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from folioweave import schemas
from folioweave.functions.text import clean_text, extract_abstract, squeeze, strip

LINES_PER_PAGE = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def paper_id(doc_id: Column) -> Column:
    """arXiv-shaped and unique for every non-negative id."""
    return F.format_string(
        "%04d.%05dv%d", F.expr("(doc_id div 100000) % 10000"), doc_id % 100000,
        F.expr("1 + doc_id div 1000000000"))


def _described(docs: DataFrame) -> DataFrame:
    """Documents with every paper field beside their text; a narrow projection."""
    pid = paper_id(F.col("doc_id"))
    named = docs.withColumns({
        "paper_id": pid,
        "paper_version": F.regexp_extract(pid, r"v\d+\z", 0),
        "head": strip(F.substring(squeeze(F.substring_index("text", "\n", 1)), 1, 80)),
        "authors": F.array(F.concat(F.lit("Author "), "source"),
                           F.concat(F.lit("Editor "), "lang")),
        "published": F.date_format(F.date_add(F.lit("2024-01-01").cast("date"),
                                              (F.col("doc_id") % 366).cast("int")), "yyyy-MM-dd"),
        "pdf_url": F.concat(F.lit("https://arxiv.org/pdf/"), pid),
        "source_path": F.concat(F.lit("data/"), "source", F.lit("/"), pid, F.lit(".pdf")),
        "categories": F.array("lang"),
        "url": F.concat(F.lit("https://arxiv.org/abs/"), pid)})
    title = F.when(F.length("head") > 0, F.col("head")).otherwise(
        F.concat(F.lit("Paper "), "paper_id"))
    return named.withColumn("title", title)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as they are read; where a session asks for it, dealt out first.

    ``folioweave.readPartitions`` serves small files of one row group, whose scan is one
    task. It is unset by default, so a large table is never shuffled before its work.
    """
    rows = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    wanted = spark.conf.get("folioweave.readPartitions", None)
    return rows.repartition(int(wanted), "doc_id") if wanted else rows


def described_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _described(documents(spark, sf_dir))


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (_described(documents(spark, sf_dir))
            .withColumn("abstract", extract_abstract(F.col("text")))
            .select(*schemas.SEARCH_PAPERS.names))


NOISE = ((". ", ".\r\n\r\n\r\n "), (", ", ",\u00a0\t "), (" the ", " the\x00 "),
         (" of ", " of\x0b "))
BLANK_PAGE = " \n\t"


def add_noise(text: Column) -> Column:
    """Reader noise: CRLF blank runs, NBSP and tabs, NUL and vertical tabs."""
    for old, new in NOISE:
        text = F.replace(text, F.lit(old), F.lit(new))
    return F.concat(F.lit("  "), text)


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uncleaned pages: lines in groups of eight; German papers end in a blank page."""
    docs = _described(documents(spark, sf_dir))
    last = F.expr(f"cast((size(lines) - 1) div {LINES_PER_PAGE} as int)")
    groups = F.transform(F.sequence(F.lit(0), last), lambda g: F.array_join(
        F.slice(F.col("lines"), g * LINES_PER_PAGE + 1, F.lit(LINES_PER_PAGE)), "\n"))
    tail = F.when(F.col("lang") == "de", F.array(F.lit(BLANK_PAGE)))
    tail = tail.otherwise(F.array().cast("array<string>"))
    body = F.transform(groups, add_noise)
    citation = [name for name, _ in schemas.CITATION]
    return (docs.withColumn("lines", F.split("text", "\n"))
            .select(*citation, F.posexplode_outer(F.concat(body, tail)).alias("index", "raw_text"))
            .select(*citation, (F.col("index") + 1).cast("long").alias("page_number"),
                    "raw_text"))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_pages(spark, sf_dir).withColumn("text", clean_text(F.col("raw_text"))).select(
        *schemas.PAGES.names)


def withheld(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers beside the documents whose files cannot be used, one for each benchmark item.

    In turn a file no reader can open, one that is absent, and one with a blank page.
    """
    pid = F.format_string("9999.%05dv1", F.col("item_id"))
    return table(spark, sf_dir, "benchmark").select("item_id").distinct().select(
        pid.alias("paper_id"), F.lit("v1").alias("paper_version"), F.lit("Withheld").alias("title"),
        F.array(F.lit("Author withheld"), F.lit("Editor none")).alias("authors"),
        F.concat(F.lit("data/withheld/"), pid, F.lit(".pdf")).alias("source_path"),
        F.element_at(F.array(F.lit("parsing_failures"), F.lit("missing_pdfs"),
                             F.lit("papers_without_usable_text")),
                     (F.col("item_id") % 3 + 1).cast("int")).alias("status"))


def requested_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = withheld(spark, sf_dir).drop("status")
    return papers(spark, sf_dir).unionByName(extra, allowMissingColumns=True)


def requested_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    blank = withheld(spark, sf_dir).where("status = 'papers_without_usable_text'").select(
        "paper_id", F.lit(1).cast("long").alias("page_number"), F.lit("").alias("text"))
    return pages(spark, sf_dir).unionByName(blank, allowMissingColumns=True)
