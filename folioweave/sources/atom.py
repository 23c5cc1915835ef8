"""Atom responses to paper records, parsed by Spark's XML reader functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from folioweave import fixed_values as V, schemas
from folioweave.functions import identity
from folioweave.functions.text import squeeze, strip

_TEXT = T.StringType()
_LINK = T.StructType([T.StructField(n, _TEXT) for n in ("_href", "_title", "_type", "_rel")])
_AUTHOR = T.StructType([T.StructField("name", _TEXT)])
_ENTRY = T.StructType([
    T.StructField("id", _TEXT), T.StructField("title", _TEXT), T.StructField("published", _TEXT),
    T.StructField("summary", _TEXT), T.StructField("author", T.ArrayType(_AUTHOR)),
    T.StructField("link", T.ArrayType(_LINK)),
    T.StructField("category", T.ArrayType(T.StructType([T.StructField("_term", _TEXT)])))])
FEED = T.StructType([T.StructField("entry", T.ArrayType(_ENTRY))])


def parse_entries(responses: DataFrame) -> DataFrame:
    """Paper fields and an ``error`` per response ``(requested_id, xml, source_path)``.

    A response must hold exactly one entry for the requested identifier.
    """
    feed = responses.withColumn("feed", F.from_xml("xml", FEED, {"mode": "PERMISSIVE"}))
    entries = F.coalesce(F.size("feed.entry"), F.lit(0))
    entry = F.get("feed.entry", F.lit(0))
    parts = feed.withColumns({"entries": F.when(F.col("feed.entry").isNull(), 0).otherwise(entries),
                              "entry": entry})
    pid = identity.abs_id(F.col("entry.id"))
    named = parts.withColumn("paper_id", F.coalesce(pid, F.lit("")))
    pdf_links = F.filter("entry.link", lambda x: x["_type"].eqNullSafe(F.lit("application/pdf"))
                         | x["_title"].eqNullSafe(F.lit("pdf")))
    fallback = F.concat(F.lit("https://arxiv.org/pdf/"), F.col("paper_id"))
    has_link = F.coalesce(F.size(pdf_links), F.lit(0)) > 0
    link = F.when(has_link, F.coalesce(F.get(pdf_links, F.lit(0))["_href"], F.lit(""))
                  ).otherwise(fallback)
    fields = named.withColumns({
        "paper_version": identity.version_of(F.col("paper_id")),
        "title": squeeze(F.coalesce("entry.title", F.lit(""))),
        "authors": F.transform("entry.author", lambda a: squeeze(F.coalesce(a["name"], F.lit("")))),
        "published": F.substring("entry.published", 1, 10),
        "pdf_url": identity.https_once(link),
        "categories": F.transform("entry.category", lambda c: c["_term"]),
        "url": strip(F.col("entry.id")),
        "abstract": squeeze(F.col("entry.summary"))})
    same = F.lower("paper_id") == F.lower("requested_id")
    problem = (F.when(F.col("entries") != 1, F.format_string(
                   "expected one entry, received %d", F.col("entries")))
               .when(~identity.is_paper_id(F.col("paper_id")),
                     F.lit("missing or malformed versioned identifier"))
               .when(~same, F.concat(F.lit("response is for "), F.col("paper_id"))))
    return fields.select("requested_id", *schemas.SEARCH_PAPERS.names, problem.alias("error"))


def escape_xml(text: Column) -> Column:
    for raw, coded in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(raw), F.lit(coded))
    return text


def query_url(paper_id: str) -> str:
    from urllib.parse import urlencode
    return f"{V.ARXIV_API_URL}?{urlencode({'id_list': paper_id, 'max_results': 1})}"
