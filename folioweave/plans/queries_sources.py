"""Queries on feed parsing and record validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioweave import schemas
from folioweave.operators import contracts
from folioweave.plans import corpus, sql_parts as S
from folioweave.plans.registry import query
from folioweave.sources import atom, records


def _responses(spark, sf):
    """Atom responses for every document: French ones double the entry, German ones name
    another paper, Spanish ones carry no PDF link."""
    rows = corpus.described_documents(spark, sf)
    text = atom.escape_xml(F.col("title"))
    entry_id = F.when(F.col("lang") == "de", F.lit("http://arxiv.org/abs/9999.99999v1")).otherwise(
        F.concat(F.lit("http://arxiv.org/abs/"), "paper_id"))
    link = F.when(F.col("lang") == "es", F.lit("")).otherwise(F.concat(
        F.lit('<link href="http://arxiv.org/pdf/'), "paper_id",
        F.lit('" type="application/pdf" title="pdf" rel="related"/>')))
    entry = F.concat(
        F.lit("<entry><id> "), entry_id, F.lit("</id><title>\n  "), text,
        F.lit("\n</title><published>"), "published", F.lit("T12:00:00Z</published><author><name>A  "),
        "source", F.lit("</name></author><author><name>B "), "lang", F.lit("</name></author>"), link,
        F.lit('<category term="cs.AI"/></entry>'))
    body = F.when(F.col("lang") == "fr", F.concat(entry, entry)).otherwise(entry)
    xml = F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?><feed xmlns="http://www.w3.org/2005/Atom">'),
                   body, F.lit("</feed>"))
    return rows.select(F.col("paper_id").alias("requested_id"), xml.alias("xml"), "source_path", "lang")


@query("atom_entries", f"""WITH {S.DESCRIBED}
SELECT paper_id AS requested_id, CASE WHEN lang = 'de' THEN '9999.99999v1' ELSE paper_id END AS paper_id,
  'v1' AS paper_version, {S.squeeze('title')} AS title, 'A ' || source || '|B ' || lang AS authors, published,
  'https://arxiv.org/pdf/' || CASE WHEN lang = 'es' THEN paper_id ELSE paper_id END AS pdf_url,
  CASE WHEN lang = 'fr' THEN 'expected one entry, received 2' WHEN lang = 'de' THEN 'response is for 9999.99999v1' END AS error
FROM described""")
def atom_entries(spark, sf):
    parsed = atom.parse_entries(_responses(spark, sf))
    return parsed.select("requested_id", "paper_id", "paper_version", "title",
                         F.array_join("authors", "|").alias("authors"), "published", "pdf_url", "error")


@query("record_lines", f"""WITH {S.PAGES} SELECT CASE WHEN lang = 'fr' THEN 'invalid JSON' WHEN lang = 'de' THEN 'page_number'
  WHEN lang = 'es' THEN 'not an object' ELSE 'valid' END AS problem, count(*) AS lines FROM paper_pages GROUP BY 1""")
def record_lines(spark, sf):
    """Page records as JSON lines: French lines are cut off, German page numbers are
    booleans, Spanish lines are lists; blank lines are skipped."""
    pages = corpus.pages(spark, sf)
    line = F.to_json(F.struct(*[F.col(n) for n in schemas.PAGES.names]))
    lang = F.replace(F.get("authors", F.lit(1)), F.lit("Editor "), F.lit(""))
    number = F.concat(F.lit('"page_number":'), F.col("page_number").cast("string"))
    damaged = (F.when(lang == "fr", F.expr("left(line, length(line) - 1)"))
               .when(lang == "de", F.replace("line", number, F.lit('"page_number":true')))
               .when(lang == "es", F.concat(F.lit("["), "line", F.lit("]")))
               .otherwise(F.col("line")))
    lines = pages.withColumn("line", line).select(F.explode(F.array(damaged, F.lit(" \t"))).alias("value"))
    parsed = records.parse_lines(lines, schemas.PAGES)
    return parsed.groupBy(F.coalesce("problem", F.lit("valid")).alias("problem")).agg(
        F.count("*").alias("lines"))


@query("missing_fields", f"""WITH {S.DESCRIBED} SELECT paper_id AS key, CASE WHEN lang = 'fr' THEN 'title' WHEN lang = 'de' THEN 'pdf_url,published'
  WHEN lang = 'es' THEN 'authors' ELSE '' END AS missing FROM described""")
def missing_fields(spark, sf):
    rows = corpus.described_documents(spark, sf)
    lang = F.col("lang")
    gaps = {"title": "fr", "published": "de", "pdf_url": "de", "authors": "es"}
    holed = rows.withColumns({name: F.when(lang != code, F.col(name)) for name, code in gaps.items()})
    return holed.select(F.col("paper_id").alias("key"),
                        F.array_join(contracts.missing_fields(), ",").alias("missing"))
