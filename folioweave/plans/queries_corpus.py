"""Queries on corpus facts, set comparison and reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioweave import fixed_values as V
from folioweave.functions import identity, text as X
from folioweave.operators import chunking, contracts, facts, ledger, sets
from folioweave.plans import corpus, sql_parts as S
from folioweave.plans.queries_text import FIXED
from folioweave.plans.registry import query
from folioweave.sources.files import alias_violations

_COVERAGE = f"""{S.PAGES}, {S.fixed_chunks()}, {S.REQUESTED},
page_sums AS (SELECT paper_id, count(*) AS page_count, count(*) FILTER (WHERE NOT {S.blank('text')}) AS usable_pages,
  count(*) FILTER (WHERE text = '') AS empty_pages, sum(length(text))::BIGINT AS characters FROM requested_pages GROUP BY 1),
chunk_sums AS (SELECT paper_id, count(*) AS chunk_count FROM spans GROUP BY 1),
coverage AS (SELECT d.paper_id, coalesce(page_count, 0) AS page_count, coalesce(usable_pages, 0) AS usable_pages,
  coalesce(empty_pages, 0) AS empty_pages, coalesce(characters, 0)::BIGINT AS characters,
  coalesce(chunk_count, 0) AS chunk_count,
  CASE WHEN coalesce(usable_pages, 0) > 0 THEN 'included' WHEN page_count IS NULL THEN 'missing_page_papers'
       ELSE 'papers_without_usable_text' END AS status
  FROM requested d LEFT JOIN page_sums USING (paper_id) LEFT JOIN chunk_sums USING (paper_id))"""


@query("paper_coverage", f"WITH {_COVERAGE} SELECT * FROM coverage")
def paper_coverage(spark, sf):
    pages = corpus.requested_pages(spark, sf)
    return facts.paper_coverage(corpus.requested_papers(spark, sf), pages, chunking.cut_pages(
        pages.select("paper_id", "text"), FIXED))


@query("quality_facts", f"""WITH {_COVERAGE},
c AS (SELECT count(*) AS requested_papers, count(*) FILTER (WHERE status = 'included') AS included_papers,
        count(*) FILTER (WHERE status <> 'included') AS excluded_papers FROM coverage),
p AS (SELECT count(*) AS pages_loaded, count(*) FILTER (WHERE {S.blank('text')}) AS blank_pages FROM requested_pages),
k AS (SELECT count(*) AS chunks_written, count(DISTINCT {S.chunk_id(FIXED.profile_hash())}) AS unique_chunk_ids,
        count(*) FILTER (WHERE {S.blank('text')}) AS whitespace_chunk_count,
        coalesce(max(length(text)), 0)::BIGINT AS maximum_chunk_characters FROM spans)
SELECT CASE WHEN chunks_written = 0 THEN 'failure' WHEN included_papers = requested_papers THEN 'success'
         ELSE 'partial_failure' END AS outcome, *,
  CASE WHEN chunks_written > 0 THEN true END AS storage_round_trip_valid, 'not_requested' AS tokenizer_validation
FROM c, p, k""")
def quality_facts(spark, sf):
    pages = corpus.requested_pages(spark, sf)
    return facts.quality_facts(corpus.requested_papers(spark, sf), pages,
                               chunking.chunk_pages(pages, FIXED), FIXED.profile)


@query("blank_pages", f"WITH {S.PAGES} SELECT paper_id, page_number FROM paper_pages WHERE {S.blank('text')}")
def blank_pages(spark, sf):
    return facts.blank_pages(corpus.pages(spark, sf))


@query("extraction_report", f"""WITH {_COVERAGE},
r AS (SELECT count(*) AS papers_attempted, count(*) FILTER (WHERE characters > 0) AS papers_succeeded,
  sum(page_count)::BIGINT AS pages_extracted, sum(empty_pages)::BIGINT AS empty_page_count,
  count(*) FILTER (WHERE page_count = 0 AND paper_id NOT IN (SELECT paper_id FROM withheld WHERE reason = 0)) AS missing_pdfs,
  (SELECT count(*) FROM withheld WHERE reason = 0) AS parsing_failures,
  count(*) FILTER (WHERE page_count > 0 AND characters = 0) AS papers_without_usable_text,
  sum(characters)::BIGINT AS extracted_characters FROM coverage)
SELECT CASE WHEN extracted_characters = 0 THEN 'failure' WHEN papers_succeeded = papers_attempted THEN 'success'
  ELSE 'partial_failure' END AS outcome, *, pages_extracted - empty_page_count AS usable_page_count FROM r""")
def extraction_report(spark, sf):
    failed = corpus.withheld(spark, sf).select("paper_id", "status")
    return facts.extraction_report(corpus.requested_papers(spark, sf),
                                   corpus.requested_pages(spark, sf), failed)


@query("page_contiguity", f"""WITH {S.PAGES}
SELECT paper_id, count(*) AS page_rows, count(DISTINCT page_number) AS distinct_pages,
  min(page_number) AS first_page, max(page_number) AS last_page,
  min(page_number) = 1 AND max(page_number) = count(*) AND count(DISTINCT page_number) = count(*) AS contiguous
FROM paper_pages GROUP BY paper_id""")
def page_contiguity(spark, sf):
    return contracts.contiguity(corpus.pages(spark, sf)).select(
        "paper_id", "page_rows", "distinct_pages", "first_page", "last_page", "contiguous")


_DIGEST_SUMS = ", ".join(
    f"sum(('0x' || substring(h, {1 + i * 15}, 15))::BIGINT::HUGEINT) AS w{i}" for i in range(4))


@query("dataset_digest", f"""WITH {S.PAGES},
rows AS (SELECT sha256('{{"page_number":' || page_number || ',"paper_id":"' || paper_id ||
  '","text_sha256":"' || sha256(text) || '"}}') AS h FROM paper_pages),
sums AS (SELECT count(*) AS record_count, {_DIGEST_SUMS} FROM rows)
SELECT record_count, sha256(concat_ws(':', record_count, w0, w1, w2, w3)) AS sha256 FROM sums""")
def dataset_digest(spark, sf):
    pages = corpus.pages(spark, sf)
    return identity.table_digest(pages.select(
        "paper_id", "page_number", identity.sha256(F.col("text")).alias("text_sha256")))


def _listing(spark, sf):
    """The files of all documents; sources that end in 3 hold empty ones."""
    rows = corpus.described_documents(spark, sf)
    size = F.when(F.endswith("source", F.lit("3")), 0).otherwise(F.length("text"))
    return rows.select(
        F.col("source_path").alias("path"), size.alias("length"))


@query("catalog_report", f"""WITH {S.DESCRIBED},
a AS (SELECT length(text) > 0 AND NOT ends_with(source, '3') AS available FROM described
  UNION ALL SELECT false FROM (SELECT DISTINCT item_id FROM benchmark)),
c AS (SELECT count(*) AS manifest_papers, count(*) FILTER (WHERE available) AS available_pdfs,
  count(*) FILTER (WHERE NOT available) AS missing_pdfs FROM a)
SELECT CASE WHEN available_pdfs = 0 THEN 'failure' WHEN missing_pdfs = 0 THEN 'success' ELSE 'partial_failure' END
  AS outcome, * FROM c""")
def catalog_report(spark, sf):
    return facts.catalog_report(corpus.requested_papers(spark, sf), _listing(spark, sf))


@query("outcome_codes", f"""WITH {_COVERAGE},
g AS (SELECT source, count(*) AS requested, count(*) FILTER (WHERE status = 'included') AS included,
        sum(chunk_count) AS chunks FROM coverage JOIN requested USING (paper_id) GROUP BY source)
SELECT source, CASE WHEN chunks = 0 THEN 'failure' WHEN included = requested THEN 'success' ELSE 'partial_failure' END AS outcome,
  CASE WHEN chunks = 0 THEN 3 WHEN included = requested THEN 0 ELSE 2 END AS exit_code FROM g""")
def outcome_codes(spark, sf):
    pages = corpus.requested_pages(spark, sf)
    papers = corpus.requested_papers(spark, sf)
    covered = facts.paper_coverage(papers, pages, chunking.cut_pages(
        pages.select("paper_id", "text"), FIXED))
    source = papers.select("paper_id", F.replace(F.get("authors", F.lit(0)), F.lit("Author "),
                                                 F.lit("")).alias("source"))
    grouped = covered.join(source, "paper_id").groupBy("source").agg(
        F.count("*").alias("requested"), F.count_if(F.col("status") == "included").alias("included"),
        F.sum("chunk_count").alias("chunks"))
    result = facts.outcome(F.col("included"), F.col("requested"), F.col("chunks"))
    return grouped.select("source", result.alias("outcome")).withColumn(
        "exit_code", facts.exit_code(F.col("outcome")))


@query("source_failures", f"""WITH {_COVERAGE}, f AS (SELECT CASE reason WHEN 0 THEN 'parsing_failures' WHEN 1 THEN 'missing_pdfs'
  WHEN 2 THEN 'papers_without_usable_text' ELSE status END AS category, paper_id
  FROM coverage LEFT JOIN withheld USING (paper_id) WHERE status <> 'included'),
n AS (SELECT unnest(['missing_pdfs', 'parsing_failures', 'papers_without_usable_text', 'missing_page_papers']) AS category)
SELECT category, count(paper_id) AS papers,
  (SELECT count(*) = count(DISTINCT paper_id) AND count(*) = (SELECT count(*) FROM requested WHERE paper_id NOT IN (
     SELECT paper_id FROM requested_pages WHERE NOT {S.blank('text')}))
   FROM f WHERE category IN (SELECT category FROM n)) AS partitions_exclusions
FROM n LEFT JOIN f USING (category) GROUP BY category""")
def source_failures(spark, sf):
    """Failure classes with their sizes, and whether they split the exclusions exactly."""
    failures = corpus.withheld(spark, sf).select("paper_id", "status")
    covered = facts.paper_coverage(corpus.requested_papers(spark, sf),
                                   corpus.requested_pages(spark, sf), None, failures)
    excluded = covered.where("status <> 'included'")
    flags = [F.count_if(F.col("status") == name).alias(name) for name in V.FAILURE_CATEGORIES]
    row = excluded.agg(F.count("*").alias("excluded"),
                       F.count_distinct("paper_id").alias("distinct_ids"), *flags)
    total = sum((F.col(name) for name in V.FAILURE_CATEGORIES[1:]), F.col(V.FAILURE_CATEGORIES[0]))
    exact = (total == F.col("excluded")) & (F.col("excluded") == F.col("distinct_ids"))
    pairs = F.array(*[F.struct(F.lit(name).alias("category"), F.col(name).alias("papers"))
                      for name in V.FAILURE_CATEGORIES])
    return row.select(exact.alias("partitions_exclusions"), F.explode(pairs).alias("p")).select(
        "p.category", "p.papers", "partitions_exclusions")


# ---- joins and sets -------------------------------------------------------------

@query("corpus_coverage", """SELECT doc_id, CASE WHEN d.doc_id IS NOT NULL AND l.doc_id IS NOT NULL THEN 'shared'
  WHEN d.doc_id IS NOT NULL THEN 'passages_only' ELSE 'metadata_only' END AS side
FROM (SELECT DISTINCT doc_id FROM documents) d
FULL OUTER JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)""")
def corpus_coverage(spark, sf):
    passages = corpus.documents(spark, sf).select("doc_id")
    return sets.id_coverage(passages, corpus.table(spark, sf, "labels").select("doc_id"), "doc_id",
                            ("shared", "passages_only", "metadata_only"))


@query("new_papers", f"""WITH {S.DESCRIBED} SELECT paper_id, title, published FROM described
WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def new_papers(spark, sf):
    known = corpus.table(spark, sf, "labels").select("doc_id")
    fresh = sets.unseen(corpus.described_documents(spark, sf), known, "doc_id")
    return fresh.select("paper_id", "title", "published")


_RECONCILE = f"""WITH {S.PAGES}, {S.fixed_chunks()},
ids AS (SELECT {S.chunk_id(FIXED.profile_hash())} AS id, text, lang, page_number FROM spans),
stored AS (SELECT id, CASE WHEN lang = 'fr' THEN text || ' ' ELSE text END AS text FROM ids WHERE page_number <> 3
  UNION ALL SELECT 'old:' || id, text FROM ids WHERE lang = 'es'),
acts AS (SELECT coalesce(i.id, s.id) AS id, CASE WHEN s.id IS NULL THEN 'new' WHEN i.id IS NULL THEN 'stale'
  WHEN i.text = s.text THEN 'unchanged' ELSE 'changed' END AS action
  FROM (SELECT * FROM ids) i FULL OUTER JOIN stored s ON i.id = s.id)"""


def _reconciled(spark, sf):
    pages = corpus.pages(spark, sf)
    wanted = chunking.chunk_pages(pages, FIXED).select(
        F.col("chunk_id").alias("id"), "text", "page_number",
        F.substring(F.get("authors", F.lit(1)), 8, 2).alias("lang"))
    kept = wanted.where("page_number <> 3").select("id", F.when(
        F.col("lang") == "fr", F.concat("text", F.lit(" "))).otherwise(F.col("text")).alias("text"))
    old = wanted.where("lang = 'es'").select(F.concat(F.lit("old:"), "id").alias("id"), "text")
    return sets.reconcile(wanted.select("id", "text"), kept.unionByName(old), "id", ["text"])


@query("vector_reconcile", f"{_RECONCILE} SELECT id, action FROM acts")
def vector_reconcile(spark, sf):
    return _reconciled(spark, sf)


@query("index_changes", f"""{_RECONCILE} SELECT count(*) FILTER (WHERE action IN ('new', 'changed')) AS updated,
  count(*) FILTER (WHERE action = 'stale') AS removed, count(*) FILTER (WHERE action = 'unchanged') AS kept,
  bool_and(action = 'unchanged') AS fresh FROM acts""")
def index_changes(spark, sf):
    acts = _reconciled(spark, sf)
    action = F.col("action")
    return acts.agg(F.count_if(action.isin("new", "changed")).alias("updated"),
                    F.count_if(action == "stale").alias("removed"),
                    F.count_if(action == "unchanged").alias("kept"),
                    F.bool_and(action == "unchanged").alias("fresh"))


@query("duplicate_sources", """SELECT sha256(text) AS content_sha256, count(*) AS papers, min(doc_id) AS first_doc
FROM documents GROUP BY 1 HAVING count(*) > 1""")
def duplicate_sources(spark, sf):
    """Papers that share the same file content under different names."""
    hashed = corpus.documents(spark, sf).select("doc_id", identity.sha256(F.col("text")).alias(
        "content_sha256"))
    return hashed.groupBy("content_sha256").agg(
        F.count("*").alias("papers"), F.min("doc_id").alias("first_doc")).where("papers > 1")


@query("manifest_equality", f"""WITH {S.DESCRIBED},
other AS (SELECT paper_id, CASE WHEN lang = 'de' THEN lower(title) ELSE title END AS title FROM described WHERE source <> 'src5'),
mine AS (SELECT paper_id, title FROM described),
l AS (SELECT * FROM mine EXCEPT ALL SELECT * FROM other), r AS (SELECT * FROM other EXCEPT ALL SELECT * FROM mine)
SELECT (SELECT count(*) FROM l) AS only_manifest, (SELECT count(*) FROM r) AS only_generation,
  (SELECT count(*) FROM l) + (SELECT count(*) FROM r) = 0 AS equal""")
def manifest_equality(spark, sf):
    rows = corpus.described_documents(spark, sf)
    other = rows.where("source <> 'src5'").withColumn(
        "title", F.when(F.col("lang") == "de", F.lower("title")).otherwise(F.col("title")))
    odd = sets.row_differences(rows.select("paper_id", "title"), other.select("paper_id", "title"))
    surplus = F.col("surplus")
    return odd.agg(
        F.coalesce(F.sum(F.greatest(surplus, F.lit(0))), F.lit(0)).cast("long").alias("only_manifest"),
        F.coalesce(F.sum(F.greatest(-surplus, F.lit(0))), F.lit(0)).cast("long").alias("only_generation"),
        (F.count("*") == 0).alias("equal"))


@query("storage_round_trip", f"""WITH {S.PAGES}, {S.fixed_chunks()},
lines AS (SELECT *, to_json({{'p': paper_id, 'n': page_number, 's': start_character, 'e': end_character, 't': text}}) AS line FROM spans),
checked AS (SELECT json_extract_string(line, '$.t') = text AND json_extract_string(line, '$.p') = paper_id
  AND CAST(json_extract(line, '$.n') AS BIGINT) = page_number AND CAST(json_extract(line, '$.s') AS BIGINT) = start_character
  AND CAST(json_extract(line, '$.e') AS BIGINT) = end_character AS same FROM lines)
SELECT count(*) AS chunks, count(*) FILTER (WHERE same IS DISTINCT FROM true) AS differing_rows,
  CASE WHEN count(*) > 0 THEN coalesce(bool_and(same), false) END AS storage_round_trip_valid FROM checked""")
def storage_round_trip(spark, sf):
    """Passages encoded to JSON lines and decoded again must be the same multiset."""
    chunks = chunking.chunk_pages(corpus.pages(spark, sf), FIXED)
    whole = F.struct(*[F.col(n) for n in chunks.columns])
    line = F.to_json(whole, {"ignoreNullFields": "false"})
    back = chunks.select(F.from_json(line, chunks.schema).alias("r")).select("r.*")
    odd = sets.row_differences(chunks, back).agg(F.count("*").alias("n"))
    parts = chunks.agg(F.count("*").alias("n")).select(
        F.col("n").alias("chunks"), F.lit(0).cast("long").alias("differing_rows")).unionByName(
            odd.select(F.lit(0).cast("long").alias("chunks"), F.col("n").alias("differing_rows")))
    total = parts.agg(F.sum("chunks").alias("chunks"),
                      F.sum("differing_rows").alias("differing_rows"))
    valid = F.when(F.col("chunks") > 0, F.col("differing_rows") == 0)
    return total.select("chunks", "differing_rows", valid.alias("storage_round_trip_valid"))


@query("catalog_merge", f"""WITH {S.DESCRIBED},
added AS (SELECT paper_id, upper(title) AS title, published FROM described WHERE lang = 'fr'),
kept AS (SELECT paper_id, title, published FROM described WHERE lang <> 'fr')
SELECT * FROM kept UNION ALL SELECT * FROM added""")
def catalog_merge(spark, sf):
    """Delivered French entries join a manifest: those of one source are new, the others replace old ones."""
    rows = corpus.described_documents(spark, sf).select("paper_id", "title", "published", "lang",
                                                        "source")
    stored = rows.where("lang <> 'fr' OR source <> 'src2'")
    added = rows.where("lang = 'fr'").withColumn("title", F.upper("title"))
    doubled = added.withColumn("title", F.lower("title")).withColumn(
        "arrival", F.lit(1)).unionByName(added.withColumn("arrival", F.lit(2)))
    last = sets.keep_last(doubled, "paper_id", "arrival").drop("arrival")
    return sets.merge_rows(stored, last, "paper_id").select("paper_id", "title", "published")


def _ledger(spark, sf):
    """A source ledger of all requested papers; papers of a kind get one damage each."""
    read = corpus.described_documents(spark, sf).select(
        "paper_id", "source_path", F.lit("read").alias("status"), F.col("doc_id").alias("kind"))
    # a file whose only page is blank was read like any other
    opened = F.when(F.col("status") == "papers_without_usable_text", "read").otherwise(F.col("status"))
    held = corpus.withheld(spark, sf).select("paper_id", "source_path", opened.alias("status"), F.lit(-1).alias("kind"))
    kind = F.col("kind") % 9
    found = F.col("status") != "missing_pdfs"
    entries = read.unionByName(held).select(
        "paper_id", F.when(kind == 1, F.lit("data/elsewhere.pdf")).otherwise(F.col("source_path")).alias("source_path"),
        F.when(kind == 2, F.upper(identity.sha256(F.col("paper_id")))).when(found, identity.sha256(F.col("paper_id"))).alias("sha256"),
        F.when(found, F.lit("pypdf")).alias("reader"),
        F.when(kind == 3, F.lit(" ")).when(found, F.lit("6.0")).alias("reader_version"),
        F.when(kind == 4, F.lit("missing_page_papers")).when(kind == 5, F.lit("parsing_failures"))
        .otherwise(F.col("status")).alias("status"),
        F.explode(F.when(kind == 6, F.array(F.lit(0), F.lit(1))).when(kind == 7, F.array().cast("array<int>"))
                  .otherwise(F.array(F.lit(0)))).alias("copy"))
    unknown = corpus.table(spark, sf, "labels").select(F.format_string("8888.%05dv1", F.col("doc_id")).alias("paper_id")).distinct()
    return entries.drop("copy").unionByName(unknown.select(
        "paper_id", F.lit("data/none.pdf").alias("source_path"), F.lit(None).cast("string").alias("sha256"),
        F.lit(None).cast("string").alias("reader"), F.lit(None).cast("string").alias("reader_version"),
        F.lit("missing_pdfs").alias("status")))


@query("ledger_violations", f"""WITH {S.PAGES}, {S.REQUESTED},
paged AS (SELECT DISTINCT paper_id FROM requested_pages),
wrong AS (SELECT paper_id, doc_id % 9 AS kind FROM described),
rules AS (SELECT CASE kind WHEN 1 THEN 'source_path' WHEN 2 THEN 'file_hash' WHEN 3 THEN 'reader' WHEN 4 THEN 'class_of_mode'
    WHEN 6 THEN 'entry_repeated' WHEN 7 THEN 'entry_missing' END AS rule, paper_id AS key FROM wrong
  UNION ALL SELECT 'pages', paper_id FROM wrong WHERE (kind = 4 OR kind = 5) AND paper_id IN (SELECT paper_id FROM paged)
  UNION ALL SELECT 'pages', paper_id FROM wrong WHERE kind NOT IN (4, 5, 7) AND paper_id NOT IN (SELECT paper_id FROM paged)
  UNION ALL SELECT 'entry_unknown', printf('8888.%05dv1', doc_id) FROM (SELECT DISTINCT doc_id FROM labels))
SELECT rule, key FROM rules WHERE rule IS NOT NULL""")
def ledger_violations(spark, sf):
    """Every damaged entry of a source ledger by the rule that it breaks."""
    return ledger.violations(corpus.requested_papers(spark, sf), corpus.requested_pages(spark, sf),
                             _ledger(spark, sf), "pdf_pipeline").select("rule", "key")


@query("file_aliases", f"""WITH {S.DESCRIBED}, f AS (SELECT paper_id, '/papers/' || source_path AS path, lang || ':' || md5(text) AS number FROM described),
shared AS (SELECT number, count(*) AS n, min(paper_id) AS key, max(paper_id) AS detail FROM f GROUP BY number)
SELECT 'source_path_alias' AS rule, key, detail FROM shared WHERE n > 1""")
def file_aliases(spark, sf):
    """Papers whose files are one file, where equal texts of a language stand for a file number."""
    rows = corpus.described_documents(spark, sf)
    return alias_violations(rows.select(
        "paper_id", F.concat(F.lit("/papers/"), "source_path").alias("real_path"),
        F.concat("lang", F.lit(":"), F.md5("text")).alias("file_key")))


@query("readable_sources", f"""WITH {S.DESCRIBED}, b AS (SELECT paper_id, CASE WHEN lang = 'en' THEN '%PDF-1.7 ' ELSE '<html> ' END || text AS body, text FROM described)
SELECT paper_id, starts_with(body, '%PDF-') AS has_magic,
  NOT {S.blank('text')} AS readable, sha256(body) AS file_sha256 FROM b""")
def readable_sources(spark, sf):
    """Magic bytes, readability and content hash of downloaded files."""
    rows = corpus.described_documents(spark, sf)
    head = F.when(F.col("lang") == "en", "%PDF-1.7 ").otherwise("<html> ")
    body = F.encode(F.concat(head, "text"), "UTF-8")
    return rows.select("paper_id", F.startswith(body, F.lit(V.PDF_MAGIC)).alias("has_magic"),
                       (~X.is_blank(F.col("text"))).alias("readable"),
                       F.sha2(body, 256).alias("file_sha256"))


@query("hash_contract", f"""WITH {S.PAGES},
signed AS (SELECT paper_id, page_number, CASE page_number % 4 WHEN 1 THEN sha256(text) WHEN 2 THEN upper(sha256(text))
  WHEN 3 THEN substring(sha256(text), 2) ELSE sha256(text) || '0' END AS signature FROM paper_pages)
SELECT paper_id, page_number, signature, regexp_full_match(signature, '[0-9a-f]{{64}}') AS valid FROM signed""")
def hash_contract(spark, sf):
    """Page hashes, three of four spelled wrongly, against the rule for hashes."""
    right = identity.sha256(F.col("text"))
    number = F.col("page_number") % 4
    spelled = (F.when(number == 1, right).when(number == 2, F.upper(right))
               .when(number == 3, F.substring(right, 2, 64)).otherwise(F.concat(right, F.lit("0"))))
    return corpus.pages(spark, sf).select("paper_id", "page_number", spelled.alias("signature")).withColumn(
        "valid", identity.is_hash(F.col("signature")))
