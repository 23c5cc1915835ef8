"""Queries on text functions, record contracts and passages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from folioweave import fixed_values as V
from folioweave.functions import identity, text as X
from folioweave.operators import chunking, contracts, facts
from folioweave.plans import corpus, sql_parts as S
from folioweave.plans.registry import query
from folioweave.sources.files import shared_folder
from folioweave.sources.tokenizer import JsonTokenizer, PatternTokenizer

FIXED = chunking.ChunkSettings(profile="fixed_characters")
BOUNDARY = chunking.ChunkSettings()
TOKENS = chunking.ChunkSettings(profile="tokenizer")
SPAN_COLUMNS = ("chunk_id", "paper_id", "page_number", "start_character", "end_character",
                "text", "page_text_sha256", "chunking_profile_sha256")


def _variants(rows: DataFrame, keep: list[str], named: dict) -> DataFrame:
    """One row per named variant of a value."""
    pairs = [F.struct(F.lit(name).alias("variant"), value.alias("value"))
             for name, value in named.items()]
    return rows.select(*keep, F.explode(F.array(*pairs)).alias("v")).select(*keep, "v.*")


def _sql_variants(source: str, keep: str, named: dict[str, str]) -> str:
    rows = ", ".join(f"{{'variant': '{n}', 'value': {x}}}" for n, x in named.items())
    return (f"SELECT {keep}, v.variant AS variant, v.value AS value FROM "
            f"(SELECT *, unnest([{rows}]) AS v FROM {source})")


@query("clean_pages", f"WITH {S.PAGES} SELECT paper_id, page_number, text FROM paper_pages")
def clean_pages(spark, sf):
    return corpus.pages(spark, sf).select("paper_id", "page_number", "text")


@query("text_normalization", f"""
WITH {S.DESCRIBED}, t AS (SELECT doc_id, text, {S.squeeze('text')} AS squeezed FROM described),
r AS (SELECT *, trim(trim({S.strip("'  \"' || squeezed || '.\" '")}, '"'''), '') AS a FROM t),
c AS (SELECT *, substring(regexp_replace(a, '\\.+\\z', ''), 1, 80) AS b FROM r)
SELECT doc_id, squeezed, substring(squeezed, 1, 150) AS snippet,
  CASE WHEN length(squeezed) <= 40 THEN squeezed
       ELSE regexp_replace(substring(squeezed, 1, 39), '{S.WS}+\\z', '') || '…' END AS label,
  CASE WHEN length(b) > 0 THEN b ELSE '{V.UNTITLED}' END AS title
FROM c""")
def text_normalization(spark, sf):
    docs = corpus.documents(spark, sf)
    squeezed = X.squeeze(F.col("text"))
    reply = F.concat(F.lit('  "'), squeezed, F.lit('." '))
    return docs.select("doc_id", squeezed.alias("squeezed"),
                       X.snippet(F.col("text"), 150).alias("snippet"),
                       X.shorten(squeezed).alias("label"),
                       X.conversation_title(reply).alias("title"))


_FILE = "source || '_' || replace(title, ' ', '-_') || 'v1.PDF'"
_META = ("CASE lang WHEN 'en' THEN '  ' || title || ' ' WHEN 'fr' THEN 'Microsoft Word - ' || title "
         "WHEN 'es' THEN 'abc' END")
_HINTS = " OR ".join(f"contains(lower(m), '{h}')" for h in V.BAD_TITLE_HINTS)


@query("file_titles", f"""
WITH {S.DESCRIBED}, n AS (SELECT doc_id, {_FILE} AS f, {S.squeeze(_META)} AS m FROM described),
g AS (SELECT *, regexp_replace(f, '(?i)\\.pdf\\z', '') AS stem FROM n),
h AS (SELECT *, regexp_replace(CASE WHEN contains(stem, '_') THEN substring(stem, instr(stem, '_') + 1)
        ELSE stem END, 'v\\d+\\z', '') AS cut FROM g)
SELECT doc_id, f AS file_name, {S.strip("regexp_replace(cut, '[-_]+', ' ', 'g')")} AS from_name,
  CASE WHEN m IS NOT NULL AND length(m) BETWEEN 5 AND 200 AND NOT ({_HINTS}) THEN m
       ELSE {S.strip("regexp_replace(cut, '[-_]+', ' ', 'g')")} END AS title FROM h""")
def file_titles(spark, sf):
    papers = corpus.described_documents(spark, sf)
    name = F.concat("source", F.lit("_"), F.replace("title", F.lit(" "), F.lit("-_")),
                    F.lit("v1.PDF"))
    meta = (F.when(F.col("lang") == "en", F.concat(F.lit("  "), "title", F.lit(" ")))
            .when(F.col("lang") == "fr", F.concat(F.lit("Microsoft Word - "), "title"))
            .when(F.col("lang") == "es", F.lit("abc")))
    return papers.select("doc_id", name.alias("file_name"),
                         X.title_from_filename(name).alias("from_name"),
                         X.clean_title(meta, name).alias("title"))


_LEGACY = "lpad((doc_id % 10000000)::VARCHAR, 7, '0')"
_SQL_ID = r"\A(?:[a-z-]+(?:\.[A-Z]{2})?/\d{7}|\d{4}\.\d{4,5})v[1-9]\d*\z"
_ID_SQL = {
    "canonical": "paper_id", "padded": "' ' || paper_id || chr(160)",
    "line_end": "paper_id || chr(10)", "upper": "upper(paper_id)",
    "bare": "replace(paper_id, 'v', '')", "zero": "replace(paper_id, 'v', 'v0')",
    "legacy": f"'hep-th/' || {_LEGACY} || 'v2'", "classed": f"'cs.LG/' || {_LEGACY} || 'v1'",
    "lower_class": f"'cs.lg/' || {_LEGACY} || 'v1'"}


@query("identity_contract", f"""
WITH {S.DESCRIBED}, v AS ({_sql_variants('described', 'doc_id', _ID_SQL)})
SELECT doc_id, variant, regexp_matches(value, '{_SQL_ID}') AS is_valid,
  regexp_matches({S.strip('value')}, '{_SQL_ID}') AS is_valid_request,
  lower(regexp_extract({S.strip('value')}, '(?i)(v\\d+)\\z', 1)) AS version,
  ends_with(lower({S.strip('value')}), 'v1') AS is_first_version FROM v""")
def identity_contract(spark, sf):
    papers = corpus.described_documents(spark, sf)
    pid = F.col("paper_id")
    legacy = F.format_string("%07d", F.col("doc_id") % 10000000)
    rows = _variants(papers, ["doc_id"], {
        "canonical": pid, "padded": F.concat(F.lit(" "), pid, F.lit("\u00a0")),
        "line_end": F.concat(pid, F.lit("\n")), "upper": F.upper(pid),
        "bare": F.replace(pid, F.lit("v"), F.lit("")),
        "zero": F.replace(pid, F.lit("v"), F.lit("v0")),
        "legacy": F.concat(F.lit("hep-th/"), legacy, F.lit("v2")),
        "classed": F.concat(F.lit("cs.LG/"), legacy, F.lit("v1")),
        "lower_class": F.concat(F.lit("cs.lg/"), legacy, F.lit("v1"))})
    asked = X.strip(F.col("value"))
    return rows.select(
        "doc_id", "variant", identity.is_paper_id(F.col("value")).alias("is_valid"),
        identity.is_paper_id(asked).alias("is_valid_request"),
        identity.version_of(asked).alias("version"),
        identity.is_version_of(F.lit("v1"), asked).alias("is_first_version"))


_URL_SQL = {
    "https": "pdf_url", "http_suffix": "replace(pdf_url, 'https', 'http') || '.pdf'",
    "upper_host": "replace(replace(pdf_url, 'https', 'HTTPS'), 'arxiv.org', 'ARXIV.org')",
    "query": "pdf_url || '?download=1'", "fragment": "pdf_url || '#page=2'",
    "empty_query": "pdf_url || '?'", "user": "replace(pdf_url, '://', '://me@')",
    "port": "replace(pdf_url, '.org', '.org:443')",
    "other_host": "replace(pdf_url, 'arxiv.org', 'arxiv.org.example.net')",
    "deeper": "pdf_url || '/extra'", "other_version": "pdf_url || '1'",
    "no_version": "replace(pdf_url, 'v', '')"}


@query("url_contract", f"""
WITH {S.DESCRIBED}, v AS ({_sql_variants('described', 'doc_id, paper_id, url', _URL_SQL)})
SELECT doc_id, variant,
  regexp_extract(value, '(?i)\\A(https?)://', 1) <> ''
  AND lower(regexp_extract(value, '\\A[A-Za-z]+://([^/?#]*)', 1)) = 'arxiv.org'
  AND regexp_extract(value, '\\A[A-Za-z]+://[^/?#]*([^?#]*)', 1) IN ('/pdf/' || paper_id, '/pdf/' || paper_id || '.pdf')
  AND regexp_extract(value, '\\?([^#]*)', 1) = '' AND regexp_extract(value, '#(.*)', 1) = '' AS is_valid,
  regexp_replace(value, 'http://', 'https://') AS secure,
  trim(split_part(regexp_extract(replace(url, 'v', '%76') || '/?x', '\\A[a-z]+://[^/]*([^?]*)', 1), '/abs/', 2), '/')
    .replace('%76', 'v') AS abs_id
FROM v""")
def url_contract(spark, sf):
    papers = corpus.described_documents(spark, sf)
    url = F.col("pdf_url")
    rows = _variants(papers, ["doc_id", "paper_id", "url"], {
        "https": url,
        "http_suffix": F.concat(F.replace(url, F.lit("https"), F.lit("http")), F.lit(".pdf")),
        "upper_host": F.replace(F.replace(url, F.lit("https"), F.lit("HTTPS")),
                                F.lit("arxiv.org"), F.lit("ARXIV.org")),
        "query": F.concat(url, F.lit("?download=1")),
        "fragment": F.concat(url, F.lit("#page=2")), "empty_query": F.concat(url, F.lit("?")),
        "user": F.replace(url, F.lit("://"), F.lit("://me@")),
        "port": F.replace(url, F.lit(".org"), F.lit(".org:443")),
        "other_host": F.replace(url, F.lit("arxiv.org"), F.lit("arxiv.org.example.net")),
        "deeper": F.concat(url, F.lit("/extra")), "other_version": F.concat(url, F.lit("1")),
        "no_version": F.replace(url, F.lit("v"), F.lit(""))})
    coded = F.concat(F.replace("url", F.lit("v"), F.lit("%76")), F.lit("/?x"))
    return rows.select(
        "doc_id", "variant",
        identity.is_pdf_url(F.col("value"), F.col("paper_id")).alias("is_valid"),
        identity.https_once(F.col("value")).alias("secure"),
        identity.abs_id(coded).alias("abs_id"))


_DATE_SQL = {
    "canonical": "published", "compact": "replace(published, '-', '')",
    "short": "replace(published, '-0', '-')", "week": "substring(published, 1, 4) || '-W34-5'",
    "leap": "substring(published, 1, 5) || '02-29'", "never": "substring(published, 1, 5) || '02-30'",
    "year_zero": "'0000' || substring(published, 5)", "moment": "published || 'T00:00:00Z'",
    "line_end": "published || chr(10)", "cut": "substring(published || 'T00:00:00Z', 1, 10)"}


@query("date_contract", f"""
WITH {S.DESCRIBED}, v AS ({_sql_variants('described', 'doc_id', _DATE_SQL)})
SELECT doc_id, variant, regexp_matches(value, '\\A\\d{{4}}-\\d\\d-\\d\\d\\z')
  AND NOT starts_with(value, '0000') AND TRY_CAST(value AS DATE) IS NOT NULL AS is_valid FROM v""")
def date_contract(spark, sf):
    papers = corpus.described_documents(spark, sf)
    day = F.col("published")
    year = F.substring(day, 1, 5)
    rows = _variants(papers, ["doc_id"], {
        "canonical": day, "compact": F.replace(day, F.lit("-"), F.lit("")),
        "short": F.replace(day, F.lit("-0"), F.lit("-")),
        "week": F.concat(F.substring(day, 1, 4), F.lit("-W34-5")),
        "leap": F.concat(year, F.lit("02-29")), "never": F.concat(year, F.lit("02-30")),
        "year_zero": F.concat(F.lit("0000"), F.substring(day, 5, 10)),
        "moment": F.concat(day, F.lit("T00:00:00Z")), "line_end": F.concat(day, F.lit("\n")),
        "cut": F.substring(F.concat(day, F.lit("T00:00:00Z")), 1, 10)})
    return rows.select("doc_id", "variant",
                       identity.is_calendar_date(F.col("value")).alias("is_valid"))


_PATH_SQL = {
    "plain": "source_path", "rooted": "'/' || source_path", "upward": "'../' || source_path",
    "inner": "replace(source_path, '/', '/../')", "dotted": "replace(source_path, '/', '/..x/')"}


@query("path_contract", f"""
WITH {S.DESCRIBED}, v AS ({_sql_variants('described', 'doc_id', _PATH_SQL)})
SELECT doc_id, variant, NOT starts_with(value, '/') AND NOT list_contains(string_split(value, '/'), '..')
  AS is_valid FROM v""")
def path_contract(spark, sf):
    papers = corpus.described_documents(spark, sf)
    path = F.col("source_path")
    rows = _variants(papers, ["doc_id"], {
        "plain": path, "rooted": F.concat(F.lit("/"), path),
        "upward": F.concat(F.lit("../"), path),
        "inner": F.replace(path, F.lit("/"), F.lit("/../")),
        "dotted": F.replace(path, F.lit("/"), F.lit("/..x/"))})
    return rows.select("doc_id", "variant",
                       identity.is_relative_path(F.col("value")).alias("is_valid"))


@query("manifest_violations", f"""
WITH {S.DESCRIBED}, broken AS (
  SELECT paper_id, source_path, lang, source, authors,
    CASE WHEN lang = 'fr' THEN replace(published, '-', '/') ELSE published END AS published,
    CASE WHEN lang = 'de' THEN pdf_url || '?x=1' ELSE pdf_url END AS pdf_url,
    CASE WHEN lang = 'es' THEN 'v9' ELSE paper_version END AS paper_version,
    CASE WHEN source = 'src7' THEN ' ' ELSE source END AS author,
    CASE WHEN source = 'src9' THEN '/' || source_path ELSE source_path END AS path
  FROM described),
twice AS (SELECT paper_id, path FROM broken UNION ALL SELECT paper_id, path FROM broken WHERE source = 'src11'),
rules AS (
  SELECT 'published' AS rule, paper_id AS key FROM broken WHERE NOT regexp_matches(published, '\\A\\d{{4}}-\\d\\d-\\d\\d\\z')
  UNION ALL SELECT 'pdf_url', paper_id FROM broken WHERE pdf_url <> 'https://arxiv.org/pdf/' || paper_id
  UNION ALL SELECT 'paper_version', paper_id FROM broken WHERE NOT ends_with(paper_id, paper_version)
  UNION ALL SELECT 'authors', paper_id FROM broken WHERE length({S.strip('author')}) = 0
  UNION ALL SELECT 'source_path', paper_id FROM broken WHERE starts_with(path, '/')
  UNION ALL SELECT 'paper_id_duplicate', paper_id FROM twice GROUP BY paper_id HAVING count(*) > 1
  UNION ALL SELECT 'source_path_shared', ltrim(path, '/') FROM twice GROUP BY ltrim(path, '/') HAVING count(*) > 1)
SELECT rule, key FROM rules""")
def manifest_violations(spark, sf):
    rows = corpus.described_documents(spark, sf)
    lang, source = F.col("lang"), F.col("source")
    broken = rows.withColumns({
        "published": F.when(lang == "fr", F.replace("published", F.lit("-"), F.lit("/")))
        .otherwise(F.col("published")),
        "pdf_url": F.when(lang == "de", F.concat("pdf_url", F.lit("?x=1")))
        .otherwise(F.col("pdf_url")),
        "paper_version": F.when(lang == "es", "v9").otherwise(F.col("paper_version")),
        "authors": F.when(source == "src7", F.array(F.lit(" "))).otherwise(F.col("authors")),
        "source_path": F.when(source == "src9", F.concat(F.lit("/"), "source_path"))
        .otherwise(F.col("source_path"))}).drop("text")
    twice = F.when(source == "src11", 2).otherwise(1)
    copies = broken.withColumn("copy", F.explode(F.sequence(F.lit(1), twice))).drop("copy")
    found = contracts.paper_violations(copies.select(*V.PAPER_FIELDS, "source"))
    # Row rules see both copies of a repeated row; each broken key is listed once.
    return found.select("rule", "key").distinct()


@query("page_violations", f"""
WITH {S.PAGES}, changed AS (
  SELECT paper_id, page_number, CASE WHEN page_number = 5 THEN upper(title) || '!' ELSE title END AS title
  FROM paper_pages WHERE page_number <> 2
  UNION ALL SELECT paper_id, page_number, title FROM paper_pages WHERE page_number = 4),
per AS (SELECT paper_id, count(*) AS n, count(DISTINCT page_number) AS d, min(page_number) AS lo,
          max(page_number) AS hi, count(*) FILTER (WHERE page_number = 5) AS odd FROM changed GROUP BY 1)
SELECT 'page_sequence' AS rule, paper_id AS key FROM per WHERE NOT (lo = 1 AND hi = n AND d = n)
UNION ALL SELECT 'page_duplicate', paper_id FROM per WHERE n <> d
UNION ALL SELECT 'page_citation', paper_id FROM per WHERE odd > 0""")
def page_violations(spark, sf):
    pages = corpus.pages(spark, sf)
    number = F.col("page_number")
    repeats = F.when(number == 2, F.array().cast("array<int>")).when(
        number == 4, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    changed = pages.withColumn("copy", F.explode(repeats)).drop("copy").withColumn(
        "title", F.when(number == 5, F.concat(F.upper("title"), F.lit("!")))
        .otherwise(F.col("title")))
    found = contracts.page_violations(changed, corpus.papers(spark, sf))
    return found.select("rule", "key")


def _staged(rows: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read again."""
    path = f"{shared_folder(rows.sparkSession)}/rows"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


_PROFILE = FIXED.profile_hash()


@query("chunk_violations", f"""
WITH {S.PAGES}, {S.fixed_chunks()},
ids AS (SELECT *, {S.chunk_id(_PROFILE)} AS chunk_id FROM spans),
changed AS (
  SELECT paper_id, page_number, chunk_id, start_character, end_character,
    CASE page_number WHEN 3 THEN translate(text, 'aeiou', 'AEIOU') WHEN 5 THEN text || 'x' ELSE text END AS text,
    page_number = 3 AND translate(text, 'aeiou', 'AEIOU') <> text OR page_number = 5 AS edited
  FROM ids WHERE NOT (page_number = 2 AND start_character = 1600)
  UNION ALL SELECT paper_id, page_number, chunk_id, start_character, end_character, text, false FROM ids WHERE page_number = 4),
swept AS (
  SELECT c.*, p.text AS page_text,
    coalesce(max(end_character) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    coalesce(lag(start_character) OVER w, -1) AS previous, lag(chunk_id) OVER w AS previous_id
  FROM changed c JOIN paper_pages p USING (paper_id, page_number)
  WINDOW w AS (PARTITION BY paper_id, page_number ORDER BY start_character, end_character, chunk_id)),
ends AS (SELECT p.paper_id, p.page_number, length(any_value(p.text)) AS n, max(c.end_character) AS reached,
    coalesce(min_by(c.chunk_id, {{'s': c.start_character, 'e': c.end_character, 'i': c.chunk_id}}), p.paper_id || '#' || p.page_number) AS key
  FROM paper_pages p LEFT JOIN changed c USING (paper_id, page_number) WHERE NOT {S.blank('p.text')} GROUP BY 1, 2),
rules AS (
  SELECT 'chunk_id' AS rule, chunk_id AS key FROM swept WHERE edited
  UNION ALL SELECT 'slice', chunk_id FROM swept WHERE substring(page_text, start_character + 1, end_character - start_character) <> text
  UNION ALL SELECT 'gap', chunk_id FROM swept WHERE start_character > before
  UNION ALL SELECT 'repeated_span', chunk_id FROM swept WHERE start_character <= previous
  UNION ALL SELECT 'chunk_id_duplicate', chunk_id FROM swept WHERE chunk_id = previous_id
  UNION ALL SELECT 'offset_length', chunk_id FROM swept WHERE length(text) <> end_character - start_character
  UNION ALL SELECT 'page_end', key FROM ends WHERE reached IS DISTINCT FROM n)
SELECT rule, key FROM rules""")
def chunk_violations(spark, sf):
    # The check reads pages three times and passages twice: both are made once and staged.
    pages = _staged(corpus.pages(spark, sf))
    chunks = chunking.chunk_pages(pages, FIXED)
    number = F.col("page_number")
    dropped = (number == 2) & (F.col("start_character") == 1600)
    times = F.when(dropped, F.array().cast("array<int>")).when(
        number == 4, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    changed = chunks.withColumn("copy", F.explode(times)).drop("copy").withColumn(
        "text", F.when(number == 3, F.translate("text", "aeiou", "AEIOU"))
        .when(number == 5, F.concat("text", F.lit("x"))).otherwise(F.col("text")))
    return contracts.chunk_violations(_staged(changed), pages).select("rule", "key")


def _spans_sql(chunks: str, profile: str) -> str:
    return f"""WITH RECURSIVE {S.PAGES}, {chunks}
SELECT {S.chunk_id(profile)} AS chunk_id, paper_id, page_number, start_character, end_character,
  text, page_text_sha256, '{profile}' AS chunking_profile_sha256 FROM spans"""


@query("fixed_chunks", _spans_sql(S.fixed_chunks(), FIXED.profile_hash()))
def fixed_chunks(spark, sf):
    return chunking.chunk_pages(corpus.pages(spark, sf), FIXED).select(*SPAN_COLUMNS)


@query("boundary_chunks", _spans_sql(S.boundary_chunks(), BOUNDARY.profile_hash()))
def boundary_chunks(spark, sf):
    return chunking.chunk_pages(corpus.pages(spark, sf), BOUNDARY).select(*SPAN_COLUMNS)


_TOKEN_PROFILE = TOKENS.profile_hash(PatternTokenizer())


@query("token_chunks", f"""WITH RECURSIVE {S.PAGES}, {S.token_chunks()}
SELECT {S.chunk_id(_TOKEN_PROFILE)} AS chunk_id, paper_id, page_number, start_character,
  end_character, text, page_text_sha256, '{_TOKEN_PROFILE}' AS chunking_profile_sha256,
  tokens AS content_token_count, tokens AS input_token_count FROM spans""")
def token_chunks(spark, sf):
    chunks = chunking.chunk_pages(corpus.pages(spark, sf), TOKENS, PatternTokenizer())
    return chunks.select(*SPAN_COLUMNS, "content_token_count", "input_token_count")


@query("subword_chunks")
def subword_chunks(spark, sf):
    """Passages of every page by a subword vocabulary; SQL has no such tokenizer.

    ``folioweave.tokenizerFile`` names the vocabulary; a public one is taken where it is unset.
    """
    import public_tokenizers
    path = spark.conf.get("folioweave.tokenizerFile", None) or public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = JsonTokenizer.from_file(path, path.rsplit("/", 1)[-1], "public")
    chunks = chunking.chunk_pages(corpus.pages(spark, sf), TOKENS, tokenizer)
    return chunks.select(*SPAN_COLUMNS, "content_token_count", "input_token_count")


@query("token_budgets", f"""
WITH RECURSIVE {S.PAGES}, {S.token_chunks()},
per AS (SELECT paper_id, page_number, max(end_character) AS reached FROM spans GROUP BY 1, 2)
SELECT (SELECT count(*) FROM spans WHERE tokens > 200) AS breaches,
  (SELECT bool_and({S.blank('text')} OR reached = length(text))
   FROM paper_pages LEFT JOIN per USING (paper_id, page_number)) AS all_pages_covered""")
def token_budgets(spark, sf):
    """Token passages against their budgets and their pages, in one sweep."""
    pages = corpus.pages(spark, sf)
    chunks = chunking.chunk_pages(pages, TOKENS, PatternTokenizer())
    swept = contracts.coverage_sweep(chunks, pages)
    used = ~F.col("page_blank")
    hole = F.col("start_character") > F.col("reached_before")
    short = used & ~F.col("reached").eqNullSafe(F.col("page_length").cast("long"))
    over = F.col("chunk_id").isNotNull() & facts.breaks_token_budget(
        TOKENS.token_budget, TOKENS.max_input_tokens)
    return swept.agg(F.count_if(over).alias("breaches"),
                     (F.count_if(hole | short) == 0).alias("all_pages_covered"))


@query("chunk_overlaps", f"""
WITH {S.PAGES}, {S.fixed_chunks()},
adjacent AS (SELECT paper_id, page_number, end_character,
    lead(start_character) OVER (PARTITION BY paper_id, page_number ORDER BY start_character) AS following FROM spans)
SELECT paper_id, page_number, count(*) AS chunks, count(following) AS adjacent_pairs,
  count(*) FILTER (WHERE following = end_character - 200) AS exact_overlaps
FROM adjacent GROUP BY 1, 2""")
def chunk_overlaps(spark, sf):
    chunks = chunking.cut_pages(corpus.pages(spark, sf).select(
        "paper_id", "page_number", "text"), FIXED)
    order = W.partitionBy("paper_id", "page_number").orderBy("start_character")
    spans = chunks.select("paper_id", "page_number", "start_character", "end_character")
    exact = F.col("following") == F.col("end_character") - FIXED.overlap
    return spans.withColumn("following", F.lead("start_character").over(order)).groupBy(
        "paper_id", "page_number").agg(
            F.count("*").alias("chunks"), F.count("following").alias("adjacent_pairs"),
            F.count_if(exact).alias("exact_overlaps"))


@query("chunk_coverage", f"""
WITH RECURSIVE {S.PAGES}, {S.boundary_chunks()},
swept AS (SELECT paper_id, page_number, start_character, end_character,
    coalesce(max(end_character) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    coalesce(lag(start_character) OVER w, -1) AS previous
  FROM spans WINDOW w AS (PARTITION BY paper_id, page_number ORDER BY start_character)),
per AS (SELECT paper_id, page_number, count(*) AS chunks, max(end_character) AS reached,
    count(*) FILTER (WHERE start_character > before) AS gaps,
    count(*) FILTER (WHERE start_character <= previous) AS repeats FROM swept GROUP BY 1, 2)
SELECT paper_id, page_number, coalesce(chunks, 0) AS chunks, coalesce(gaps, 0) AS gaps,
  coalesce(repeats, 0) AS repeats, coalesce(reached, 0) AS reached,
  coalesce(reached, 0) = length(text) OR {S.blank('text')} AS complete
FROM paper_pages LEFT JOIN per USING (paper_id, page_number)""")
def chunk_coverage(spark, sf):
    pages = corpus.pages(spark, sf)
    swept = contracts.coverage_sweep(chunking.chunk_pages(pages, BOUNDARY), pages)
    start = F.col("start_character")
    per = swept.groupBy("paper_id", "page_number").agg(
        F.count("chunk_id").alias("chunks"),
        F.count_if(start > F.col("reached_before")).alias("gaps"),
        F.count_if(start <= F.col("previous_start")).alias("repeats"),
        F.coalesce(F.max("end_character"), F.lit(0)).alias("reached"),
        F.max("page_length").cast("long").alias("length"),
        F.bool_or("page_blank").alias("blank"))
    whole = (F.col("reached") == F.col("length")) | F.col("blank")
    return per.select("paper_id", "page_number", "chunks", "gaps", "repeats", "reached",
                      whole.alias("complete"))
