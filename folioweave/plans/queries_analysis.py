"""Queries on corpus statistics and retrieval quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioweave import fixed_values as V
from folioweave.functions.embedding import LetterEmbedder
from folioweave.operators import analysis, chunking, contracts, evaluation, vector_search as VS
from folioweave.plans import corpus, sql_parts as S
from folioweave.plans.registry import query

# Headings and topic words that the invented prose lacks, by language of the paper.
_TOPICS = {"en": (" and ", " agent cost "), "fr": (" la ", " patient "), "de": (" der ", " demand ")}


def _report_text():
    text = F.col("text")
    for lang, (old, new) in _TOPICS.items():
        text = F.when(F.col("lang") == lang, F.replace(text, F.lit(old), F.lit(new))).otherwise(text)
    headed = F.concat(F.lit("Title page\nAbstract—"), F.replace(
        text, F.lit("\n"), F.lit("\n1. Introduction\n")))
    return F.when(F.col("lang").isin("en", "de"), headed).otherwise(text)


def _reports(spark, sf):
    rows = corpus.described_documents(spark, sf)
    # The author field is blank in Spanish files.
    author = F.when(F.col("lang") == "es", "").otherwise(F.col("source"))
    name = F.concat("source", F.lit("_"), F.replace("paper_id", F.lit("."), F.lit("-")), F.lit(".pdf"))
    meta = F.when(F.col("lang") != "de", F.col("title"))
    text = _report_text()
    pages = (F.size(F.split("text", "\n")) + corpus.LINES_PER_PAGE - 1) / corpus.LINES_PER_PAGE
    return rows.select(name.alias("file_name"), meta.alias("metadata_title"),
                       author.alias("author"), F.floor(pages).cast("long").alias("pages"),
                       text.alias("text"))


def _sql_report():
    text = "text"
    for lang, (old, new) in _TOPICS.items():
        text = f"CASE WHEN lang = '{lang}' THEN replace({text}, '{old}', '{new}') ELSE {text} END"
    return (f"CASE WHEN lang IN ('en', 'de') THEN 'Title page' || chr(10) || 'Abstract—' || "
            f"replace({text}, chr(10), chr(10) || '1. Introduction' || chr(10)) ELSE {text} END")


_HINTS = " OR ".join(f"contains(lower(m), '{h}')" for h in V.BAD_TITLE_HINTS)
_STOP = "(" + ", ".join(f"'{w}'" for w in V.STOPWORDS) + ")"
_SCORES = ", ".join(
    "(" + " + ".join(f"regexp_matches(combined, '(^|[^\\pL\\pN_]){k}($|[^\\pL\\pN_])')::INTEGER"
                     for k in words) + f") AS s{i}" for i, (_, words) in enumerate(V.THEMES))
_BEST = "CASE WHEN greatest(s0, s1, s2, s3) = 0 THEN '" + V.DEFAULT_THEME + "' " + " ".join(
    f"WHEN s{i} = greatest(s0, s1, s2, s3) THEN '{name}'" for i, (name, _) in enumerate(V.THEMES)) + " END"
_SUMMARY = f"""{S.DESCRIBED},
reports AS (SELECT source || '_' || replace(paper_id, '.', '-') || '.pdf' AS file_name, source, paper_id,
  {S.squeeze("CASE WHEN lang <> 'de' THEN title END")} AS m, CASE WHEN lang = 'es' THEN '' ELSE source END AS author,
  (len(string_split(text, chr(10))) + {corpus.LINES_PER_PAGE - 1}) // {corpus.LINES_PER_PAGE} AS pages, {_sql_report()} AS body FROM described),
named AS (SELECT *, CASE WHEN m IS NOT NULL AND length(m) BETWEEN 5 AND 200 AND NOT ({_HINTS}) THEN m
    ELSE {S.strip("regexp_replace(regexp_replace(replace(paper_id, '.', '-'), 'v\\d+\\z', ''), '[-_]+', ' ', 'g')")} END AS title,
  {S.abstract('body')} AS abstract FROM reports),
tokens AS (SELECT file_name, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM
  (SELECT file_name, regexp_extract_all(lower(title || ' ' || abstract), '[A-Za-z][A-Za-z''-]+') AS words FROM named)),
counted AS (SELECT file_name, word, count(*) AS n, min(place) AS place FROM tokens WHERE length(word) > 3 AND word NOT IN {_STOP} GROUP BY 1, 2),
keyed AS (SELECT file_name, string_agg(word, ', ' ORDER BY n DESC, place) AS top_keywords FROM
  (SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY n DESC, place) AS r FROM counted) WHERE r <= 8 GROUP BY 1),
scored AS (SELECT file_name, {_SCORES} FROM (SELECT file_name, lower(title || ' ' || abstract) AS combined FROM named)),
summary AS (SELECT file_name, title, coalesce(nullif(author, ''), 'Unknown') AS authors, pages,
  len(regexp_extract_all(body, '-*[\\pL\\pN_][\\pL\\pN_\\-]*')) AS word_count, substring(abstract, 1, 300) AS abstract_preview,
  coalesce(top_keywords, '') AS top_keywords, {_BEST} AS theme, NOT {S.blank('body')} AS text_extracted
  FROM named JOIN scored USING (file_name) LEFT JOIN keyed USING (file_name))"""


@query("corpus_summary", f"WITH {_SUMMARY} SELECT * FROM summary ORDER BY word_count DESC, file_name")
def corpus_summary(spark, sf):
    return analysis.longest_first(analysis.summarize(_reports(spark, sf)))


@query("theme_distribution", f"WITH {_SUMMARY} SELECT theme, count(*) AS papers FROM summary GROUP BY 1 ORDER BY 2 DESC, 1")
def theme_distribution(spark, sf):
    return analysis.theme_distribution(analysis.summarize(_reports(spark, sf)))


@query("corpus_averages", f"""WITH {_SUMMARY} SELECT count(*) AS papers, avg(pages) AS mean_pages, avg(word_count) AS mean_words,
  count(*) FILTER (WHERE NOT text_extracted) AS without_text FROM summary""")
def corpus_averages(spark, sf):
    return analysis.averages(analysis.summarize(_reports(spark, sf)))


@query("word_chart", f"""WITH {_SUMMARY} SELECT CASE WHEN length(title) <= 40 THEN title
  ELSE regexp_replace(substring(title, 1, 39), '{S.WS}+\\z', '') || '…' END AS label, word_count FROM summary""")
def word_chart(spark, sf):
    return analysis.chart_rows(analysis.summarize(_reports(spark, sf)))


# ---- retrieval quality -----------------------------------------------------------

SMALL = chunking.ChunkSettings(profile="fixed_characters", size=600, overlap=150)


def _texts(spark, sf):
    return corpus.documents(spark, sf).select("doc_id", "text")


def _phrases(spark, sf):
    return corpus.table(spark, sf, "benchmark").select(
        F.col("item_id").alias("phrase_id"), F.col("text").alias("phrase"))


def _evidence(spark, sf):
    """Every paper that holds a benchmark text, as labelled evidence of that question."""
    pairs = evaluation.find_phrases(_texts(spark, sf), _phrases(spark, sf), "doc_id")
    return pairs.join(_phrases(spark, sf), "phrase_id").select(
        F.col("phrase_id").alias("question_id"), F.col("doc_id").alias("paper_id"),
        F.lit(1).cast("long").alias("page"), F.col("phrase").alias("text"))


def _passages(spark, sf):
    pages = _texts(spark, sf).select(F.col("doc_id").alias("paper_id"), "text")
    spans = chunking.cut_pages(pages, SMALL)
    return spans.select(F.format_string("%012d:%08d", "paper_id", "start_character").alias("id"),
                        "paper_id", F.lit(1).cast("long").alias("page_number"), "text",
                        LetterEmbedder().vector(F.col("text")).alias("embedding"))


def _hits(spark, sf, k: int = 5):
    passages = _passages(spark, sf)
    questions = corpus.table(spark, sf, "benchmark").select(
        F.col("item_id").alias("question_id"), LetterEmbedder().vector(F.col("text")).alias("embedding"))
    best = VS.nearest_each(passages, questions, k)
    return passages.drop("embedding").join(best, "id")


_LETTERS = ("list_transform(range(97, 123), lambda c: (length(lower({t})) - length(replace(lower({t}), chr(c::INTEGER), '')))::DOUBLE)")
_EVIDENCE = "evidence AS (SELECT item_id AS question_id, doc_id AS paper_id, b.text AS item FROM benchmark b, documents d WHERE contains(d.text, b.text))"
_HITS = f"""{_EVIDENCE}, {S.fixed_chunks(600, 150, '(SELECT doc_id AS paper_id, text FROM documents)')},
passages AS (SELECT printf('%012d:%08d', paper_id, start_character) AS id, paper_id, text, {_LETTERS.format(t='text')} AS v FROM spans),
questions AS (SELECT item_id AS question_id, {_LETTERS.format(t='text')} AS q FROM benchmark),
scored AS (SELECT question_id, id, paper_id, text, list_cosine_similarity(v, q) AS similarity FROM passages, questions WHERE list_sum(v) > 0),
hits AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY round(similarity, 12) DESC, id) AS rank FROM scored) WHERE rank <= 5),
found AS (SELECT question_id, paper_id, item, min(rank) AS rank FROM hits JOIN evidence USING (question_id, paper_id) WHERE contains(text, item) GROUP BY 1, 2, 3),
totals AS (SELECT question_id, count(*) AS items FROM evidence GROUP BY 1),
got AS (SELECT question_id, count(*) AS found_items, min(rank) AS first_rank FROM found GROUP BY 1),
per AS (SELECT question_id, coalesce(items, 0) AS evidence_items, coalesce(found_items, 0) AS found_items,
  CASE WHEN items > 0 THEN coalesce(found_items, 0) / items END AS recall,
  CASE WHEN items > 0 THEN coalesce(1.0::DOUBLE / first_rank, 0.0) END AS reciprocal_rank
  FROM questions LEFT JOIN totals USING (question_id) LEFT JOIN got USING (question_id))"""


@query("evidence_hits", f"WITH {_EVIDENCE} SELECT question_id, paper_id FROM evidence")
def evidence_hits(spark, sf):
    return _evidence(spark, sf).select("question_id", "paper_id")


@query("recall_at_5", f"WITH {_HITS} SELECT question_id, evidence_items, found_items, recall, reciprocal_rank FROM per")
def recall_at_5(spark, sf):
    questions = corpus.table(spark, sf, "benchmark").select(F.col("item_id").alias("question_id"))
    return evaluation.per_question(questions, _hits(spark, sf), _evidence(spark, sf))


@query("retrieval_quality", f"""WITH {_HITS} SELECT count(recall) AS labelled_questions, count(*) FILTER (WHERE recall IS NULL) AS unlabelled_questions,
  round(avg(recall), 9) AS mean_recall, round(avg(reciprocal_rank), 9) AS mean_reciprocal_rank FROM per""")
def retrieval_quality(spark, sf):
    summary = evaluation.summary(recall_at_5(spark, sf))
    return summary.select("labelled_questions", "unlabelled_questions",
                          F.round("mean_recall", 9).alias("mean_recall"),
                          F.round("mean_reciprocal_rank", 9).alias("mean_reciprocal_rank"))


@query("citation_correctness", f"""WITH RECURSIVE {S.PAGES}, {S.boundary_chunks()}
SELECT count(*) AS chunks, count(*) FILTER (WHERE s.text = substring(p.text, start_character + 1, end_character - start_character)) AS reconstructed,
  count(*) FILTER (WHERE s.text = substring(p.text, start_character + 1, end_character - start_character)) / count(*)::DOUBLE AS share FROM spans s JOIN paper_pages p USING (paper_id, page_number)""")
def citation_correctness(spark, sf):
    """Share of passages that their cited page reproduces exactly."""
    pages = corpus.pages(spark, sf)
    checked = contracts.checked_slices(
        chunking.chunk_pages(pages, chunking.ChunkSettings()), pages)
    counted = checked.agg(F.count("*").alias("chunks"),
                          F.count_if("right").alias("reconstructed"))
    return counted.select("*", F.try_divide("reconstructed", "chunks").alias("share"))


@query("latency_percentiles", """SELECT event_type AS state, count(*) AS trials, round(quantile_cont(value, 0.5), 6) AS p50,
  round(quantile_cont(value, 0.95), 6) AS p95 FROM events GROUP BY 1""")
def latency_percentiles(spark, sf):
    timings = corpus.table(spark, sf, "events").select(
        F.col("event_type").alias("state"), F.col("value").alias("seconds"))
    return evaluation.latency(timings).select(
        "state", "trials", F.round("p50", 6).alias("p50"), F.round("p95", 6).alias("p95"))
