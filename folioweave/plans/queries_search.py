"""Queries on vectors, listings and prompts."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioweave.functions import identity
from folioweave.functions.embedding import LengthEmbedder
from folioweave.operators import chunking, listing, vector_search as VS
from folioweave.plans import corpus, sql_parts as S
from folioweave.plans.queries_text import FIXED
from folioweave.plans.registry import query


def _passages(spark, sf):
    return corpus.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("label").cast("long").alias("paper_id"), "embedding")


def _paper_vectors(spark, sf):
    """The first vector of every paper; a partial aggregate, no window."""
    return _passages(spark, sf).groupBy("paper_id").agg(
        F.min_by("embedding", "id").alias("embedding"))


def _question(spark, sf) -> list[float]:
    """The question vector: the newest stored one (a single row)."""
    row = _passages(spark, sf).agg(F.max_by("embedding", "id")).head()
    return [float(x) for x in row[0]]


_VECTORS = f"""passages AS (SELECT vec_id AS id, label::BIGINT AS paper_id, embedding::DOUBLE[] AS v FROM embeddings),
papers AS (SELECT paper_id, arg_min(v, id) AS v FROM passages GROUP BY 1),
question AS (SELECT arg_max(v, id) AS q FROM passages)"""


def _sql_top(source: str, key: str, k: int, where: str = "true", name: str = "hits") -> str:
    return (f"{name} AS (SELECT {key}, list_cosine_similarity(v, (SELECT q FROM question)) AS similarity "
            f"FROM {source} WHERE {where} ORDER BY similarity DESC, {key} LIMIT {k})")


@query("paper_search", f"""WITH {_VECTORS}, {_sql_top('papers', 'paper_id', 5)}
SELECT paper_id, round(similarity, 3) AS score FROM hits""")
def paper_search(spark, sf):
    hits = VS.nearest(_paper_vectors(spark, sf), _question(spark, sf), 5, "paper_id")
    return hits.select("paper_id", F.round("similarity", 3).alias("score"))


@query("passage_search", f"""WITH {_VECTORS}, {_sql_top('passages', 'id', 5, 'paper_id IN (1, 3, 5)')}
SELECT id, paper_id, round(similarity, 3) AS score FROM hits JOIN passages USING (id)""")
def passage_search(spark, sf):
    """Passages inside given candidate papers; the filter runs before scoring."""
    passages = _passages(spark, sf)
    hits = VS.nearest(passages.where(F.col("paper_id").isin(1, 3, 5)), _question(spark, sf), 5)
    joined = VS.with_payload(hits, passages.select("id", "paper_id"), "id", 5)
    return joined.select("id", "paper_id", F.round("similarity", 3).alias("score"))


@query("two_stage_search", f"""WITH {_VECTORS}, {_sql_top('papers', 'paper_id', 3, name='best')},
{_sql_top('passages', 'id', 5, 'paper_id IN (SELECT paper_id FROM best)')}
SELECT id, paper_id, round(similarity, 3) AS score FROM hits JOIN passages USING (id)""")
def two_stage_search(spark, sf):
    passages = _passages(spark, sf)
    hits = VS.two_stage(_paper_vectors(spark, sf), passages, _question(spark, sf), 3, 5)
    joined = VS.with_payload(hits, passages.select("id", "paper_id"), "id", 5)
    return joined.select("id", "paper_id", F.round("similarity", 3).alias("score"))


@query("ranked_passages", f"""WITH {_VECTORS}, {_sql_top('passages', 'id', 6)},
r AS (SELECT *, row_number() OVER (ORDER BY similarity DESC, id) AS rank FROM hits)
SELECT rank, id, paper_id, round(similarity, 4) AS score, len(v)::INTEGER AS dimensions FROM r JOIN passages USING (id)""")
def ranked_passages(spark, sf):
    passages = _passages(spark, sf)
    hits = VS.ranked(VS.nearest(passages, _question(spark, sf), 6))
    joined = VS.with_payload(hits, passages, "id", 6)
    return joined.select("rank", "id", "paper_id", F.round("similarity", 4).alias("score"),
                         F.size("embedding").alias("dimensions"))


@query("display_vectors", f"""WITH {_VECTORS}, {_sql_top('passages', 'id', 6)}
SELECT id, unnest(range(1, len(v) + 1)) AS position, round(unnest(v), 5) AS value FROM hits JOIN passages USING (id)""")
def display_vectors(spark, sf):
    """Vectors of the hits as the interface shows them: rounded to five digits."""
    passages = _passages(spark, sf)
    hits = VS.nearest(passages, _question(spark, sf), 6)
    joined = VS.with_payload(hits, passages, "id", 6)
    return joined.select("id", F.posexplode(VS.rounded_vector(F.col("embedding"))).alias(
        "position", "value")).select("id", (F.col("position") + 1).cast("long").alias("position"),
                                     "value")


@query("batch_top_passages", f"""WITH {_VECTORS},
s AS (SELECT q.paper_id AS question_id, p.id, list_cosine_similarity(p.v, q.v) AS similarity FROM papers q, passages p),
r AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY similarity DESC, id) AS rank FROM s)
SELECT question_id, id, rank, round(similarity, 4) AS score FROM r WHERE rank <= 5""")
def batch_top_passages(spark, sf):
    """Top five passages for every paper vector as a question."""
    questions = _paper_vectors(spark, sf).withColumnRenamed("paper_id", "question_id")
    hits = VS.nearest_each(_passages(spark, sf), questions, 5)
    return hits.select("question_id", "id", "rank", F.round("similarity", 4).alias("score"))


@query("paper_cosine", f"""WITH {_VECTORS}
SELECT id, paper_id, round(list_cosine_similarity(p.v, a.v), 4) AS score FROM passages p JOIN papers a USING (paper_id)""")
def paper_cosine(spark, sf):
    """Similarity of every passage to its own paper's vector (native expression).

    The paper side is one row per paper; Catalyst broadcasts it only if it is small.
    """
    papers = _paper_vectors(spark, sf).withColumnRenamed("embedding", "paper_vector")
    joined = _passages(spark, sf).join(papers, "paper_id")
    score = VS.cosine(F.col("embedding"), F.col("paper_vector"))
    return joined.select("id", "paper_id", F.round(score, 4).alias("score"))


# ---- passages of the corpus, embedded by the deterministic embedder ---------------

_EMBED = ("[length({t})::DOUBLE, (length({t}) - length(replace({t}, 'a', '')) + 1)::DOUBLE, 1.0::DOUBLE]")
_INDEX = f"""{S.PAGES}, {S.fixed_chunks()},
chunk_vectors AS (SELECT {S.chunk_id(FIXED.profile_hash())} AS id, paper_id, page_number, start_character, end_character,
   text, title, {_EMBED.format(t='text')} AS v FROM spans),
full_papers AS (SELECT paper_id, title, published, title || '. ' || {S.abstract('text')} AS document FROM described),
paper_vectors AS (SELECT *, {_EMBED.format(t='document')} AS v FROM full_papers),
question AS (SELECT {_EMBED.format(t="'how is the cost of agents reduced'")} AS q)"""
QUESTION = "how is the cost of agents reduced"


def _chunk_vectors(spark, sf):
    chunks = chunking.chunk_pages(corpus.pages(spark, sf), FIXED)
    return chunks.select(F.col("chunk_id").alias("id"), "paper_id", "page_number",
                         "start_character", "end_character", F.col("text").alias("document"),
                         "title", LengthEmbedder().vector(F.col("text")).alias("embedding"))


def _paper_documents(spark, sf):
    rows = corpus.papers(spark, sf)
    document = listing.document_text(F.col("title"), F.col("abstract"))
    return rows.select("paper_id", "title", "published", "url", document.alias("document"))


@query("embedded_chunks", f"WITH {_INDEX} SELECT id, v[1] AS characters, v[2] AS letters, v[3] AS bias FROM chunk_vectors")
def embedded_chunks(spark, sf):
    vectors = _chunk_vectors(spark, sf)
    value = [F.get("embedding", F.lit(i)).cast("double") for i in range(3)]
    return vectors.select("id", value[0].alias("characters"), value[1].alias("letters"),
                          value[2].alias("bias"))


@query("question_search", f"""WITH {_INDEX}, {_sql_top('paper_vectors', 'paper_id', 10, name='best')},
{_sql_top('chunk_vectors', 'id', 5, 'paper_id IN (SELECT paper_id FROM best)')}
SELECT id, paper_id, page_number, start_character, end_character, text, round(similarity, 3) AS score
FROM hits JOIN chunk_vectors USING (id)""")
def question_search(spark, sf):
    """A text question through both stages over the corpus."""
    question = LengthEmbedder().embed([QUESTION])[0]
    papers = _paper_documents(spark, sf).withColumn(
        "embedding", LengthEmbedder().vector(F.col("document")))
    chunks = _chunk_vectors(spark, sf)
    hits = VS.two_stage(papers, chunks, question, 10, 5)
    joined = VS.with_payload(hits, chunks, "id", 5)
    return joined.select("id", "paper_id", "page_number", "start_character", "end_character",
                         F.col("document").alias("text"), F.round("similarity", 3).alias("score"))


@query("prompt_context", f"""WITH {_INDEX}, {_sql_top('chunk_vectors', 'id', 5)},
r AS (SELECT *, row_number() OVER (ORDER BY similarity DESC, id) AS rank FROM hits JOIN chunk_vectors USING (id))
SELECT string_agg('[' || paper_id || ' p.' || page_number || ']' || chr(10) || text, chr(10) || chr(10) ORDER BY rank) AS context,
  count(*) AS passages FROM r""")
def prompt_context(spark, sf):
    chunks = _chunk_vectors(spark, sf)
    hits = VS.ranked(VS.nearest(chunks, LengthEmbedder().embed([QUESTION])[0], 5))
    joined = VS.with_payload(hits, chunks, "id", 5)
    return listing.joined_blocks(joined, listing.citation_block(
        F.col("paper_id"), F.col("page_number"), F.col("document")))


@query("tool_passages", f"""WITH {_INDEX}, {_sql_top('chunk_vectors', 'id', 6)},
r AS (SELECT *, row_number() OVER (ORDER BY similarity DESC, id) AS rank FROM hits JOIN chunk_vectors USING (id))
SELECT string_agg(printf('[%d] similarity %.3f | "%s" (arXiv %s), page %d', rank, round(similarity, 4), title, paper_id, page_number)
  || chr(10) || {S.squeeze('text')}, chr(10) || chr(10) ORDER BY rank) AS context, count(*) AS passages FROM r""")
def tool_passages(spark, sf):
    chunks = _chunk_vectors(spark, sf)
    hits = VS.ranked(VS.nearest(chunks, LengthEmbedder().embed([QUESTION])[0], 6))
    joined = VS.with_payload(hits, chunks, "id", 6)
    return listing.joined_blocks(joined, listing.tool_block(
        F.col("rank"), F.round("similarity", 4), F.col("title"), F.col("paper_id"),
        F.col("page_number"), F.col("document")))


# ---- listings and lookups -------------------------------------------------------

_DOCS = f"{S.DESCRIBED}, full_papers AS (SELECT paper_id, title, published, url, title || '. ' || {S.abstract('text')} AS document FROM described)"


@query("papers_page", f"""WITH {_DOCS} SELECT paper_id, title, published, url, document FROM full_papers
ORDER BY published DESC, paper_id DESC LIMIT 50 OFFSET 25""")
def papers_page(spark, sf):
    return listing.newest_first(_paper_documents(spark, sf), "published", "paper_id", 50, 25)


@query("recent_papers", f"""WITH {_DOCS} SELECT paper_id, published FROM full_papers
ORDER BY published DESC, paper_id DESC LIMIT 10""")
def recent_papers(spark, sf):
    papers = _paper_documents(spark, sf).select("paper_id", "published")
    return listing.most_recent(papers, "published", "paper_id", 10)


@query("paper_lookup", f"WITH {_DOCS} SELECT paper_id, title, published, url, document FROM full_papers WHERE paper_id = '0000.00007v1'")
def paper_lookup(spark, sf):
    return listing.lookup(_paper_documents(spark, sf), "paper_id", "0000.00007v1")


@query("shown_abstracts", f"""WITH {_DOCS} SELECT paper_id, CASE WHEN starts_with(document, title || '. ')
  THEN substring(document, length(title) + 3) ELSE document END AS abstract FROM full_papers""")
def shown_abstracts(spark, sf):
    papers = _paper_documents(spark, sf)
    return papers.select("paper_id", listing.abstract_of(
        F.col("document"), F.col("title")).alias("abstract"))


@query("reading_order", f"""WITH {_INDEX} SELECT id, text, page_number, start_character, end_character,
  round(v[1], 5) AS first_value FROM chunk_vectors WHERE paper_id = '0000.00000v1'""")
def reading_order(spark, sf):
    rows = listing.reading_order(_chunk_vectors(spark, sf), "0000.00000v1")
    return rows.select("id", "text", "page_number", "start_character", "end_character",
                       F.get("embedding", F.lit(0)).alias("first_value"))


@query("passages_of_papers", f"""WITH {S.PAGES}, {S.fixed_chunks()} SELECT {S.chunk_id(FIXED.profile_hash())} AS chunk_id, paper_id, page_number
FROM spans WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)""")
def passages_of_papers(spark, sf):
    """Passages restricted to a given set of papers (a semi join)."""
    wanted = corpus.table(spark, sf, "labels").where("quality = 1").select(
        corpus.paper_id(F.col("doc_id")).alias("paper_id"))
    chunks = chunking.chunk_pages(corpus.pages(spark, sf), FIXED)
    return chunks.select("chunk_id", "paper_id", "page_number").join(wanted, "paper_id", "left_semi")


@query("collection_counts", f"""WITH {S.PAGES}, {S.fixed_chunks()} SELECT 'papers' AS collection, count(*) AS records FROM described
UNION ALL SELECT 'chunks', count(*) FROM spans""")
def collection_counts(spark, sf):
    papers = corpus.documents(spark, sf).agg(F.count("*").alias("records"))
    spans = chunking.cut_pages(corpus.pages(spark, sf).select("text"), FIXED).agg(
        F.count("*").alias("records"))
    return papers.select(F.lit("papers").alias("collection"), "records").unionByName(
        spans.select(F.lit("chunks").alias("collection"), "records"))


@query("embedder_guard", f"""SELECT label::BIGINT AS paper_id, count(*) AS vectors, count(*) FILTER (WHERE len(embedding) <> 64) AS wrong_dimension,
  min(len(embedding))::INTEGER AS dimensions FROM embeddings GROUP BY 1""")
def embedder_guard(spark, sf):
    """Stored dimensions per paper against the embedder's 64."""
    size = F.size("embedding")
    return _passages(spark, sf).groupBy("paper_id").agg(
        F.count("*").alias("vectors"), F.count_if(size != 64).alias("wrong_dimension"),
        F.min(size).alias("dimensions"))
