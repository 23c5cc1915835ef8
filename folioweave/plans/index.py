"""Paper and passage vectors kept aligned with one published generation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from folioweave import fixed_values as V, schemas
from folioweave.functions import identity
from folioweave.functions.embedding import fingerprint
from folioweave.functions.text import is_blank
from folioweave.operators import sets, vector_search as VS
from folioweave.operators.listing import document_text, lookup, reading_order
from folioweave.plans import generation as G
from folioweave.sources.buckets import BUCKETS, BucketedTable

_SCHEMAS = {"papers": schemas.PAPER_VECTORS, "chunks": schemas.CHUNK_VECTORS}


def _unstamped(schema: T.StructType) -> T.StructType:
    return T.StructType([f for f in schema if f.name != "generation"])


class PaperIndex:
    """Vector tables under ``root`` for the active generation.

    Each collection is a table in hash buckets of the paper: a change embeds new texts only and
    writes only the buckets of papers that changed. The generation that rows belong to is noted once, in
    the collection's pointer, so a new generation leaves unchanged papers' buckets as they are.
    """

    def __init__(self, spark: SparkSession, root: str, run_root: str, pointer: str,
                 manifest: DataFrame, embedder, model: str = V.EMBEDDING_MODEL, buckets: int = BUCKETS):
        self.spark, self.root, self.run_root, self.pointer = spark, root, run_root, pointer
        self.manifest, self.embedder, self.model = manifest, embedder, model
        self.tables = {name: BucketedTable(spark, f"{root}/{name}", _unstamped(schema), "paper_id", buckets)
                       for name, schema in _SCHEMAS.items()}
        self._sound: set[tuple] = set()
        self.source()
        self.fingerprint, self.dimensions = fingerprint(embedder, model)

    # ---- source guard ----
    def source(self) -> G.Generation:
        """The active generation, checked against the search manifest."""
        generation = G.load_active(self.spark, self.run_root, self.pointer)
        if ("source", generation.name) in self._sound:
            return generation
        names = list(schemas.PAPERS.names)
        odd = sets.row_differences(self.manifest.select(*names), generation.papers.select(*names))
        if odd.head() is not None:
            raise ValueError("the paper manifest differs from the active generation")
        wanted = self.manifest.join(generation.included(), "paper_id", "left_semi")
        lacking = wanted.where(is_blank(F.col("abstract")) | is_blank(F.col("url")))
        if lacking.head() is not None:
            raise ValueError("an indexed paper lacks its abstract or URL")
        self._sound.add(("source", generation.name))
        return generation

    # ---- stored versions ----
    def stored(self, name: str, paper_ids: list[str] | None = None) -> DataFrame:
        """The current collection, empty before the first indexing; of given papers' buckets alone."""
        table = self.tables[name]
        only = None if paper_ids is None else table.buckets_of(
            self.spark.createDataFrame([(p,) for p in paper_ids], "paper_id string"))
        rows = table.read(only).withColumn("generation", F.lit(table.note().get("generation")).cast("string"))
        return rows.select(*_SCHEMAS[name].names)

    def count(self, name: str) -> int:
        return self.stored(name).count()

    # ---- desired records ----
    def _stamped(self, rows: DataFrame) -> DataFrame:
        return rows.withColumns({"embedding_model": F.lit(self.model),
                                 "embedding_fingerprint": F.lit(self.fingerprint)})

    def _desired_papers(self, generation: G.Generation) -> DataFrame:
        rows = self.manifest.join(generation.included(), "paper_id", "left_semi")
        return self._stamped(rows.select(
            F.col("paper_id").alias("id"),
            document_text(F.col("title"), F.col("abstract")).alias("document"), "paper_id",
            "title", "url", "published"))

    def _desired_chunks(self, generation: G.Generation) -> DataFrame:
        return self._stamped(generation.chunks.select(
            F.col("chunk_id").alias("id"), F.col("text").alias("document"), "paper_id",
            "page_number", "start_character", "end_character", "page_text_sha256",
            "chunking_profile_sha256", "title", "pdf_url"))

    # ---- reconciliation ----
    def _synchronize(self, name: str, desired: DataFrame, generation: str) -> int:
        """Bring a collection to the desired rows; returns how many records are new or changed.

        A record's generation is part of it: under a new generation every record has changed, although
        only the buckets of other changes are written.
        """
        table = self.tables[name]
        columns = [n for n in table.schema.names if n not in ("id", "embedding")]
        dealt = desired.withColumn("bucket", table.bucket())
        counts = sets.reconcile(dealt, table.read().drop("embedding").withColumn("bucket", table.bucket()),
                                ["bucket", "id"], columns).groupBy("bucket", "action").count().collect()
        touched = sorted({r["bucket"] for r in counts if r["action"] != "unchanged"})
        moved = table.note().get("generation") != generation
        if not touched and not moved:
            return 0
        # A vector is reusable when the same embedder made it from the same document.
        held = table.read(touched).where((F.col("embedding_fingerprint") == self.fingerprint)
                                         & (F.size("embedding") == self.dimensions)).select(
            "id", identity.sha256(F.col("document")).alias("document_sha256"), "embedding")
        keyed = dealt.where(F.col("bucket").isin(touched)).withColumn(
            "document_sha256", identity.sha256(F.col("document")))
        paired = keyed.join(held, ["id", "document_sha256"], "left")
        reused = paired.where(F.col("embedding").isNotNull())
        fresh = paired.where(F.col("embedding").isNull()).withColumn(
            "embedding", self.embedder.vector(F.col("document")).cast(schemas.VECTOR))
        table.replace(reused.unionByName(fresh), touched, {"generation": generation}, "id")
        kinds = ("new", "changed", "unchanged") if moved else ("new", "changed")
        return sum(r["count"] for r in counts if r["action"] in kinds)

    def index_papers(self) -> int:
        generation = self.source()
        return self._synchronize("papers", self._desired_papers(generation), generation.name)

    def index_chunks(self) -> int:
        generation = self.source()
        return self._synchronize("chunks", self._desired_chunks(generation), generation.name)

    # ---- search ----
    def _require_synchronized(self, name: str, expected: DataFrame, generation: str) -> DataFrame:
        """Stored rows of the generation; refuses ids or an embedder that do not agree."""
        rows = self.stored(name).where(F.col("generation") == generation)
        mark = (name, generation, self.tables[name].files.sha256(self.tables[name].pointer), self.fingerprint)
        if mark not in self._sound:
            sides = sets.id_coverage(expected, rows.select("id"), "id").where("side <> 'shared'")
            other = rows.where(F.col("embedding_fingerprint") != self.fingerprint)
            if sides.head() is not None or other.head() is not None:
                raise RuntimeError(f"the {name} index is not synchronized with the active generation")
            self._sound.add(mark)
        return rows

    def _parts(self) -> tuple[DataFrame, DataFrame]:
        generation = self.source()
        papers = self._require_synchronized(
            "papers", generation.included().withColumnRenamed("paper_id", "id"), generation.name)
        chunks = self._require_synchronized(
            "chunks", generation.chunks.select(F.col("chunk_id").alias("id")), generation.name)
        return papers, chunks

    def _question(self, text: str) -> list[float]:
        if not text:
            raise ValueError("a question must not be empty")
        return self.embedder.embed([text])[0]

    def search(self, question: str, k: int = 5) -> DataFrame:
        papers, _ = self._parts()
        hits = VS.nearest(papers, self._question(question), VS.check_count("k", k))
        return VS.with_payload(hits, papers.select("id", "title", "url"), "id", k).select(
            "id", "title", "url", F.round("similarity", 3).alias("score")).orderBy(
                F.desc("score"), "id")

    def _passages(self, hits: DataFrame, chunks: DataFrame, k: int, digits: int = 3) -> DataFrame:
        joined = VS.with_payload(VS.ranked(hits), chunks, "id", k)
        return joined.select(
            "rank", F.col("id").alias("chunk_id"), "paper_id", "title", "page_number",
            "start_character", "end_character", "pdf_url", "page_text_sha256",
            F.col("document").alias("text"), F.round("similarity", digits).alias("score"),
            VS.rounded_vector(F.col("embedding")).alias("embedding")).orderBy("rank")

    def search_chunks(self, question: str, paper_ids: list[str], k: int = 5) -> DataFrame:
        self._parts()
        wanted = sorted(set(paper_ids))
        inside = self.stored("chunks", wanted).where(F.col("paper_id").isin(wanted))
        hits = VS.nearest(inside, self._question(question), VS.check_count("k", k))
        return self._passages(hits, inside, k)

    def search_two_stage(self, question: str, n_papers: int = 10, k: int = 5) -> DataFrame:
        papers, _ = self._parts()
        vector = self._question(question)
        VS.check_count("k", k)
        # the papers found are few and checked in number; only their buckets are read on
        near = VS.nearest(papers, vector, VS.check_count("n_papers", n_papers))
        chunks = self.stored("chunks", [r["id"] for r in near.select("id").collect()])
        hits = VS.two_stage(papers, chunks, vector, n_papers, k)
        return self._passages(hits, chunks, k)

    def search_passages(self, question: str, k: int = V.AGENT_TOP_K) -> dict:
        """Single-stage search in the form the agent and the interface use."""
        _, chunks = self._parts()
        vector = self._question(question)
        rows = self._passages(VS.nearest(chunks, vector, VS.check_count("k", k)), chunks, k, 4)
        return {"query": question, "embedding_model": self.model, "dimensions": len(vector),
                "query_embedding": [round(float(x), 5) for x in vector],
                "passages": [row.asDict() for row in rows.collect()]}

    def paper_embeddings(self, paper_id: str) -> tuple[DataFrame, DataFrame]:
        """A paper's own vector row and its passages in reading order."""
        paper = lookup(self.stored("papers"), "id", paper_id).withColumn(
            "embedding", VS.rounded_vector(F.col("embedding")))
        return paper, reading_order(self.stored("chunks", [paper_id]), paper_id)
