from pyspark.sql import functions as F
import pytest

from folioweave import schemas
from folioweave.operators import contracts, facts
from folioweave.operators.chunking import ChunkSettings, chunk_pages
from tests import fixtures
from tests.fixtures import PAPER, SECOND


def rules(frame):
    return sorted({r["rule"] for r in frame.collect()})


@pytest.mark.parametrize("change, rule", [
    ({"paper_id": "2608.20316V1"}, "paper_id"), ({"paper_version": "v2"}, "paper_version"),
    ({"title": " \u00a0"}, "title"), ({"authors": []}, "authors"), ({"authors": ["a", " "]}, "authors"),
    ({"published": "2026-02-30"}, "published"), ({"pdf_url": "https://arxiv.org/pdf/1"}, "pdf_url"),
    ({"source_path": "../x.pdf"}, "source_path"), ({"source_path": "/x.pdf"}, "source_path"),
    ({"title": None}, "title")])
def test_paper_rules(spark, change, rule):
    assert rule in rules(contracts.paper_violations(fixtures.papers(spark, {**PAPER, **change})))


def test_good_papers_and_collisions(spark):
    padded = {**PAPER, "title": " Fixture Paper ", "paper_id": " 2608.20316v1"}
    assert rules(contracts.paper_violations(fixtures.papers(spark, padded, SECOND))) == []
    clash = {**SECOND, "source_path": "data/./fixture.pdf"}
    assert rules(contracts.paper_violations(fixtures.papers(spark, PAPER, clash))) == ["source_path_shared"]
    assert "paper_id_duplicate" in rules(contracts.paper_violations(fixtures.papers(spark, PAPER, PAPER)))


def test_page_sets(spark):
    papers = fixtures.papers(spark)
    good = fixtures.pages(spark, "a", "b")
    assert rules(contracts.page_violations(good, papers)) == []
    doubled = good.unionByName(good.where("page_number = 1"))
    assert rules(contracts.page_violations(doubled, papers)) == ["page_duplicate", "page_sequence"]
    assert rules(contracts.page_violations(good.where("page_number = 2"), papers)) == ["page_sequence"]
    titled = good.withColumn("title", F.when(F.col("page_number") == 2, "Other").otherwise(F.col("title")))
    assert rules(contracts.page_violations(titled, papers)) == ["page_citation"]
    assert rules(contracts.page_violations(fixtures.pages(spark, "a", paper=SECOND), papers)) == ["page_citation"]


@pytest.mark.parametrize("column, value, rule", [
    ("text", "'abcdeX'", "slice"), ("title", "'Other'", "citation"),
    ("start_character", "start_character + 1", "offset_length"), ("schema_version", "2", "schema_version"),
    ("chunk_id", "'x'", "chunk_id"),
    ("chunking_profile_sha256", "repeat('G', 64)", "chunking_profile_sha256"),
    ("page_text_sha256", "repeat('0', 64)", "page_hash"), ("page_number", "9", "source_page"),
    ("content_token_count", "3", "token_counts")])
def test_tampered_chunks(spark, column, value, rule):
    pages = fixtures.pages(spark, "abcdefghij")
    chunks = chunk_pages(pages, ChunkSettings("fixed_characters", 6, 2))
    assert rules(contracts.chunk_violations(chunks, pages)) == []
    first = F.col("start_character") == 0
    kind = chunks.schema[column].dataType
    changed = chunks.withColumn("hit", first).withColumn(
        column, F.when(F.col("hit"), F.expr(value)).otherwise(F.col(column)).cast(kind)).drop("hit")
    assert rule in rules(contracts.chunk_violations(changed, pages))


def test_coverage_rules(spark):
    pages = fixtures.pages(spark, "abcdefghijklmnop")
    chunks = chunk_pages(pages, ChunkSettings("fixed_characters", 6, 2))
    assert "gap" in rules(contracts.chunk_violations(chunks.where("start_character <> 4"), pages))
    assert "page_end" in rules(contracts.chunk_violations(chunks.where("end_character < 16"), pages))
    assert "page_end" in rules(contracts.chunk_violations(chunks.limit(0), pages))
    twice = chunks.unionByName(chunks.where("start_character = 4"))
    assert {"repeated_span", "chunk_id_duplicate"} <= set(rules(contracts.chunk_violations(twice, pages)))


def test_facts_and_reports(spark):
    papers = fixtures.papers(spark, PAPER, SECOND)
    pages = fixtures.pages(spark, "abcdefghij", " ", "")
    chunks = chunk_pages(pages, ChunkSettings("fixed_characters", 6, 2))
    row = facts.quality_facts(papers, pages, chunks, "fixed_characters").head()
    assert (row["outcome"], row["pages_loaded"], row["blank_pages"], row["chunks_written"], row["unique_chunk_ids"],
            row["maximum_chunk_characters"], row["included_papers"], row["excluded_papers"]) == (
                "partial_failure", 3, 2, 2, 2, 6, 1, 1)
    empty = facts.quality_facts(papers, pages, chunks.limit(0)).head()
    assert empty["outcome"] == "failure" and empty["storage_round_trip_valid"] is None
    report = facts.extraction_report(papers, pages, spark.createDataFrame(
        [(SECOND["paper_id"], "parsing_failures")], "paper_id string, status string")).head()
    assert (report["outcome"], report["parsing_failures"], report["missing_pdfs"], report["usable_page_count"]) == (
        "partial_failure", 1, 0, 2)
    codes = spark.createDataFrame([("success",), ("partial_failure",), ("failure",)], "o string")
    assert [r[0] for r in codes.select(facts.exit_code(F.col("o"))).collect()] == [0, 2, 3]
    with pytest.raises(Exception, match="unknown outcome"):
        spark.createDataFrame([("odd",)], "o string").select(facts.exit_code(F.col("o"))).collect()


def test_one_hot_paper_stays_in_small_partials(spark):
    """A paper with nearly all pages is proven without gathering its pages."""
    rows = spark.range(1, 3001).select(
        *[F.lit(PAPER[n]).alias(n) if n != "authors" else F.array(F.lit("A. Author")).alias(n)
          for n, _ in schemas.CITATION], F.col("id").alias("page_number"), F.lit("x").alias("text"))
    assert rules(contracts.page_violations(rows, fixtures.papers(spark))) == []
    plan = contracts.page_facts(rows)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "collect_" not in plan


def test_a_page_of_millions_of_characters_is_swept_once(spark):
    text = "0123456789" * 500_000
    pages = fixtures.pages(spark, text)
    chunks = chunk_pages(pages, ChunkSettings("fixed_characters", 1800, 200))
    assert contracts.chunk_violations(chunks, pages).count() == 0
    wrong = chunks.withColumn("text", F.when(F.col("start_character") == 1600, F.reverse("text")).otherwise(F.col("text")))
    found = {r["rule"] for r in contracts.chunk_violations(wrong, pages).collect()}
    assert "slice" in found
    plan = contracts.coverage_sweep(chunks, pages)._jdf.queryExecution().analyzed().toString()
    assert "page_text#" not in plan


def test_the_check_cuts_and_cleans_pages_once(spark, tmp_path):
    """Pages and passages are staged, and the sweep's shuffle carries no passage's text."""
    from folioweave.plans import queries_text
    lines = "\n".join(f"Line {i} of some prose, told at length." * 12 for i in range(40))
    spark.createDataFrame([(i, lines, "en", f"src{i}") for i in range(3)],
                          "doc_id long, text string, lang string, source string").write.parquet(
        str(tmp_path / "documents.parquet"))
    found = queries_text.chunk_violations(spark, str(tmp_path))
    assert found.inputFiles() and not any("documents.parquet" in file for file in found.inputFiles())
    rules = {r["rule"] for r in found.collect()}
    assert {"chunk_id", "slice", "gap", "repeated_span", "chunk_id_duplicate", "offset_length"} <= rules
    page = fixtures.pages(spark, lines)
    swept = contracts.chunk_violations(chunk_pages(page, ChunkSettings()), page)
    tree = swept._jdf.queryExecution().optimizedPlan().toString()
    windowed = tree[:tree.index("Join FullOuter")]
    assert "row_rules" in windowed and " text#" not in windowed
