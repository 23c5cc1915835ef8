"""Collection of papers from the public feed.

The service asks for one request every three seconds, so fetching is a paced sequence by
design; parsing, validation and bookkeeping are Spark jobs. The fetcher is injected.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
import time
from urllib.request import Request, urlopen

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql import types as T

from folioweave import fixed_values as V, schemas
from folioweave.functions import identity
from folioweave.functions.text import strip
from folioweave.operators import contracts, sets
from folioweave.sources import atom


def http_fetch(url: str) -> bytes:
    with urlopen(Request(url, headers={"User-Agent": "folioweave/1.0"}), timeout=30) as answer:
        return answer.read()


def paced(items: Iterable, least: float = V.ARXIV_MIN_REQUEST_SECONDS,
          clock: Callable[[], float] = time.monotonic,
          sleep: Callable[[float], None] = time.sleep):
    """Yield items so that starts lie at least ``least`` seconds apart."""
    started = None
    for item in items:
        if started is not None:
            wait = least - (clock() - started)
            if wait > 0:
                sleep(wait)
        started = clock()
        yield item


def requested_ids(spark: SparkSession, ids: list[str]) -> DataFrame:
    """Stripped, canonical and distinct requested identifiers, or ValueError."""
    rows = spark.createDataFrame([(i,) for i in ids], "paper_id string").select(
        strip(F.col("paper_id")).alias("paper_id"))
    if rows.where(~identity.is_paper_id(F.col("paper_id"))).head():
        raise ValueError("identifiers need a version and canonical casing")
    if contracts.duplicates(rows, ["paper_id"], "duplicate").head():
        raise ValueError("requested identifiers must not repeat")
    return rows


def collect(spark: SparkSession, ids: list[str], manifest: DataFrame, folder: str,
            fetch: Callable[[str], bytes] = http_fetch, clock=time.monotonic,
            sleep=time.sleep) -> tuple[DataFrame, dict]:
    """Add explicitly requested papers to a manifest; failures stay per paper.

    Returns the new manifest and a report. Known papers are not fetched again.
    """
    wanted = requested_ids(spark, ids)
    fresh = [row[0] for row in sets.unseen(wanted, manifest, "paper_id").collect()]
    order = {name.strip(): at for at, name in enumerate(ids)}
    answers, failures = [], {}
    for paper_id in paced(sorted(fresh, key=order.get), clock=clock, sleep=sleep):
        try:
            xml = fetch(atom.query_url(paper_id)).decode("utf-8")
            answers.append((paper_id, xml, f"{folder}/{paper_id}.pdf"))
        except Exception as error:
            failures[paper_id] = f"metadata: {error}"
    responses = spark.createDataFrame(answers, "requested_id string, xml string, source_path string")
    parsed = atom.parse_entries(responses)
    broken = contracts.paper_violations(parsed.where("error IS NULL")).groupBy("key").agg(
        F.array_join(F.array_sort(F.collect_set("rule")), ", ").alias("rules"))
    for row in parsed.where("error IS NOT NULL").select("requested_id", "error").collect():
        failures[row[0]] = f"metadata: {row[1]}"
    for row in broken.collect():
        failures[row[0]] = f"metadata: {row[1]}"
    good = parsed.where(~F.col("requested_id").isin(*failures)) if failures else parsed
    added = good.select(*schemas.SEARCH_PAPERS.names)
    known = [name for name in order if name not in fresh]
    new = [name for name in fresh if name not in failures]
    outcome = V.SUCCESS if not failures else (V.PARTIAL_FAILURE if known or new else V.FAILURE)
    merged = sets.merge_rows(manifest.select(*schemas.SEARCH_PAPERS.names), added, "paper_id")
    return merged, {"outcome": outcome, "requested_papers": len(ids),
                    "added_papers": sorted(new), "existing_papers": sorted(known),
                    "failures": failures}


def download(papers: list[tuple[str, str, str]], present: set[str], write: Callable[[str, bytes], None],
             fetch: Callable[[str], bytes] = http_fetch) -> dict:
    """Fetch missing PDFs of ``(paper_id, pdf_url, source_path)``; only real PDFs are kept."""
    report = {"downloaded_pdfs": [], "skipped_downloads": [], "failures": {}}
    for paper_id, url, path in papers:
        if path in present:
            report["skipped_downloads"].append(paper_id)
            continue
        try:
            content = fetch(url)
            if not content.startswith(V.PDF_MAGIC):
                raise ValueError("the service sent something other than a PDF")
            write(path, content)
            report["downloaded_pdfs"].append(paper_id)
        except Exception as error:
            report["failures"][paper_id] = f"pdf: {error}"
    return report


class _FeedPartition(InputPartition):
    def __init__(self, start: int, size: int):
        self.start, self.size = start, size


class NewestPapers(DataSource):
    """``spark.read.format("newest_papers")``: raw feed pages, newest first.

    Options: ``n`` (1 to 100) and ``query``. Subclasses may override ``fetch``.
    """

    @classmethod
    def name(cls) -> str:
        return "newest_papers"

    def schema(self) -> str:
        return "start int, xml string"

    def fetch(self, url: str) -> bytes:
        return http_fetch(url)

    def reader(self, schema: T.StructType) -> "DataSourceReader":
        return _FeedReader(self, int(self.options.get("n", 10)),
                           self.options.get("query", V.ARXIV_CATEGORY_QUERY))


class _FeedReader(DataSourceReader):
    def __init__(self, source: NewestPapers, n: int, query: str):
        low, high = V.BOUNDS["n"]
        if not low <= n <= high:
            raise ValueError(f"n must lie between {low} and {high}")
        self.source, self.n, self.query = source, n, query

    def partitions(self):
        # One request serves up to 100 entries, so pacing needs no coordination.
        return [_FeedPartition(0, self.n)]

    def read(self, partition):
        from urllib.parse import urlencode
        asked = urlencode({"search_query": self.query, "start": partition.start,
                           "max_results": partition.size, "sortBy": "submittedDate",
                           "sortOrder": "descending"})
        yield partition.start, self.source.fetch(f"{V.ARXIV_API_URL}?{asked}").decode("utf-8")


def split_entries(feeds: DataFrame) -> DataFrame:
    """One single-entry response per entry of a feed page, for ``atom.parse_entries``."""
    parts = F.regexp_extract_all("xml", F.lit(r"(?s)<entry>.*?</entry>"), F.lit(0))
    entries = feeds.select(F.explode(parts).alias("entry"))
    xml = F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom">'), "entry", F.lit("</feed>"))
    found = identity.abs_id(F.regexp_extract("entry", r"(?s)<id>(.*?)</id>", 1))
    return entries.select(found.alias("requested_id"), xml.alias("xml"),
                          F.concat(F.lit("downloads/"), found, F.lit(".pdf")).alias("source_path"))
