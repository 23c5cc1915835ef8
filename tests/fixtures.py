"""Hand-sized paper, page and passage records."""

from folioweave import schemas

PAPER = {"paper_id": "2608.20316v1", "paper_version": "v1", "title": "Fixture Paper",
         "authors": ["A. Author"], "published": "2026-08-21",
         "pdf_url": "https://arxiv.org/pdf/2608.20316v1", "source_path": "data/fixture.pdf"}
SECOND = {**PAPER, "paper_id": "2608.20318v1", "source_path": "data/second.pdf",
          "pdf_url": "https://arxiv.org/pdf/2608.20318v1"}


def table(spark, rows, schema):
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)


def papers(spark, *rows):
    return table(spark, rows or (PAPER,), schemas.PAPERS)


def search_papers(spark, *rows):
    full = [{"categories": ["cs.AI"], "abstract": "Research abstract",
             "url": "https://arxiv.org/abs/" + r["paper_id"], **r} for r in rows or (PAPER,)]
    return table(spark, full, schemas.SEARCH_PAPERS)


def pages(spark, *texts, paper=PAPER):
    rows = [{**paper, "page_number": i, "text": t} for i, t in enumerate(texts, 1)]
    return table(spark, rows, schemas.PAGES)
