import hashlib
import json

from pyspark.sql import functions as F
import pytest

from folioweave.functions import identity
from tests.test_text import evaluate


def test_paper_ids(spark):
    good = ["2608.20316v1", "hep-th/9901001v1", "cs.LG/9901001v12", "0704.0001v3"]
    bad = ["2608.20316V1", "HEP-TH/9901001v1", "cs.lg/9901001v1", "2608.20316", "2608.20316v0",
           "2608.20316v1\n", " 2608.20316v1", "2608.203160v1", None]
    assert evaluate(spark, identity.is_paper_id, good + bad) == [True] * len(good) + [False] * len(bad)


def test_pdf_urls(spark):
    pid = "2608.20316v1"
    base = f"https://arxiv.org/pdf/{pid}"
    good = [base, base + ".pdf", base.replace("https", "http"), base.replace("arxiv.org", "ARXIV.org"), base + "?"]
    bad = ["https://arxiv.org/pdf/2608.20318v2", base[:-2] + "v2", base[:-2], "https://arxiv.org/pdf/",
           base + "/extra", base + "?download=other", base + "#other", "ftp://arxiv.org/pdf/" + pid,
           base.replace("arxiv.org", "arxiv.org.evil.invalid"), base.replace("://", "://user@"), None]
    check = lambda c: identity.is_pdf_url(c, F.lit(pid))
    assert evaluate(spark, check, good + bad) == [True] * len(good) + [False] * len(bad)


def test_dates(spark):
    values = ["2026-08-21", "2024-02-29", "20260821", "2026-W34-5", "2026-8-21", "2026-02-30", "0000-01-01", None]
    assert evaluate(spark, identity.is_calendar_date, values) == [True, True] + [False] * 6


def test_abs_id_and_https(spark):
    urls = ["http://arxiv.org/abs/2608.20316v1", " http://arxiv.org/abs/hep-th%2F9901001v1/ ", "http://x.org/pdf/1",
            "http://arxiv.org/abs/a+b"]
    assert evaluate(spark, identity.abs_id, urls) == ["2608.20316v1", "hep-th/9901001v1", "", "a+b"]
    assert evaluate(spark, identity.https_once, ["http://a/http://b", "https://a"]) == ["https://a/http://b", "https://a"]


def test_canonical_json_equals_python(spark):
    texts = ["a\x0b\x1f\x00b", 'q"\\u000B\\', "\\\x0e", "é😀 \x7f/", "\n\t\b\f\r", "\\\\\x1a\\"]
    built = evaluate(spark, lambda c: identity.canonical_struct_json(F.lit(1).alias("a"), c.alias("t")), texts)
    assert built == [identity.canonical_json({"a": 1, "t": t}) for t in texts]


def test_table_digest_ignores_order_and_sees_copies(spark):
    rows = spark.createDataFrame([(i, str(i)) for i in range(100)], "a int, b string")
    one = identity.table_digest(rows).head()
    assert one == identity.table_digest(rows.repartition(7)).head()
    assert one != identity.table_digest(rows.unionByName(rows.limit(1))).head()
    assert identity.table_digest(rows.limit(0)).head()["record_count"] == 0


def test_digest_equals_a_plain_sum(spark):
    rows = spark.createDataFrame([("x",), ("y",), ("y",)], "a string")
    sums = [0] * 4
    for value in ("x", "y", "y"):
        h = hashlib.sha256(json.dumps({"a": value}, separators=(",", ":")).encode()).hexdigest()
        for i in range(4):
            sums[i] += int(h[15 * i:15 * i + 15], 16)
    text = ":".join(map(str, [3, *sums]))
    assert identity.table_digest(rows).head()["sha256"] == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("page", [1, 12345])
def test_chunk_id_equals_python(spark, page):
    record = {"paper_id": "2608.20316v1", "paper_version": "v1", "title": 'T "q"', "authors": ["A", "é"],
              "published": "2026-08-21", "pdf_url": "u", "page_number": page, "start_character": 0,
              "end_character": 3, "page_text_sha256": "0" * 64, "chunking_profile_sha256": "1" * 64, "text": "a\x0bb"}
    columns = {k: (F.array(*map(F.lit, v)) if isinstance(v, list) else F.lit(v)) for k, v in record.items()}
    digest = hashlib.sha256(identity.canonical_json(record).encode()).hexdigest()
    made = spark.range(1).select(identity.chunk_id(columns).alias("c")).head()["c"]
    assert made == f"2608.20316v1:p{page:04d}:{digest}"
