"""Identifiers, URLs, dates, hashes and order-free table digests."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, functions as F

from folioweave import fixed_values as V
from folioweave.functions.text import strip


def canonical_json(value: object) -> str:
    """Driver-side canonical JSON for small control documents."""
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"),
                      allow_nan=False)


def canonical_hash(value: object) -> str:
    return hashlib.sha256(canonical_json(value).encode("utf-8")).hexdigest()


def sha256(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


# ---- predicates ---------------------------------------------------------------

def is_paper_id(value: Column) -> Column:
    return F.coalesce(F.regexp_like(value, F.lit(V.PAPER_ID_PATTERN)), F.lit(False))


def is_version_of(version: Column, paper_id: Column) -> Column:
    shape = F.regexp_like(version, F.lit(V.PAPER_VERSION_PATTERN))
    return F.coalesce(shape & F.endswith(F.lower(paper_id), F.lower(version)), F.lit(False))


def is_hash(value: Column) -> Column:
    return F.coalesce(F.regexp_like(value, F.lit(V.HASH_PATTERN)), F.lit(False))


def is_calendar_date(value: Column) -> Column:
    shape = F.regexp_like(value, F.lit(V.DATE_PATTERN))
    # try_cast accepts year 0000, which is no calendar date.
    return F.coalesce(shape & ~F.startswith(value, F.lit("0000"))
                      & value.try_cast("date").isNotNull(), F.lit(False))


def is_pdf_url(url: Column, paper_id: Column) -> Column:
    """http(s), host exactly arxiv.org, path ``/pdf/<id>`` with optional ``.pdf``.

    A bare trailing ``?`` or ``#`` carries no query or fragment and is accepted.
    """
    rest = F.regexp_extract(url, r"(?s)\A(?i:https?)://(?i:arxiv\.org)(/pdf/.*)\z", 1)
    path = F.regexp_replace(rest, r"(\?#?|#)\z", "")
    good = path.isin(F.concat(F.lit("/pdf/"), paper_id),
                     F.concat(F.lit("/pdf/"), paper_id, F.lit(".pdf")))
    return F.coalesce(good, F.lit(False))


def is_relative_path(path: Column) -> Column:
    safe = ~F.startswith(path, F.lit("/")) & ~F.array_contains(F.split(path, "/"), "..")
    return F.coalesce(safe, F.lit(False))


# ---- derivations --------------------------------------------------------------

def version_of(paper_id: Column) -> Column:
    return F.lower(F.regexp_extract(paper_id, r"(?i)(v\d+)\z", 1))


def percent_decode(text: Column) -> Column:
    """Percent-decoding that leaves ``+`` alone."""
    return F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def abs_id(url: Column) -> Column:
    """The identifier after the first ``/abs/`` of a URL's decoded path."""
    path = F.regexp_extract(strip(url), r"\A[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    tail = F.regexp_extract(percent_decode(path), r"(?s)\A.*?/abs/(.*)\z", 1)
    return F.btrim(tail, F.lit("/"))


def https_once(url: Column) -> Column:
    return F.regexp_replace(url, r"(?s)\A(.*?)http://", r"$1https://")


# Control characters whose JSON escapes contain hex letters.
_LETTERED = (0x0B, 0x0E, 0x0F, 0x1A, 0x1B, 0x1C, 0x1D, 0x1E, 0x1F)


def canonical_struct_json(*fields: Column) -> Column:
    """JSON of named columns given in key order, byte-equal to canonical JSON.

    Spark writes control-character escapes with upper-case hex digits; canonical JSON
    uses lower case. JSON text never holds a raw control character, so U+0001 can stand
    for an escaped backslash while plain replacements do the rest.
    """
    raw = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    text = F.replace(raw, F.lit("\\\\"), F.lit("\x01"))
    for point in _LETTERED:
        text = F.replace(text, F.lit(f"\\u{point:04X}"), F.lit(f"\\u{point:04x}"))
    text = F.replace(text, F.lit("\x01"), F.lit("\\\\"))
    return F.when(F.contains(raw, F.lit("\\u00")), text).otherwise(raw)


def chunk_id(columns: dict[str, Column] | None = None) -> Column:
    """``paper:pNNNN:digest`` over citation, page identity, span, hashes and text."""
    source = columns or {name: F.col(name) for name in V.IDENTITY_FIELDS}
    ordered = [source[name].alias(name) for name in sorted(V.IDENTITY_FIELDS)]
    return F.concat_ws(":", source["paper_id"],
                       F.format_string("p%04d", source["page_number"].cast("long")),
                       sha256(canonical_struct_json(*ordered)))


# ---- table digests ------------------------------------------------------------

DIGEST_WORDS = 4
_WORD_HEX = 15


def row_hash(columns: list[str]) -> Column:
    ordered = [F.col(name) for name in sorted(columns)]
    return sha256(F.to_json(F.struct(*ordered), {"ignoreNullFields": "false"}))


def digest_aggregates(hash_column: Column) -> list[Column]:
    """Partial-aggregable sums of hash words: equal multisets give equal sums.

    Sums combine map-side and never collect rows, unlike a hash over a sorted list.
    """
    return [F.sum(F.conv(F.substring(hash_column, 1 + i * _WORD_HEX, _WORD_HEX), 16, 10)
                  .cast("decimal(19,0)")).cast("decimal(38,0)").alias(f"word{i}")
            for i in range(DIGEST_WORDS)]


def digest_of_sums() -> Column:
    return F.sha2(F.concat_ws(":", F.col("record_count").cast("string"),
                              *[F.coalesce(F.col(f"word{i}"), F.lit(0)).cast("decimal(38,0)")
                                .cast("string") for i in range(DIGEST_WORDS)]), 256)


def table_digest(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row ``(record_count, sha256)``, independent of row order and partitioning."""
    hashed = df.select(row_hash(columns or df.columns).alias("h"))
    sums = hashed.agg(F.count("*").alias("record_count"), *digest_aggregates(F.col("h")))
    return sums.select("record_count", digest_of_sums().alias("sha256"))
