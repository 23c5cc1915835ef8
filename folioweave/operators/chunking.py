"""Page text to citation passages.

All three profiles are narrow: no shuffle, one pass over each page.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from folioweave import fixed_values as V, schemas
from folioweave.functions import identity
from folioweave.functions.spans import boundary_spans, token_spans
from folioweave.functions.text import is_blank

# Flush an output batch once it holds about this many characters.
_FLUSH_CHARACTERS = 16_000_000


def _whole(value, name: str, least: int) -> None:
    if type(value) is not int or value < least:
        raise ValueError(f"{name} must be an integer >= {least}")


@dataclass(frozen=True)
class ChunkSettings:
    """Chunk budgets. Characters are code points; token budgets are real counts."""

    profile: str = V.DEFAULT_CHUNK_SETTINGS["profile"]
    size: int = V.DEFAULT_CHUNK_SETTINGS["size"]
    overlap: int = V.DEFAULT_CHUNK_SETTINGS["overlap"]
    token_budget: int = V.DEFAULT_CHUNK_SETTINGS["token_budget"]
    token_overlap: int = V.DEFAULT_CHUNK_SETTINGS["token_overlap"]
    max_input_tokens: int = V.DEFAULT_CHUNK_SETTINGS["max_input_tokens"]

    def __post_init__(self):
        if self.profile not in V.CHUNK_PROFILES:
            raise ValueError("unsupported chunking profile")
        for name, least in (("size", 1), ("token_budget", 1), ("max_input_tokens", 1),
                            ("overlap", 0), ("token_overlap", 0)):
            _whole(getattr(self, name), name, least)
        if self.overlap >= self.size or self.token_overlap >= self.token_budget:
            raise ValueError("an overlap must be smaller than its budget")
        if self.token_budget > self.max_input_tokens:
            raise ValueError("the content budget exceeds the complete input budget")

    def record(self, tokenizer=None) -> dict:
        """Effective settings with tokenizer provenance; hashed into every passage."""
        if self.profile == "tokenizer" and tokenizer is None:
            raise ValueError("the tokenizer profile needs an explicit local tokenizer")
        used = tokenizer.provenance() if self.profile == "tokenizer" else None
        return {"algorithm_version": V.ALGORITHM_VERSION, **asdict(self), "tokenizer": used}

    def profile_hash(self, tokenizer=None) -> str:
        return identity.canonical_hash(self.record(tokenizer))


def _fixed(pages: DataFrame, settings: ChunkSettings) -> DataFrame:
    """Windows in closed form, cut by one linear regex scan.

    The look-ahead captures a window while the match itself advances by one step. A
    ``substring`` per window would rescan the page from its start every time.
    """
    size, step = settings.size, settings.size - settings.overlap
    windows = F.regexp_extract_all(
        F.col("text"), F.lit(rf"(?s)(?=(.{{1,{size}}})).{{1,{step}}}"), F.lit(1))
    count = F.greatest(F.lit(1), F.ceil((F.length("text") - settings.overlap) / F.lit(step)))
    keep = [name for name in pages.columns if name != "text"]
    used = F.when(~is_blank(F.col("text")), F.slice(windows, F.lit(1), count.cast("int")))
    # The outer form keeps Catalyst from inferring a filter that would run the scan twice.
    laid = pages.select(*keep, F.posexplode_outer(used).alias("index", "text")).where(
        F.col("text").isNotNull())
    start = F.col("index").cast("long") * F.lit(step)
    return laid.select(
        *keep, "text", start.alias("start_character"),
        (start + F.length("text")).alias("end_character"),
        F.lit(None).cast("long").alias("content_token_count"),
        F.lit(None).cast("long").alias("input_token_count"))


def _by_spans(pages: DataFrame, find: Callable[[str], Iterator[tuple]]) -> DataFrame:
    """Explode every page by a Python span rule, in Arrow batches.

    Pass-through columns are gathered by Arrow ``take``, so Python only touches the text.
    """
    keep = [name for name in pages.columns if name != "text"]
    added = [T.StructField("text", T.StringType()),
             *[T.StructField(name, T.LongType()) for name in (
                 "start_character", "end_character", "content_token_count",
                 "input_token_count")]]
    schema = T.StructType([*[pages.schema[name] for name in keep], *added])
    names = [field.name for field in added]

    def cut(batches):
        for batch in batches:
            kept = batch.select(keep)
            parents, rows, held = [], [], 0

            def flush():
                columns = list(zip(*rows))
                arrays = [pa.array(columns[0], pa.string()),
                          *[pa.array(column, pa.int64()) for column in columns[1:]]]
                taken = kept.take(pa.array(parents, pa.int64()))
                return pa.RecordBatch.from_arrays([*taken.columns, *arrays],
                                                  names=[*keep, *names])

            for parent, text in enumerate(batch.column("text")):
                text = text.as_py()
                if not text or text.isspace():
                    continue
                for start, end, content, complete in find(text):
                    parents.append(parent)
                    rows.append((text[start:end], start, end, content, complete))
                    held += end - start
                    if held > _FLUSH_CHARACTERS:
                        yield flush()
                        parents, rows, held = [], [], 0
            if rows:
                yield flush()

    return pages.mapInArrow(cut, schema)


def cut_pages(pages: DataFrame, settings: ChunkSettings, tokenizer=None) -> DataFrame:
    """Spans of every non-blank page: input columns plus text and offsets.

    Blank pages fall away inside the cut. A filter in front of it would be pushed below
    the cleanup of the text and would run that cleanup a second time.
    """
    if settings.profile == "fixed_characters":
        return _fixed(pages, settings)
    if settings.profile == "boundary_characters":
        size, overlap = settings.size, settings.overlap
        return _by_spans(pages, lambda text: boundary_spans(text, size, overlap))
    if tokenizer is None:
        raise ValueError("the tokenizer profile needs an explicit local tokenizer")
    budget, overlap, ceiling = (settings.token_budget, settings.token_overlap,
                                settings.max_input_tokens)
    return _by_spans(pages, lambda text: token_spans(text, tokenizer, budget, overlap, ceiling))


def chunk_pages(pages: DataFrame, settings: ChunkSettings | None = None,
                tokenizer=None) -> DataFrame:
    """Citation passages of validated pages, with content-derived identifiers."""
    settings = settings or ChunkSettings()
    profile_hash = settings.profile_hash(tokenizer)
    names = [field[0] for field in schemas.CITATION]
    hashed = pages.select(*names, F.col("page_number").cast("long").alias("page_number"),
                          identity.sha256(F.col("text")).alias("page_text_sha256"), "text")
    spans = cut_pages(hashed, settings, tokenizer)
    full = spans.withColumns({"schema_version": F.lit(V.SCHEMA_VERSION),
                              "chunking_profile_sha256": F.lit(profile_hash)})
    return full.withColumn("chunk_id", identity.chunk_id()).select(*schemas.CHUNKS.names)
