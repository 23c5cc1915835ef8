"""Embedder plug-ins.

An embedder has a ``name``, a ``vector(column)`` expression and ``embed(texts)`` for the
few driver-side texts (a question, the probe). Model weights are never downloaded.
"""

from collections.abc import Callable
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, FloatType

from folioweave import fixed_values as V
from folioweave.functions.identity import canonical_hash


class LengthEmbedder:
    """``[length, count of "a" plus one, 1]``: small, native and deterministic."""

    name = "length-and-a"

    def vector(self, text: Column) -> Column:
        others = F.length(F.replace(text, F.lit("a"), F.lit("")))
        return F.array(F.length(text).cast("float"),
                       (F.length(text) - others + 1).cast("float"), F.lit(1.0).cast("float"))

    def embed(self, texts: list[str]) -> list[list[float]]:
        return [[float(len(t)), float(t.count("a") + 1), 1.0] for t in texts]


_COUNTED = 1 << 20      # bytes looked at together


def _counted(texts: pa.Array) -> pa.Array:
    """Counts of the bytes a to z in each text; a null text has 26 nulls."""
    texts = (texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts).cast(pa.large_string())
    absent = texts.is_null().to_numpy(zero_copy_only=False)
    texts = texts.fill_null("")
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1] if n else np.zeros(1, np.int64)
    held = texts.buffers()[2] if n else None
    data = np.frombuffer(held, np.uint8) if held is not None else np.empty(0, np.uint8)
    out = np.zeros(26 * n, np.int64)
    for low in range(offsets[0], offsets[-1], _COUNTED):
        high = min(low + _COUNTED, int(offsets[-1]))
        first = int(np.searchsorted(offsets, low, "right")) - 1
        last = int(np.searchsorted(offsets, high, "left"))
        sizes = np.diff(np.clip(offsets[first:last + 1], low, high))
        letter = data[low:high] - np.uint8(ord("a"))           # bytes below a wrap around
        place = np.repeat(np.arange(last - first) * 26, sizes) + letter
        out[26 * first:26 * last] += np.bincount(place[letter < 26], minlength=26 * (last - first))
    values = pa.array(out.astype(np.float32), mask=np.repeat(absent, 26))
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * 26), values)


def _letter_counts(low: Column) -> Column:
    @F.arrow_udf(ArrayType(FloatType()))
    def count(texts: pa.Array) -> pa.Array:
        return _counted(texts)

    return count(low)


class LetterEmbedder:
    """Counts of the letters a to z: an offline stand-in with some lexical signal."""

    name = "letter-counts"
    letters = "abcdefghijklmnopqrstuvwxyz"

    def vector(self, text: Column) -> Column:
        # Lower-casing stays native; one pass over the bytes then counts all letters of a batch.
        return _letter_counts(F.lower(text))

    def embed(self, texts: list[str]) -> list[list[float]]:
        return [[float(t.lower().count(x)) for x in self.letters] for t in texts]


class BatchEmbedder:
    """Any ``list[str] -> list[vector]`` callable, run in Arrow batches.

    ``load`` is called once per Python worker, so a model is built where it is used.
    """

    def __init__(self, name: str, load: Callable[[], Callable[[list[str]], list]],
                 batch_size: int = 64):
        self.name, self.load, self.batch_size = name, load, batch_size

    def vector(self, text: Column) -> Column:
        load, size = self.load, self.batch_size

        @F.pandas_udf(ArrayType(FloatType()))
        def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = load()
            for batch in batches:
                values = batch.fillna("").tolist()
                rows = []
                for at in range(0, len(values), size):
                    rows.extend(list(map(float, v)) for v in model(values[at:at + size]))
                yield pd.Series(rows)

        return encode(text)

    def embed(self, texts: list[str]) -> list[list[float]]:
        return [list(map(float, v)) for v in self.load()(texts)]


def fingerprint(embedder, model: str = V.EMBEDDING_MODEL) -> tuple[str, int]:
    """Identity and dimension of an embedder, from its vector of a fixed probe text."""
    probe = embedder.embed([V.EMBEDDING_PROBE])[0]
    kind = type(embedder)
    return canonical_hash({"model": model, "function": f"{kind.__module__}.{kind.__qualname__}",
                           "name": embedder.name, "probe": [float(x) for x in probe]}), len(probe)
