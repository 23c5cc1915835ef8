"""Terms of whole texts as byte ranges of an Arrow column.

A term is a longest run of bytes of one kind; every byte of a character beyond ASCII is of
each kind, so a range never parts a character. Only A to Z are lower-cased.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

from folioweave.llm.common import ranges_of, text_buffer, word_hashes

_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LOWER = (_BYTES >= 97) & (_BYTES <= 122)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
LOWERED = np.where(_UPPER, _BYTES + 32, _BYTES).astype(np.uint8)
LETTERS = _UPPER | _LOWER | (_BYTES >= 128)
ALPHANUMERIC = LETTERS | _DIGIT


class Terms(NamedTuple):
    """Lower-cased bytes, the terms' ranges in them, and the row of each term (ascending)."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray

    def hashes(self) -> np.ndarray:
        return word_hashes(self.data, self.starts, self.ends)

    def strings(self, chosen: np.ndarray) -> pa.StringArray:
        return strings(self.data, self.starts[chosen], self.ends[chosen])


def cut(column: pa.Array, kind: np.ndarray) -> Terms:
    """The terms of all rows (null: none)."""
    data, offsets = text_buffer(column)
    starts, ends = ranges_of(kind[data], offsets)
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return Terms(LOWERED[data], starts, ends, rows)


def gathered(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of all ranges one after the other, and where each range begins among them."""
    at = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=at[1:])
    return np.arange(at[-1]) + np.repeat(starts - at[:-1], sizes), at


def strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.StringArray:
    index, at = gathered(starts, ends - starts)
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(at.astype(np.int32)),
                                       pa.py_buffer(data[index]))
