"""Runs of letters of Arrow text columns, coded by a dictionary of the distinct runs of a piece."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 8_000_000

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_LETTER_OR_WIDE = _LETTER.copy()
_LETTER_OR_WIDE[0x80:] = True


def letters_and_wide(data: np.ndarray) -> np.ndarray:
    """Bytes of ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]``: ASCII letters and whole characters beyond ASCII."""
    return _LETTER_OR_WIDE[data]


def latin_letters(data: np.ndarray) -> np.ndarray:
    """Bytes of ``[A-Za-z\\u00C0-\\u00FF]``; in UTF-8 the second range is C3 with any one byte behind it."""
    lead = data == 0xC3
    inside = _LETTER[data] | lead
    inside[1:] |= lead[:-1]
    return inside


@dataclass(frozen=True)
class Runs:
    """Run ``i`` stands in text ``rows[i]`` and is ``names[codes[i]]``."""

    rows: np.ndarray
    codes: np.ndarray
    names: pa.LargeStringArray

    def per_row(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct (row, code) pairs and how often each occurs."""
        pairs, counts = np.unique(self.rows * max(len(self.names), 1) + self.codes, return_counts=True)
        rows, codes = np.divmod(pairs, max(len(self.names), 1))
        return rows, codes, counts


def runs(column: pa.Array, inside: Callable[[np.ndarray], np.ndarray]) -> Runs:
    """The maximal runs of ``inside`` bytes in whole texts, with A-Z in lower case (null: none)."""
    column = pc.ascii_lower(pc.fill_null(column.cast(pa.large_string()), ""))
    count = len(column)
    if not count or column.buffers()[2] is None:
        return Runs(np.zeros(0, np.int64), np.zeros(0, np.int64), pa.array([], pa.large_string()))
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + count + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    held = inside(data)
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before, after = np.concatenate([[False], held]), np.concatenate([held, [False]])
    starts = np.flatnonzero(after & (~before | edge))
    ends = np.flatnonzero(before & (~after | edge))
    bounds = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    whole = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(data[held]))
    coded = whole.dictionary_encode()
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return Runs(rows, coded.indices.to_numpy().astype(np.int64), coded.dictionary)
