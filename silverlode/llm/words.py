"""Words and word shingles of Arrow text columns as numpy arrays.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``.  Hashes are 64 bits wide and
depend on the word's bytes alone, so they agree between executors and runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: White space and ASCII punctuation, for words without their commas and quotes.
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SHINGLE = np.uint64(0xC2B2AE3D27D4EB4F)
_POWERS = np.ones(1, np.uint64)
#: Bytes of words that are hashed together.
_BLOCK_BYTES = 1 << 17


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of splitmix64)."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        size = max(n, 2 * len(_POWERS), 256)
        _POWERS = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, _BASE)]))
    return _POWERS


class Words:
    """The words of a text column: ``first[i]:first[i + 1]`` are those of row ``i``."""

    def __init__(self, column: pa.Array | pa.ChunkedArray, lower: bool = False, gaps: np.ndarray = _SPACE):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        column = pc.fill_null(column.cast(pa.large_string()), "")
        if lower:
            column = pc.utf8_lower(column)
        rows = len(column)
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + rows + 1] if rows else np.zeros(1, np.int64)
        data = column.buffers()[2] if rows else None
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.data = raw[offsets[0] : offsets[-1]]
        self.offsets = offsets - offsets[0]
        inside = ~gaps[self.data]
        edge = np.zeros(len(self.data) + 1, bool)
        edge[self.offsets] = True
        before = np.concatenate([[False], inside])
        after = np.concatenate([inside, [False]])
        # starts[w] and ends[w] are byte positions in ``data``
        self.starts = np.flatnonzero(after & (~before | edge))
        self.ends = np.flatnonzero(before & (~after | edge))
        self.first = np.searchsorted(self.starts, self.offsets)
        self._inside = inside

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """By blocks of words, so little is held beside the words themselves."""
        lengths = self.ends - self.starts
        after = np.cumsum(lengths)
        out = np.empty(len(lengths), np.uint64)
        a = 0
        while a < len(lengths):
            before = int(after[a] - lengths[a])
            b = max(a + 1, int(np.searchsorted(after, before + _BLOCK_BYTES, "right")))
            begin = after[a:b] - lengths[a:b] - before
            data = self.data[self.starts[a] : self.ends[b - 1]]
            values = data[self._inside[self.starts[a] : self.ends[b - 1]]].astype(np.uint64) + np.uint64(1)
            place = np.arange(len(values)) - np.repeat(begin, lengths[a:b])
            out[a:b] = np.add.reduceat(values * _powers(int(lengths[a:b].max()))[place], begin)
            a = b
        return mix(out)

    def prefix_hashes(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Word indices and hashes of the first ``size`` bytes of each longer word."""
        which = np.flatnonzero(self.ends - self.starts > size)
        total = np.zeros(len(which), np.uint64)
        powers = _powers(size)
        for i in range(size):
            total += (self.data[self.starts[which] + i].astype(np.uint64) + np.uint64(1)) * powers[i]
        return which, mix(total ^ (_powers(size + 1)[size]))


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` words; a shorter text is one window, an empty one none."""
    count = len(hashes)
    width = min(size, count)
    if not width:
        return np.zeros(0, np.uint64)
    total, held = hashes, 1  # the polynomial of ``held`` words; its width doubles, and grows by one, as the bits of ``width`` say
    for bit in bin(width)[3:]:
        total = total[:-held] * np.uint64(pow(int(_SHINGLE), held, 1 << 64)) + total[held:]
        held *= 2
        if bit == "1":
            total = total[:-1] * _SHINGLE + hashes[held:]
            held += 1
    return mix(total + np.uint64(width))


def slices(batch: pa.RecordBatch, column: str, limit: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Consecutive pieces of a batch, each with at most ``limit`` text bytes or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    begin, held = 0, 0
    for i, size in enumerate(sizes):
        if i > begin and held + size > limit:
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += int(size)
    if begin < len(sizes):
        yield batch.slice(begin)
