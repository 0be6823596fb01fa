"""Vectorised words and hashes over the bytes of Arrow text columns.

A word is a run of bytes other than ASCII white space (0x20 and 0x09-0x0D).
Texts are UTF-8, where no byte of a longer character is below 0x80, so this
equals the words of the characters. Null texts are empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once by a task; a longer single text is a block of its own.
BLOCK_BYTES = 2 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Everything but ASCII letters and digits and the bytes of longer characters.
MARKS = np.ones(256, bool)
MARKS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
#: ASCII lower case of each byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS = np.ones(1, np.uint64)
_INVERSE = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash base and of its inverse, modulo 2^64."""
    global _POWERS, _INVERSE
    if len(_POWERS) < n:
        size = max(n, BLOCK_BYTES + 64)
        back = pow(_BASE, -1, 1 << 64)
        _POWERS, _INVERSE = np.full(size, _BASE, np.uint64), np.full(size, back, np.uint64)
        _POWERS[0] = _INVERSE[0] = 1
        _POWERS, _INVERSE = np.multiply.accumulate(_POWERS), np.multiply.accumulate(_INVERSE)
    return _POWERS, _INVERSE


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All texts end to end as bytes, and the offsets of each (one more than there are texts)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of at most about ``limit`` bytes of text."""
    for batch in batches:
        _, offsets = text_bytes(batch.column(column))
        start, n = 0, batch.num_rows
        while start < n:
            end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1)
            yield batch.slice(start, min(end, n) - start)
            start = end


class Words:
    """Words of a block (runs of bytes that are not ``between``): ``start`` and ``end`` bytes, and ``first``: the index of each text's first word (one more at the end)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = True, between: np.ndarray = _SPACE):
        self.data, self.offsets = (LOWER[data] if lower else data), offsets
        n = len(data)
        word = ~between[data]
        edge = np.zeros(n + 1, bool)  # a text begins here
        edge[offsets] = True
        before = np.empty(n, bool)
        before[:1] = False
        before[1:] = word[:-1]
        self.start = np.flatnonzero(word & (~before | edge[:n]))
        after = np.empty(n, bool)
        after[-1:] = False
        after[:-1] = word[1:]
        self.end = np.flatnonzero(word & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, offsets)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """For each word, the index of its text."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts())

    def strings(self) -> pa.LargeStringArray:
        """The words themselves. Their bytes follow each other without gaps once those between them are left out."""
        edge = np.zeros(len(self.data) + 1, np.int8)
        edge[self.start] += 1
        edge[self.end] -= 1
        letters = self.data[np.cumsum(edge[:-1], dtype=np.int8).astype(bool)]
        ends = np.concatenate(([0], np.cumsum(self.end - self.start))).astype(np.int64)
        return pa.LargeStringArray.from_buffers(len(self.start), pa.py_buffer(ends), pa.py_buffer(letters))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        n = len(self.data)
        power, back = _powers(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * power[:n], out=total[1:])
        return mix((total[self.end] - total[self.start]) * back[self.start] + (self.end - self.start).astype(np.uint64))

    def shingles(self, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``n`` words and the text of each.

        A text of fewer words has one: its whole sequence. A text without words has none.
        """
        h, first, counts = self.hashes(), self.first, self.counts()
        runs = np.maximum(counts - n + 1, 0)
        runs[(counts > 0) & (counts < n)] = 1
        text = np.repeat(np.arange(len(counts)), runs)
        at = np.arange(len(text)) - np.repeat(np.cumsum(runs) - runs, runs) + first[text]
        out = np.zeros(len(text), np.uint64)
        rest = first[text + 1] - at
        last = max(len(h) - 1, 0)
        for k in range(n):
            part = h[np.minimum(at + k, last)] if len(h) else out
            odd = np.uint64((2 * k + 3) * 0xD6E8FEB86659FD93 % (1 << 64))
            out += np.where(rest > k, mix(part + np.uint64(k)) * odd, np.uint64(0))
        return mix(out), text
