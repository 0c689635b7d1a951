"""Vectorised word, line and window fingerprints over Arrow text columns.

Helpers that run inside Spark tasks on one Arrow batch at a time.  Words are
the maximal runs of bytes other than space and \\x09-\\x0D, which for UTF-8 is
the pattern ``[^\\x20\\x09-\\x0D]+``.  A fingerprint is a 64-bit polynomial
over random byte values followed by a mixing step; a window's fingerprint is
a polynomial over the fingerprints of its words, so equal sequences always
agree and unequal ones differ but for a chance of about 2**-64 a pair
(2**-128 where two of them are taken together).

Memory: batches are cut into pieces of about ``PIECE_BYTES`` of text; only a
single text longer than that makes a larger piece, and byte-level temporaries
are made for ``BLOCK_BYTES`` at a time even then.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 19
BLOCK_BYTES = 1 << 19

_U = np.uint64
_BYTE_VALUES = np.random.Generator(np.random.PCG64(20240607)).integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Powers:
    """base**i and base**-i modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, BLOCK_BYTES + 1)
            steps = np.full(size, _BASE, dtype=np.uint64)
            steps[0] = 1
            self.up = np.cumprod(steps, dtype=np.uint64)
            steps[1:] = _INVERSE
            self.down = np.cumprod(steps, dtype=np.uint64)
        return self.up, self.down


_POWERS = _Powers()


def spans_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """Fingerprint of data[start:end] for sorted, disjoint spans."""
    out = np.empty(len(starts), dtype=np.uint64)
    values = _BYTE_VALUES[_LOWER] if lower else _BYTE_VALUES
    i = 0
    while i < len(starts):
        first = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, first + BLOCK_BYTES, side="right")))
        last = int(ends[j - 1])
        up, down = _POWERS.upto(last - first + 1)
        sums = np.zeros(last - first + 1, dtype=np.uint64)
        np.cumsum(values[data[first:last]] * up[: last - first], out=sums[1:])
        s, e = starts[i:j] - first, ends[i:j] - first
        out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    return out


@dataclass
class Piece:
    """Texts of consecutive rows [first, first + n) of a batch."""

    first: int
    n: int
    data: np.ndarray      # their bytes
    offsets: np.ndarray   # n + 1 byte offsets into data
    starts: np.ndarray    # of each word
    ends: np.ndarray
    words: np.ndarray     # n + 1 offsets into starts and ends

    def word_hashes(self, lower: bool = False) -> np.ndarray:
        return spans_hash(self.data, self.starts, self.ends, lower)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and the row of every \\n-split line; an empty text has one empty line."""
        breaks = np.flatnonzero(self.data == 10)
        rows = np.searchsorted(self.offsets, breaks, side="right") - 1
        count = np.bincount(rows, minlength=self.n) + 1
        first = np.concatenate(([0], np.cumsum(count)))[:-1]
        row = np.repeat(np.arange(self.n), count)
        starts, ends = np.empty(len(row), dtype=np.int64), np.empty(len(row), dtype=np.int64)
        is_first, is_last = np.zeros(len(row), dtype=bool), np.zeros(len(row), dtype=bool)
        is_first[first], is_last[first + count - 1] = True, True
        starts[is_first], starts[~is_first] = self.offsets[:-1], breaks + 1
        ends[is_last], ends[~is_last] = self.offsets[1:], breaks
        return starts, ends, row


def pieces(texts: pa.Array) -> Iterator[Piece]:
    """Cut a string column (nulls read as empty texts) into pieces."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return
    _, at, raw = texts.buffers()
    offsets = np.frombuffer(at, dtype=np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + PIECE_BYTES, side="right")) - 1)
        yield _piece(i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        i = j


def _piece(first: int, data: np.ndarray, offsets: np.ndarray) -> Piece:
    n = len(offsets) - 1
    inside = np.zeros(len(data) + 1, dtype=bool)
    np.logical_not(_WHITE[data], out=inside[:-1])
    begins, stops = inside.copy(), np.zeros(len(data) + 1, dtype=bool)
    begins[1:-1] &= ~inside[:-2]
    stops[1:] = inside[:-1] & ~inside[1:]
    edge = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[edge] |= inside[edge]
    cut = edge[edge > 0]
    stops[cut] |= inside[cut - 1]
    starts, ends = np.flatnonzero(begins[:-1]), np.flatnonzero(stops)
    return Piece(first, n, data, offsets, starts, ends, np.searchsorted(starts, offsets))


def windows(hashes: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Fingerprint of each run of ``size`` consecutive word fingerprints."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    factor, total = _U(0xD6E8FEB86659FD93 + 2 * seed), np.full(count, seed + 1, dtype=np.uint64)
    for k in range(size):
        total *= factor
        total += hashes[k : k + count]
    return mix(total)


def shingle_sets(piece: Piece, size: int, lower: bool = True) -> Iterator[np.ndarray]:
    """Per text: its sorted distinct ``size``-word shingles; a text of fewer
    words has its whole sequence as one shingle, one without words none."""
    hashes = piece.word_hashes(lower)
    every = windows(hashes, size)
    for a, b in zip(piece.words[:-1].tolist(), piece.words[1:].tolist()):
        if b - a >= size:
            yield np.unique(every[a : b - size + 1])
        elif b > a:
            yield windows(hashes[a:b], b - a, seed=b - a)
        else:
            yield np.zeros(0, dtype=np.uint64)


def covered(marks: np.ndarray, size: int) -> np.ndarray:
    """Words covered by the marked windows (one mark a window start), over
    len(marks) + size - 1 words."""
    change = np.zeros(len(marks) + size, dtype=np.int64)
    at = np.flatnonzero(marks)
    change[at] += 1
    np.subtract.at(change, at + size, 1) if len(at) else None
    return np.cumsum(change[:-1]) > 0
