"""Words and shingles of Arrow text columns as numpy arrays over UTF-8 bytes.

Word classes that are stated in ASCII hold for bytes as well, since every byte of a character outside ASCII is 0x80
or more. A word's hash is a polynomial in its mixed bytes modulo 2**64, read off prefix sums; a run of words is
hashed the same way from mixed word hashes. Texts are taken in pieces of whole documents of about ``CHUNK`` bytes, so
that memory is bounded by the longest text and not by the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 18
U = np.uint64
BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finalizer (xor-shift and multiply), elementwise."""
    x = x + U((0xA0761D6478BD642F + seed * 0xE7037ED1A0B428DB) & (2**64 - 1))
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_BYTES = mixed(np.arange(256, dtype=U), 1)


class _Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, as many as asked for."""

    def __init__(self, base: int):
        self.bases = (base, pow(base, -1, 2**64))
        self.up = self.down = np.ones(1, U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * CHUNK)
            self.up, self.down = (np.cumprod(np.r_[U(1), np.full(n - 1, b, U)]) for b in self.bases)
        return self.up, self.down


_OF_BYTES, _OF_WORDS = _Powers(BASE), _Powers(WORD_BASE)


def word_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n - 1 and more of the base of word runs, and of its inverse."""
    return _OF_WORDS.get(n)


def _classes(separators: bytes) -> np.ndarray:
    is_word = np.ones(256, bool)
    is_word[np.frombuffer(separators, np.uint8)] = False
    return is_word


#: Words between the six ASCII spaces, as they stand.
SPACED = _classes(b" \t\n\r\x0b\x0c")
#: Words of digits, letters and everything outside ASCII.
ALNUM = _classes(bytes(i for i in range(128) if not chr(i).isalnum()))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Words:
    """Words of consecutive documents: byte spans in ``data``, and for document i the words [first[i], first[i+1])."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def runs(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every run of k words that stays in one document."""
        n = len(self.hash)
        if n < k:
            return np.zeros(0, np.int64), np.zeros(0, U)
        room = np.repeat(self.first[1:], np.diff(self.first)) - np.arange(n)
        at = np.flatnonzero(room >= k)
        up, down = _OF_WORDS.get(n + 1)
        sums = np.zeros(n + 1, U)
        np.cumsum(self.hash * up[:n], out=sums[1:])
        return at, mixed((sums[at + k] - sums[at]) * down[at], k)


def runs_of(data: np.ndarray, bounds: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of a byte class; a document's end also ends a run."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = is_word[data]
    marks = np.flatnonzero(inside[1:] != inside[:-1])
    cut = bounds[1:-1]
    cut = np.unique(cut[(cut > 0) & (cut < len(data))])
    both = cut[inside[cut] & inside[cut + 1]]
    if len(both):
        marks = np.sort(np.r_[marks, both, both])
    return marks[::2], marks[1::2]


def words_of(data: np.ndarray, bounds: np.ndarray, is_word: np.ndarray, lower: bool) -> Words:
    """Words of the documents data[bounds[i]:bounds[i+1]]."""
    if lower:
        data = _LOWER[data]
    start, end = runs_of(data, bounds, is_word)
    up, down = _OF_BYTES.get(len(data) + 1)
    sums = np.zeros(len(data) + 1, U)
    np.cumsum(_BYTES[data] * up[: len(data)], out=sums[1:])
    hashes = mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(U) * U(BASE), 2)
    return Words(data, start, end, np.searchsorted(start, bounds), hashes)


def pieces(column: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from row, to row, bytes, bounds) of a string column, whole texts of about ``size`` bytes; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    n = len(column)
    if not n:
        return
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + size, "right")) - 1)
        b = min(b, n)
        yield a, b, raw[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]
        a = b


def words_in(column: pa.Array, is_word: np.ndarray, lower: bool = False) -> Iterator[tuple[int, int, Words]]:
    """(from row, to row, words) of a string column, piece by piece."""
    for a, b, data, bounds in pieces(column):
        yield a, b, words_of(data, bounds, is_word, lower)


def marked(n: int, starts: np.ndarray, lengths) -> np.ndarray:
    """Which of n positions lie in one of the intervals [start, start + length)."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, starts + lengths, -1)
    return np.cumsum(depth)[:n] > 0
