"""Words of an Arrow text column as numpy arrays.

Both word patterns used here are unions of byte classes in UTF-8 (every
byte of a non-ASCII character is >= 0x80), so words can be found on the raw
bytes. A word's hash is a polynomial of its bytes modulo 2**64, read off a
running sum, then mixed; equal words have equal hashes wherever they stand.
Nulls count as empty texts. Work is done in slices of bounded byte size; one
text is never split, so a slice is at least one whole text.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = U64(pow(int(_BASE), -1, 1 << 64))

#: words ``[^\x20\x09-\x0D]+``
NONSPACE = np.ones(256, dtype=bool)
NONSPACE[[0x20, *range(0x09, 0x0E)]] = False
#: words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z became a-z
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 1 << 20)
        for k, base in enumerate((_BASE, _BASE_INV)):
            p = np.full(size, base, U64)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=U64)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


@dataclass
class Words:
    """Words of consecutive texts: byte spans in ``data``, hashes, and the
    range ``first[i]:first[i + 1]`` of words of text ``i``."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray
    run: np.ndarray

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of byte spans, such as the words' first bytes."""
        if not len(start):
            return np.zeros(0, U64)
        return mix((self.run[end] - self.run[start]) * _power_tables(len(self.data) + 1)[1][start])

    @property
    def texts(self) -> int:
        return len(self.first) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.texts), self.counts())


def text_buffers(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string column, nulls as empty texts."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
        if isinstance(col, pa.ChunkedArray):
            col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], pa.string())
    if col.null_count:
        col = col.fill_null("" if not pa.types.is_binary(col.type) else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def split_words(data: np.ndarray, offsets: np.ndarray, member: np.ndarray = NONSPACE, lower: bool = True,
                hashed: bool = True) -> Words:
    """Words made of ``member`` bytes; A-Z count as a-z if ``lower``."""
    if lower:
        data = _LOWER[data]
    inside = member[data]
    filled = np.flatnonzero(offsets[1:] > offsets[:-1])
    before = np.zeros(len(inside), bool)
    before[1:] = inside[:-1]
    before[offsets[filled]] = False
    after = np.zeros(len(inside), bool)
    after[:-1] = inside[1:]
    after[offsets[filled + 1] - 1] = False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    w = Words(data, offsets, start, end, np.zeros(0, U64), np.searchsorted(start, offsets), np.zeros(1, U64))
    if hashed:
        w.run = np.zeros(len(data) + 1, U64)
        np.cumsum((data.astype(U64) + U64(1)) * _power_tables(len(data) + 1)[0][:len(data)], out=w.run[1:])
        w.hash = w.span_hash(start, end)
    return w


def text_slices(col: pa.Array | pa.ChunkedArray, max_bytes: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, last row + 1, bytes, offsets)`` of runs of rows whose
    texts hold at most ``max_bytes`` together (or of one longer text)."""
    data, offsets = text_buffers(col)
    row, n = 0, len(offsets) - 1
    while row < n:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + max_bytes, "right")) - 1)
        yield row, stop, data[offsets[row]:offsets[stop]], offsets[row:stop + 1] - offsets[row]
        row = stop
    del data, offsets
    release()


def release() -> None:
    """Give freed memory back to the system: workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim:
            trim(0)


def ngrams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``n`` words inside each text, and the texts' ranges.

    A text of fewer words, but not none, is one run of all its words.
    """
    count = words.counts()
    runs = np.where(count >= n, count - n + 1, (count > 0).astype(count.dtype))
    first = np.zeros(len(count) + 1, np.int64)
    np.cumsum(runs, out=first[1:])
    h = np.zeros(first[-1], U64)
    full = np.repeat(count >= n, runs)
    at = np.arange(first[-1]) - np.repeat(first[:-1], runs) + np.repeat(words.first[:-1], runs)
    if full.any():
        a = at[full]
        acc = words.hash[a]
        for k in range(1, n):
            acc = mix(acc * _BASE + words.hash[a + k])
        h[full] = acc
    for i in np.flatnonzero((count > 0) & (count < n)):
        acc = words.hash[words.first[i]:words.first[i] + 1]
        for x in words.hash[words.first[i] + 1:words.first[i + 1]]:
            acc = mix(acc * _BASE + x)
        h[first[i]] = mix(acc + U64(count[i]))[0]
    return h, first
