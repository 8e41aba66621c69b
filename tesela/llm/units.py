"""Units of a text that a tokenizer treats alone, coded once per worker.

A tokenizer whose pieces never cross certain places of a text can code the
stretches between them one by one: the tokens of a text are those of its
units in order. Distinct units are found with Arrow's exact dictionary (no
hashes), and a worker keeps the codes of recent ones, in two generations of
bounded size. Texts longer than a block are cut between units, so memory
does not grow with a text unless one unit does.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from .bytewords import NONSPACE, text_slices

#: Bytes of texts handled at once, and units that a generation keeps.
BLOCK_BYTES, KEPT_UNITS = 4 << 20, 200_000
#: Units longer than this are coded but not kept.
KEPT_BYTES = 64


class Cache:
    """Values of ``code`` per unit; at most two generations are kept."""

    def __init__(self, code: Callable[[list[str]], list], limit: int = 0):
        self.code, self.limit = code, limit or KEPT_UNITS
        self.young: dict[str, object] = {}
        self.old: dict[str, object] = {}

    def values(self, units: list[str]) -> list:
        out = [self.young.get(u) for u in units]
        missing = [i for i, v in enumerate(out) if v is None]
        again = []
        for i in missing:
            v = out[i] = self.old.get(units[i])
            if v is None:
                again.append(i)
        for i, v in zip(again, self.code([units[i] for i in again]) if again else [], strict=True):
            out[i] = v
        for i in missing:
            if len(units[i]) <= KEPT_BYTES:
                if len(self.young) >= self.limit:
                    self.old, self.young = self.young, {}
                self.young[units[i]] = out[i]
        return out


def blocks(col: pa.Array, cut: Callable[[np.ndarray], np.ndarray], max_bytes: int = 0) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, bool]]:
    """``(first row, last row + 1, bytes, offsets, goes on)``: runs of rows of
    at most ``max_bytes``; a longer text comes in several blocks, cut at the
    last of the places that ``cut`` finds in a window, the last with ``goes
    on`` false."""
    max_bytes = max_bytes or BLOCK_BYTES
    for lo, hi, data, offsets in text_slices(col, max_bytes):
        if len(data) <= max_bytes:
            yield lo, hi, data, offsets, False
            continue
        at, size = 0, len(data)
        while size - at > max_bytes:
            reach, end = max_bytes, 0
            while not end and at + reach < size:
                # a place is judged by its neighbours, so the window's edges are not
                places = cut(data[at:at + reach])
                places = places[(places > 3) & (places < reach - 3)]
                end = int(places[-1]) if len(places) else 0
                reach *= 2
            if not end:
                break
            yield lo, hi, data[at:at + end], np.array([0, end]), True
            at += end
        yield lo, hi, data[at:], np.array([0, size - at]), False


def distinct(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, list[str]]:
    """Per unit the place of its text among the distinct ones."""
    arr = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data)))
    coded = arr.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.to_pylist()


# ------------------------------------------------------------ words by white space
def spaces(data: np.ndarray) -> np.ndarray:
    return np.flatnonzero(~NONSPACE[data])


_LETTER, _STOP = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_STOP[list(b".,;:!?")] = True


def words(data: np.ndarray, offsets: np.ndarray, stops: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes that are no ASCII white space: offsets and bytes without
    the gaps, and the range of units of each text. With ``stops`` a sign of
    ``.,;:!?`` behind an ASCII letter starts a unit of its own."""
    inside = NONSPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    if stops:
        begins[1:] |= _STOP[data[1:]] & _LETTER[data[:-1]]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins[edges] = inside[edges]
    start = np.flatnonzero(begins)
    kept = np.zeros(len(data) + 1, np.int64)
    np.cumsum(inside, out=kept[1:])
    return np.append(kept[start], kept[-1]), data[inside], np.searchsorted(start, offsets)


# ------------------------------------------------------------ single spaces
_PLAIN = np.ones(256, bool)  # bytes that no white space character starts with
_PLAIN[[*range(0x09, 0x0E), *range(0x1C, 0x21), 0xC2, 0xE1, 0xE2, 0xE3]] = False


def single_spaces(data: np.ndarray) -> np.ndarray:
    """Places of spaces between characters that are certainly no white space
    (nor the sign that stands for a space in pieces, U+2581)."""
    at = np.flatnonzero(data == 0x20)
    at = at[(at > 0) & (at < len(data) - 1)]
    before = data[at - 1]
    ok = _PLAIN[data[at + 1]] & np.where(before < 0x80, _PLAIN[before], (data[np.maximum(at - 2, 0)] != 0xC2) & ~np.isin(data[np.maximum(at - 3, 0)], (0xE1, 0xE2, 0xE3)))
    return at[ok]


def spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Units that start at a text's start or at a single space: offsets, and
    the range of units of each text (none of an empty text)."""
    filled = offsets[:-1][np.diff(offsets) > 0]
    inner = single_spaces(data)
    last = np.zeros(len(data) + 1, bool)
    last[offsets[1:] - 1] = True  # a space that ends a text goes with what is before
    last[-1] = False
    inner = inner[~last[inner]]
    start = np.union1d(filled, inner)
    return np.append(start, len(data)), np.searchsorted(start, offsets)


def ragged(values: np.ndarray, first: np.ndarray, pick: np.ndarray) -> np.ndarray:
    """``values[first[i]:first[i + 1]]`` for every ``i`` of ``pick``, joined."""
    size = first[pick + 1] - first[pick]
    ends = np.cumsum(size)
    return values[np.repeat(first[pick] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
