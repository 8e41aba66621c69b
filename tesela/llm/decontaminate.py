"""Benchmark decontamination with a generalised suffix automaton.

The automaton is built over the normalised words of the test items (word
numbers as letters). Tasks stream each text's words through it and track the
longest match that ends at each word: a match of ``window`` words or more
ends in a window of some item, and a match that ends in the whole of a
shorter item is that item's window. Words inside such matches are hit.

Only stretches whose neighbouring words stand side by side in some item, and
which are as long as the shortest window, are streamed; no match can lie
elsewhere, so that is exact.

Items are cut into blocks of bounded words (a longer item into pieces that
overlap by a window less one word), one automaton each, kept in the shared
folder; workers hold one at a time, so memory does not grow with the items.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import runs, shared
from .bytewords import ALNUM, U64, split_words, text_slices
from .util import with_text

WINDOW = 13
COVERAGE = 20  # contaminated if hits * COVERAGE >= words
BLOCK_WORDS = 100_000
BYTES_PER_WORD = 6  # with its gap, roughly: how many tasks build blocks


class Automaton:
    """Suffix automaton of several word sequences, with the items of each
    window and the short items that end in each state."""

    def __init__(self, items: list[tuple[str | None, np.ndarray]], window: int):
        self.window = window
        self.vocabulary = np.unique(np.concatenate([h for _, h in items])) if items else np.zeros(0, U64)
        coded = [(name, np.searchsorted(self.vocabulary, h).tolist()) for name, h in items]
        size = len(self.vocabulary)
        pairs = [a * size + b for _, ids in coded for a, b in zip(ids, ids[1:], strict=False)]
        self.pairs = np.unique(np.array(pairs, np.int64))
        self.shortest = min((min(len(ids), window) for _, ids in coded), default=window)
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, ids in coded:
            state = 0
            for c in ids:
                state = self._extend(state, c)
        self._mark(coded)

    def _state(self, length: int, nxt: dict[int, int], link: int) -> int:
        self.next.append(nxt)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p: int, q: int, c: int) -> int:
        """The state of p's longest string plus ``c``, split off from q."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:  # another item went on like this
            return self._split(last, self.next[last][c], c)
        new = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, self.next[p][c], c)
        return new

    def _mark(self, coded) -> None:
        n, window = len(self.next), self.window
        items: list[set[str | None]] = [set() for _ in range(n)]
        short: list[list[tuple[int, str | None]]] = [[] for _ in range(n)]
        for name, ids in coded:
            # states may have been split after an item was added, so each item is walked again
            state = 0
            for c in ids:
                state = self.next[state][c]
                v = state
                while v > 0 and self.length[v] >= window and name not in items[v]:
                    items[v].add(name)
                    v = self.link[v]
            if 0 < len(ids) < window:
                short[state].append((len(ids), name))
        self.items: list[tuple] = [()] * n
        self.short: list[tuple] = [()] * n
        self.at_window = [-1] * n
        for v in sorted(range(1, n), key=self.length.__getitem__):
            up = self.link[v]
            self.short[v] = tuple(short[v]) + self.short[up] if up > 0 else tuple(short[v])
            if self.length[v] >= window:
                self.at_window[v] = v if self.length[up] < window else self.at_window[up]
                if self.at_window[v] == v:
                    self.items[v] = tuple(items[v])

    def scan(self, hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, tuple]]:
        """``(first word, last word + 1, items)`` of every match."""
        if not len(self.vocabulary) or not len(hashes):
            return
        ids, known = runs.find(self.vocabulary, hashes)
        joined = np.zeros(len(ids), bool)  # word i goes on from word i - 1
        joined[1:] = known[1:] & known[:-1]
        at = first[:-1]
        joined[at[at < len(ids)]] = False
        go = np.flatnonzero(joined)
        if len(go):
            joined[go] = runs.find(self.pairs, ids[go - 1].astype(np.int64) * len(self.vocabulary) + ids[go])[1]
        heads = np.flatnonzero(known & ~joined)
        tails = np.flatnonzero(known & ~np.append(joined[1:], False)) + 1
        for a, b in zip(heads, tails, strict=True):
            if b - a >= self.shortest:
                yield from self._stream(ids[a:b].tolist(), int(a))

    def _stream(self, ids: list[int], offset: int) -> Iterator[tuple[int, int, tuple]]:
        nxt, link, length, short, at_window = self.next, self.link, self.length, self.short, self.at_window
        v = matched = 0
        for i, c in enumerate(ids, offset + 1):
            while v and c not in nxt[v]:
                v = link[v]
                matched = length[v]
            if c in nxt[v]:
                v = nxt[v][c]
                matched += 1
            else:
                matched = 0
                continue
            if matched >= self.window:
                yield i - self.window, i, self.items[at_window[v]]
            for n, name in short[v]:
                if matched >= n:
                    yield i - n, i, (name,)


def _build_blocks(folder: str, window: int, block_words: int):
    def build_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        names: list[str] = []
        block: list[tuple[str | None, np.ndarray]] = []
        words = 0
        step = max(block_words - window + 1, 1)

        def flush() -> None:
            # the attempt is part of the name: a name that is returned is of a whole file
            names.append(f"automaton-{task.partitionId()}-{task.taskAttemptId()}-{len(names)}")
            shared.put(f"{folder}/{names[-1]}", pickle.dumps(Automaton(block, window), protocol=5))

        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = np.frombuffer(text.encode(), np.uint8)
                h = split_words(raw, np.array([0, len(raw)]), ALNUM).hash
                for piece in [h] if len(h) <= block_words else [h[a:a + block_words] for a in range(0, len(h) - window + 1, step)]:
                    if len(piece):
                        block.append((item, piece))
                        words += len(piece)
                    if words >= block_words:
                        flush()
                        block, words = [], 0
        if block:
            flush()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], names=["name"])
    return build_blocks


def build(items: DataFrame, text: str, item_id: str, window: int, block_words: int) -> tuple[str, list[str]]:
    """Write the automata of all items to the shared folder: folder, names.

    Tasks build them, about one block of words each, from the items as the
    table deals them; only the names of the files reach the driver.
    """
    folder = shared.new_folder(items.sparkSession, "automata")
    rows = items.select(F.col(item_id).cast("string").alias("item"), F.col(text).cast("string").alias("text")).where("text is not null")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    few = rows.coalesce(max(-(-size // (BYTES_PER_WORD * block_words)), 1))
    return folder, sorted(r["name"] for r in few.mapInArrow(_build_blocks(folder, window, block_words), "name string").collect())


_loaded: dict[str, Automaton] = {}


def _automaton(uri: str) -> Automaton:
    if uri not in _loaded:
        _loaded.clear()
        fs, path = shared.filesystem(uri)
        with fs.open_input_stream(path) as f:
            _loaded[uri] = pickle.loads(f.read())
    return _loaded[uri]


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text", item_id: str = "item_id",
                  window: int = WINDOW, prefix: str = "") -> DataFrame:
    """All rows and columns of ``docs`` and ``n_words``, ``n_hit``,
    ``items`` (ids as strings, sorted) and ``clean_text``: the text without
    the spans of hit words (the text itself where nothing is hit).

    Null texts have no words (their ``clean_text`` is null); items without
    words have no windows. Rows that share an item id are one item; the
    words of an item with a null id are hit, but it is not listed. Repeated
    documents are judged one by one. An empty items table hits nothing. A
    clashing input column is replaced; give a ``prefix`` to keep it.
    """
    folder, automata = build(items, item_text, item_id, window, BLOCK_WORDS)
    names = [prefix + x for x in ("n_words", "n_hit", "items", "clean_text")]
    kept = [c for c in docs.columns if c not in names]
    src, at = with_text(docs, kept, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at)
            hits: dict[int, tuple[list, set]] = {}
            words = np.zeros(batch.num_rows, np.int64)
            for name in automata or [None]:  # the outer loop, so each automaton is loaded once per batch
                for lo, hi, data, offsets in text_slices(column, 2 << 20):
                    w = split_words(data, offsets, ALNUM)
                    words[lo:hi] = w.counts()
                    if name is None:
                        continue
                    for a, b, found in _automaton(f"{folder}/{name}").scan(w.hash, w.first):
                        i = int(np.searchsorted(w.first, a, "right")) - 1
                        spans, names_hit = hits.setdefault(lo + i, ([], set()))
                        spans.append((a - int(w.first[i]), b - int(w.first[i])))
                        names_hit.update(x for x in found if x is not None)
            n_hit = np.zeros(batch.num_rows, np.int64)
            listed: list[list[str]] = [[] for _ in range(batch.num_rows)]
            clean = column
            if hits:
                clean = column.to_pylist()
                for row, (spans, found) in hits.items():
                    raw = clean[row].encode()
                    one = split_words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), ALNUM, hashed=False)
                    cover = np.zeros(len(one.start) + 1, np.int64)
                    for a, b in set(spans):
                        cover[a] += 1
                        cover[b] -= 1
                    inside = np.cumsum(cover)[:-1] > 0
                    n_hit[row] = inside.sum()
                    listed[row] = sorted(found)
                    edge = np.diff(np.concatenate(([0], inside.astype(np.int8), [0])))
                    parts, last = [], 0
                    for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True):
                        parts.append(raw[last:one.start[a]])
                        last = int(one.end[b - 1])
                    clean[row] = b"".join([*parts, raw[last:]]).decode()
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(kept))), pa.array(words), pa.array(n_hit),
                                              pa.array(listed, pa.list_(pa.string())), clean if clean is column else pa.array(clean, pa.string())], names=[*kept, *names])

    kinds = (T.LongType(), T.LongType(), T.ArrayType(T.StringType()), T.StringType())
    return src.mapInArrow(run, T.StructType([*(src.schema[c] for c in kept), *(T.StructField(x, t) for x, t in zip(names, kinds, strict=True))]))


def contaminated(n_hit: str = "n_hit", n_words: str = "n_words", coverage: int = COVERAGE):
    return (F.col(n_hit) > 0) & (F.lit(coverage) * F.col(n_hit) >= F.col(n_words))

