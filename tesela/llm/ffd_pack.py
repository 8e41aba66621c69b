"""Packing documents into sequences: first-fit decreasing in random groups.

A document is its token ids and an end id. It is cut into pieces of the full
capacity and a rest; a full piece is a sequence by itself. Rests are dealt
to random groups of bounded size, and each group is packed by itself: rests
in falling length, each into the first bin that still holds it, which a
tournament tree over the bins' free room finds in logarithmic time.

The tokenizer lower-cases, drops white space and its pieces cross neither
that nor the place between a letter and a stop, so words and stops are coded
one by one (:mod:`units`); a test holds that against whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import units
from .util import fresh

CAPACITY, END = 4096, 2
TOKENIZER = "word_bpe_49k.json"
#: Bytes of text that a group holds, about: some thousand documents.
GROUP_BYTES = 8 << 20
#: Names of the columns added by :func:`pack`.
ADDED = ("start", "length", "ids", "doc_tokens", "sequence_id", "offset")
_MARK = "\x01"
#: Words that a worker keeps (in each of two generations).
KEPT_WORDS = 400_000
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


@cache
def _word_codes(path: str) -> units.Cache:
    """Codes (little-endian unsigned 32-bit ids) of words without white
    space, kept by the worker. Many words are coded as one text, with the
    mark's single id between them; words holding the mark go alone."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)

    def ids(texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    (mark,) = ids([_MARK])
    joinable = len(mark) == 1

    def code(words: list[str]) -> list[bytes]:
        out: list = [None] * len(words)
        plain = [i for i, w in enumerate(words) if joinable and _MARK not in w]
        for lo in range(0, len(plain), 512):
            part = plain[lo:lo + 512]
            (got,) = ids([f" {_MARK} ".join(words[i] for i in part)])
            at = np.flatnonzero(got == mark[0])
            if len(at) != len(part) - 1:
                continue
            for i, a, b in zip(part, [0, *(at + 1)], [*at, len(got)], strict=True):
                out[i] = got[a:b].tobytes()
        alone = [i for i, v in enumerate(out) if v is None]
        for i, v in zip(alone, ids([words[i] for i in alone]) if alone else [], strict=True):
            out[i] = v.tobytes()
        return out

    return units.Cache(code, KEPT_WORDS)


def token_ids(col: pa.Array, path: str, block: int = 0) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, bool]]:
    """``(first row, last row + 1, ids, ranges, goes on)`` in blocks."""
    codes = _word_codes(path)
    for lo, hi, data, offsets, more in units.blocks(col, units.spaces, block):
        # special tokens are found before lower-casing, in any block that may hold one
        low = data if b"<|" in data.tobytes() else _LOWER[data]
        at, kept, first = units.words(low, offsets, stops=True)
        place, found = units.distinct(at, kept)
        coded = codes.values(found)
        flat = np.frombuffer(b"".join(coded), "<u4")
        size = np.fromiter((len(c) >> 2 for c in coded), np.int64, len(coded))
        start = np.concatenate(([0], np.cumsum(size)))
        ends = np.concatenate(([0], np.cumsum(size[place])))
        yield lo, hi, units.ragged(flat, start, place), ends[first], more


def _pieces(path: str, capacity: int, end: int, place: int, names: list[str]):
    """Batches with one row per piece: the other columns, and ``start,
    length, ids, doc_tokens``."""
    block = units.BLOCK_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column(place)
            carried, before = np.zeros(0, "<u4"), 0  # of a text that goes on
            held: list[tuple[int, int, np.ndarray]] = []
            for lo, hi, ids, first, more in token_ids(col, path, block):
                rows: list[tuple[int, int, np.ndarray, int]] = []
                for row in range(lo, hi):
                    mine = ids[first[row - lo]:first[row - lo + 1]]
                    if len(carried) or more:
                        mine = np.concatenate([carried, mine])
                    if more:
                        full = len(mine) - len(mine) % capacity
                        held += [(before + k, capacity, mine[k:k + capacity]) for k in range(0, full, capacity)]
                        carried, before = mine[full:], before + full
                        continue
                    mine = np.append(mine, np.uint32(end)).astype("<u4")
                    total = before + len(mine)
                    rows += [(row, s, x, total) for s, _, x in held]
                    rows += [(row, before + k, mine[k:k + capacity], total) for k in range(0, len(mine), capacity)]
                    carried, before, held = np.zeros(0, "<u4"), 0, []
                for k in range(0, len(rows), 1024):
                    yield _batch(batch, place, rows[k:k + 1024], names)
    return run


def _batch(batch: pa.RecordBatch, place: int, rows: list, names: list[str]) -> pa.RecordBatch:
    kept = batch.take(pa.array([r[0] for r in rows], pa.int64()))
    cols = [pa.array([r[1] for r in rows], pa.int64()), pa.array([len(r[2]) for r in rows], pa.int64()),
            pa.array([r[2].tobytes() for r in rows], pa.binary()), pa.array([r[3] for r in rows], pa.int64())]
    return pa.RecordBatch.from_arrays([*(kept.column(i) for i in range(place)), *cols], names=[*batch.schema.names[:place], *names])


class Bins:
    """Free room of bins in a tournament tree: a node holds the most free
    room below it, so the first bin with enough of it is found from the top."""

    def __init__(self, most: int, capacity: int):
        self.leaves = 1 << max(most - 1, 0).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def put(self, size: int) -> tuple[int, int]:
        """Bin that takes ``size`` first, and the room it had."""
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < size:
                node += 1
        had = room[node]
        room[node] = had - size
        leaf = node - self.leaves
        while node > 1:
            node //= 2
            most = max(room[2 * node], room[2 * node + 1])
            if room[node] == most:
                break
            room[node] = most
        return leaf, had


def first_fit(sizes: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of every size (taken in the given order)."""
    bins, where, at = Bins(len(sizes), capacity), [], []
    for size in sizes:
        leaf, had = bins.put(size)
        where.append(leaf)
        at.append(capacity - had)
    return where, at


def _packed(capacity: int, names: dict[str, str]):
    def pack_group(group: pa.Table) -> pa.Table:
        size = group[names["length"]].to_numpy()
        order = np.lexsort((group[names["start"]].to_numpy(), group[names["key"]].to_numpy(), -size))
        where, at = first_fit(size[order].tolist(), capacity)
        sequence, offset = np.empty(len(size), np.int64), np.empty(len(size), np.int64)
        sequence[order], offset[order] = where, at
        sequence += int(group[names["group"]][0].as_py()) << 32
        out = group.drop_columns([names["group"], names["key"]])
        return out.append_column(names["sequence_id"], pa.array(sequence)).append_column(names["offset"], pa.array(offset))
    return pack_group


def pack(docs: DataFrame, path: str, text: str = "text", capacity: int = CAPACITY, end: int = END, group_bytes: int = GROUP_BYTES, prefix: str = "") -> DataFrame:
    """One row per piece of every row of ``docs``: its columns without the
    text, and ``start``, ``length``, ``ids`` (little-endian unsigned 32-bit),
    ``doc_tokens``, ``sequence_id`` and ``offset``.

    Null and empty texts, and texts of white space, are the end id alone.
    Repeated rows and null ids are packed as documents of their own. A
    clashing column of the input is replaced; give a ``prefix`` to keep it.
    An empty table gives no rows. ``path`` is the tokenizer's file, on every
    worker. The mix of documents in a group is random but fixed by their
    rows and texts, so reruns agree while Spark's order of equal rows does.
    """
    names = {n: prefix + n for n in ADDED}
    if any(n in names.values() for n in docs.columns):
        docs = docs.drop(*[n for n in docs.columns if n in names.values()])
    names["key"], names["group"] = fresh(docs, "piece_key"), fresh(docs, "piece_group")
    inner = fresh(docs, "text_to_pack")
    kept = [c for c in docs.columns if c != text]
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    held = docs.agg(F.sum(F.octet_length(body)).alias("b"), F.count(F.lit(1)).alias("n")).first()
    # a document costs its end id and its row besides its text
    groups = max(1, -(-((held["b"] or 0) + 16 * held["n"]) // group_bytes))
    src = docs.select(*kept, F.xxhash64(*kept, body).alias(names["key"]), body.alias(inner))
    made = [names[n] for n in ("start", "length", "ids", "doc_tokens")]
    schema = T.StructType([*src.schema.fields[:-1], *(T.StructField(n, T.BinaryType() if n == names["ids"] else T.LongType()) for n in made)])
    pieces = src.mapInArrow(_pieces(path, capacity, end, len(kept) + 1, made), schema)
    dealt = pieces.withColumn(names["group"], F.pmod(F.xxhash64(names["key"], names["start"]), F.lit(groups)).cast("long"))
    out = T.StructType([*(f for f in schema if f.name != names["key"]), T.StructField(names["sequence_id"], T.LongType()), T.StructField(names["offset"], T.LongType())])
    return dealt.groupBy(names["group"]).applyInArrow(_packed(capacity, names), out)


def sequences(pieces: DataFrame, prefix: str = "") -> DataFrame:
    """``(sequence_id, used, ids, doc_starts)``: every sequence's ids joined,
    and the offsets at which its pieces start. A sequence holds at most the
    capacity, so a group is bounded."""
    s, o, i, n = (prefix + x for x in ("sequence_id", "offset", "ids", "length"))
    parts = F.array_sort(F.collect_list(F.struct(F.col(o).alias("o"), F.col(i).alias("i"))))
    joined = F.aggregate("parts", F.lit(b""), lambda acc, p: F.concat(acc, p["i"]))
    return pieces.groupBy(F.col(s).alias("sequence_id")).agg(F.sum(n).alias("used"), parts.alias("parts")).select("sequence_id", "used", joined.alias("ids"), F.transform("parts", lambda p: p["o"]).alias("doc_starts"))


def padding(used: int, capacity: int = CAPACITY) -> int:
    """Padding of a sequence of ``used`` ids: none at a power of two."""
    return 0 if used & (used - 1) == 0 else capacity - used
