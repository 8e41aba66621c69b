"""Aligning the tokens of two tokenizers over the same texts.

Texts are shuffled by their full text, so that each distinct one is coded
and aligned once, whatever its number of copies. Byte offsets where tokens
of both end cut a text into groups; tokens of A and B whose byte ranges
overlap are linked. Links are counted per pair of ids over the corpus, each
text weighted by its copies, and the measures go back to the documents.

Both tokenizers treat the stretches between single spaces alone (a byte-level
pattern takes one space with what follows; no piece holds a space after
another sign), so stretches are coded and aligned once per worker
(:mod:`units`); a test holds that against whole texts.

Texts are handled in portions. A portion's links are kept as sorted entries
``(pair, text, times)`` per shard of B's ids; counts per pair come from them
in two rounds of merging, one sorted file per shard. To look counts up,
entries are dealt by shard and portion, so a task holds a few shards' counts
at a time and one token found in every text is no hot spot.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import runs, shared, totals, units
from .bytewords import U64, mix, release
from .util import fresh

TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Link entries of a portion.
PORTION = 1_500_000
#: Texts with more than one in so many of the rows are broadcast (so many texts at most).
HOT_SHARE = 512
LOW32 = U64(0xFFFFFFFF)
MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
_ROW = "kind int, portion long, text int, text_key string, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string"
LINKED = f"{_ROW}, shard int, n long, keys binary, totals binary, times binary, texts binary, counts binary"


# ------------------------------------------------------------ tokenizers
def byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for:
    printable ones stand for themselves, others for the next free signs."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def align(a_size: np.ndarray, b_size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Two rows of tokens over the same bytes: the group of each token of
    both, and the places of the tokens of every link.

    Groups end where tokens of both end. Each end of a token of either row
    closes one pair of overlapping tokens: those that hold the byte before.
    """
    a_end, b_end = np.cumsum(a_size), np.cumsum(b_size)
    cuts, ends = np.intersect1d(a_end, b_end, assume_unique=True), np.union1d(a_end, b_end)
    return np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end), np.searchsorted(a_end, ends), np.searchsorted(b_end, ends)


class Decimals:
    """Ids as text, each with the sign that follows it."""

    def __init__(self, most: int):
        names = [str(i).encode() for i in range(most + 1)]
        self.size = np.array([len(n) for n in names])
        self.width = int(self.size.max()) + 1
        self.signs = np.frombuffer(b"".join(n.ljust(self.width) for n in names), np.uint8).reshape(-1, self.width)

    def text(self, ids: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes, and where each id's text ends."""
        size = self.size[ids]
        out = self.signs[ids]
        out[np.arange(len(ids)), size] = after
        return out[np.arange(self.width) <= size[:, None]], np.cumsum(size + 1)


def groups_text(a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray, decimals: Decimals) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3;`` as bytes, and where the text of each group ends."""
    side = np.concatenate([2 * of_a, 2 * of_b + 1])
    order = np.argsort(side, kind="stable")
    ids, side = np.concatenate([a, b])[order], side[order]
    last = np.concatenate([side[1:] != side[:-1], [True]])
    after = np.where(last, np.where(side & 1, ord(";"), ord("|")), ord(",")).astype(np.uint8)
    text, ends = decimals.text(ids, after)
    return text, ends[last & (side & 1 == 1)]


class Pieces:
    """Bytes of every id of a tokenizer."""

    def __init__(self, pieces: list[bytes]):
        self.size = np.array([len(p) for p in pieces], np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.size)))
        self.data = np.frombuffer(b"".join(pieces), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return units.ragged(self.data, self.first, ids)


#: A unit's value: numbers of tokens of A and B, groups and links (four
#: 32-bit integers), its groups as text and its links' keys (B's id in the
#: high half); the text is None where a tokenizer's bytes are not the unit's.
Unit = tuple[bytes, bytes | None, bytes]
_FAILED: Unit = (bytes(16), None, b"")


def _flat(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    size = np.fromiter(map(len, rows), np.int64, len(rows))
    return np.fromiter(chain.from_iterable(rows), np.int64, int(size.sum())), size


def _per_unit(values: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(values)))[np.concatenate(([0], np.cumsum(size)))])


def _aligned(raw: list[bytes], a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray, in_a: Pieces, in_b: Pieces, decimals: Decimals) -> list[Unit]:
    """Values of units with tokens ``a`` and ``b``, some of each per unit."""
    length = np.fromiter(map(len, raw), np.int64, len(raw))
    good = (_per_unit(in_a.size[a], n_a) == length) & (_per_unit(in_b.size[b], n_b) == length) & (length > 0)
    kept = np.flatnonzero(good)  # sizes agree; do the bytes?
    a, b, n_a, n_b, length = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)], n_a[good], n_b[good], length[good]
    whole = np.frombuffer(b"".join(raw[k] for k in kept), np.uint8)
    same = _per_unit((in_a.joined(a) != whole) | (in_b.joined(b) != whole), length) == 0
    kept, a, b, n_a, n_b = kept[same], a[np.repeat(same, n_a)], b[np.repeat(same, n_b)], n_a[same], n_b[same]
    out = [_FAILED] * len(raw)
    if not len(kept):
        return out
    of_a, of_b, i, j = align(in_a.size[a], in_b.size[b])
    text, text_end = groups_text(a, b, of_a, of_b, decimals)
    keys = ((b[j].astype(U64) << U64(32)) | a[i].astype(U64)).astype("<u8").tobytes()
    a_last, b_last = np.cumsum(n_a) - 1, np.cumsum(n_b) - 1
    groups = of_a[a_last] + 1  # groups up to a unit's end
    links = np.searchsorted(i, a_last, "right")  # links up to the last one of its last token
    sizes = np.stack([n_a, n_b, np.diff(groups, prepend=0), np.diff(links, prepend=0)], axis=1).astype("<i4").tobytes()
    text, at = text.tobytes(), 0
    for k, (unit, end, x, y) in enumerate(zip(kept.tolist(), text_end[groups - 1].tolist(), [0, *links[:-1].tolist()], links.tolist(), strict=True)):
        out[unit] = (sizes[16 * k:16 * k + 16], text[at:end - 1], keys[8 * x:8 * y])
        at = end
    return out


@cache
def _unit_codes(path_a: str, path_b: str) -> units.Cache:
    import sentencepiece
    from tokenizers import Tokenizer

    tok_a = Tokenizer.from_file(path_a)
    tok_a.encode_special_tokens = True
    tok_b = sentencepiece.SentencePieceProcessor(model_file=path_b)
    of_sign = byte_level()
    names = {i: t for t, i in tok_a.get_vocab().items()}
    in_a = Pieces([bytes(of_sign[c] for c in t) if all(c in of_sign for c in t) else t.encode() for t in (names.get(i, "") for i in range(max(names) + 1))])
    in_b = Pieces([bytes([int(p[3:5], 16)]) if tok_b.is_byte(i) else p.replace("▁", " ").encode()
                   for i, p in enumerate(tok_b.id_to_piece(list(range(tok_b.get_piece_size()))))])
    decimals = Decimals(max(len(in_a.size), len(in_b.size)))

    def code(texts: list[str]) -> list[Unit]:
        out = []
        for lo in range(0, len(texts), 8192):
            part = texts[lo:lo + 8192]
            a, n_a = _flat([e.ids for e in tok_a.encode_batch_fast(part, add_special_tokens=False)])
            b, n_b = _flat(tok_b.encode([t[1:] for t in part], num_threads=1))
            out += _aligned([t.encode() for t in part], a, n_a, b, n_b, in_a, in_b, decimals)
        return out

    return units.Cache(code)


# ------------------------------------------------------------ texts to links
class _Portion:
    """Entries ``(text, pair, times)`` and rows of a portion's texts."""

    def __init__(self, shards: int, task: int, keep: bool):
        self.shards, self.task, self.keep, self.number = shards, task, keep, 0
        self.start()

    def start(self) -> None:
        self.id = (self.task << 32) | self.number
        self.number += 1
        self.rows: list[tuple] = []
        self.entries: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.copies: list[int] = []
        self.size = 0

    def link(self, text: np.ndarray, keys: np.ndarray) -> None:
        """Links of texts, by number in the portion and pair."""
        if not len(keys):
            return
        distinct, code = np.unique(keys, return_inverse=True)
        both, times = np.unique((text.astype(U64) << U64(32)) | code.astype(U64), return_counts=True)
        self.entries.append(((both >> U64(32)).astype(np.uint32), distinct[(both & LOW32).astype(np.int64)], times.astype(np.uint32)))
        self.size += len(both)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            cols = list(zip(*self.rows, strict=True))
            yield _row_batch({"kind": [0] * len(self.rows), "portion": [self.id] * len(self.rows), "text": range(len(self.rows)), **dict(zip(_TEXT_COLUMNS, cols, strict=True))})
        if self.entries:
            text, keys, times = (np.concatenate(x) for x in zip(*self.entries, strict=True))
            # a text in several blocks gave a pair several entries
            shard = runs.shard_of(mix((keys >> U64(32)) + U64(1)), self.shards)
            order = np.lexsort((text, keys, shard))
            text, keys, times, shard = text[order], keys[order], times[order], shard[order]
            weight = np.array(self.copies, np.int64)[text] * times
            for s, a, b in runs.by_shard(shard):
                first = np.flatnonzero(np.concatenate(([True], keys[a + 1:b] != keys[a:b - 1])))
                blobs = {"keys": runs.pack_sorted(keys[a:b][first]), "totals": runs.pack(np.add.reduceat(weight[a:b], first)),
                         "times": runs.pack(np.diff(first, append=b - a).astype(np.uint32)), "texts": runs.pack(text[a:b]), "counts": runs.pack(times[a:b])}
                yield _row_batch({"kind": [1], "portion": [self.id], "shard": [s], "n": [len(first)], **{k: [v] for k, v in blobs.items()}})
        self.start()
        release()


_TEXT_COLUMNS = ("text_key", "copies", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups")
_TYPES = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
_LINKED_ARROW = pa.schema([(n, _TYPES[t]) for n, t in (c.split() for c in LINKED.split(", "))])


def _row_batch(cols: dict) -> pa.RecordBatch:
    n = len(cols["kind"])
    return pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) if f.name in cols else pa.nulls(n, f.type) for f in _LINKED_ARROW], schema=_LINKED_ARROW)


def _coded(codes: units.Cache, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[Unit]]:
    at, first = units.spaced(data, offsets)
    place, found = units.distinct(at, data)
    return place, first, codes.values(found)


def _link_texts(path_a: str, path_b: str, shards: int, keep: bool):
    """Rows of :data:`LINKED` of texts that each start with a space."""
    block, most = units.BLOCK_BYTES, PORTION

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _unit_codes(path_a, path_b)
        portion = _Portion(shards, TaskContext.get().partitionId(), keep)
        for batch in batches:
            col, keys, copies = batch.column("text"), batch.column("text_key"), batch.column("copies")
            judged, fails, whole, sums = -1, False, None, None
            for lo, hi, data, offsets, more in units.blocks(col, units.single_spaces, block):
                if more and judged != lo:  # a long text: whether any part fails, before its links count
                    judged, whole, sums = lo, hashlib.sha256(), np.zeros(4, np.int64)
                    fails = any(u[1] is None for _, _, d, o, _ in units.blocks(col.slice(lo, 1), units.single_spaces, block) for u in _coded(codes, d, o)[2])
                    parts: list[bytes] = []
                place, first, found = _coded(codes, data, offsets)
                sizes = np.frombuffer(b"".join(u[0] for u in found), "<i4").astype(np.int64).reshape(-1, 4)
                bad = np.array([u[1] is None for u in found], bool)
                links = np.frombuffer(b"".join(u[2] for u in found), "<u8")
                ends = np.concatenate(([0], np.cumsum(sizes[:, 3])))
                texts = [u[1] or b"" for u in found]
                long = judged == lo
                taken: list[tuple[int, int, int]] = []  # number in the portion, range of units
                for row in range(lo, hi):
                    a, b = first[row - lo], first[row - lo + 1]
                    mine = place[a:b]
                    here = fails if long else bool(bad[mine].any())
                    number = len(portion.rows)
                    if not here:
                        taken.append((number, a, b))
                        text = b";".join(map(texts.__getitem__, mine.tolist()))
                        total = sizes[mine].sum(axis=0)
                        if long:
                            whole.update((b";" if sums[2] else b"") + text)
                            sums += total
                            if keep:
                                parts.append(text)
                            total, digest = sums, whole
                            text = b";".join(parts) if keep else b""
                        else:
                            digest = hashlib.sha256(text)
                        measures = (*map(int, total), digest.hexdigest(), text.decode() if keep else None)
                    else:
                        measures = (0, 0, 0, 0, "", "" if keep else None)
                    if len(portion.copies) == number:
                        portion.copies.append(copies[row].as_py())
                    if not more:
                        portion.rows.append((keys[row].as_py(), copies[row].as_py(), *measures))
                if taken:
                    pick = np.concatenate([place[a:b] for _, a, b in taken])
                    of = np.repeat([n for n, _, _ in taken], [b - a for _, a, b in taken])
                    portion.link(np.repeat(of, sizes[pick, 3]), units.ragged(links, ends, pick))
                if not more and portion.size >= most:
                    yield from portion.flush()
        yield from portion.flush()
    return run


# ------------------------------------------------------------ counts per pair
def _store(folder: str):
    """Sorted pairs of a shard, their counts, and whether a count is the
    highest of its B id (whose pairs are all in the shard)."""
    def store(shard: int, keys: np.ndarray, counts: np.ndarray) -> pa.Table:
        b = keys >> U64(32)
        first = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1])))
        best = np.repeat(np.maximum.reduceat(counts, first), np.diff(first, append=len(b)))
        shared.put(f"{folder}/pairs-{shard}", keys)
        shared.put(f"{folder}/counts-{shard}", counts)
        shared.put(f"{folder}/best-{shard}", counts == best)
        return pa.table({"shard": pa.array([shard], pa.int32()), "pairs": pa.array([len(keys)], pa.int64())})
    return store


def _read(uri: str, dtype) -> np.ndarray:
    fs, path = shared.filesystem(uri)
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype)


def _shard(folder: str, shard: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return _read(f"{folder}/pairs-{shard}", U64), _read(f"{folder}/counts-{shard}", np.int64), _read(f"{folder}/best-{shard}", np.bool_)


# ------------------------------------------------------------ counts back to texts
LOOKED_UP = "portion long, texts binary, best binary, sums binary"


def _look_up(folder: str):
    """Per row of links the sums of its texts. Rows come ordered by shard, so
    one shard's counts are held at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have, held = -1, None
        for batch in batches:
            out = []
            for r in range(len(batch)):
                shard, n = batch["shard"][r].as_py(), batch["n"][r].as_py()
                if shard != have:
                    have, held = shard, _shard(folder, shard)
                times = runs.unpack(batch["times"][r].as_buffer(), n, np.uint32).astype(np.int64)
                entries = int(times.sum())
                at, _ = runs.find(held[0], runs.unpack_sorted(batch["keys"][r].as_buffer(), n))
                count, best = np.repeat(held[1][at], times), np.repeat(held[2][at], times)
                text, many = (runs.unpack(batch[c][r].as_buffer(), entries, np.uint32).astype(np.int64) for c in ("texts", "counts"))
                order = np.argsort(text, kind="stable")
                text, many, count, best = text[order], many[order], count[order], best[order]
                first = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
                out.append((batch["portion"][r].as_py(), runs.pack(text[first].astype(np.uint32)), runs.pack(np.add.reduceat(many * best, first)), runs.pack(np.add.reduceat(many * count, first))))
            if out:
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), *(pa.array(c, pa.binary()) for c in cols[1:])], names=["portion", "texts", "best", "sums"])
    return run


def _measured(rows: pa.Table, parts: pa.Table) -> pa.Table:
    """Rows of a portion's texts with the sums of all its shards."""
    best, total = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    for t, b, s in zip(*(parts[c] for c in ("texts", "best", "sums")), strict=True):
        n = t.as_buffer().size // 4
        text = runs.unpack(t.as_buffer(), n, np.uint32).astype(np.int64)
        np.add.at(best, text, runs.unpack(b.as_buffer(), n, np.int64))
        np.add.at(total, text, runs.unpack(s.as_buffer(), n, np.int64))
    at = rows["text"].to_numpy()
    cols = {c: rows[c] for c in ("text_key", "copies", "n_a", "n_b", "n_groups", "n_links")}
    return pa.table({**cols, "n_best": best[at], "count_sum": total[at], "groups_sha256": rows["groups_sha256"], "groups": rows["groups"]})


MEASURED = "text_key string, copies long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, groups string"


@dataclass
class Alignment:
    """``texts``: a row of :data:`MEASURED` per distinct text; the counts of
    linked ids lie in ``shards`` files of ``folder``."""

    texts: DataFrame
    folder: str
    shards: list[int]

    def pair_counts(self) -> DataFrame:
        """``(a_id, b_id, links, is_best)`` of every linked pair of ids."""
        folder = self.folder

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for s in batch.column(0).to_pylist():
                    keys, counts, best = _shard(folder, s)
                    for k in range(0, len(keys), 1 << 16):
                        part = keys[k:k + (1 << 16)]
                        yield pa.RecordBatch.from_arrays([pa.array((part & LOW32).astype(np.int64)), pa.array((part >> U64(32)).astype(np.int64)), pa.array(counts[k:k + len(part)]), pa.array(best[k:k + len(part)])], names=["a_id", "b_id", "links", "is_best"])

        spark = self.texts.sparkSession
        return spark.createDataFrame([(s,) for s in self.shards], "shard int").repartition(max(1, len(self.shards) // 4)).mapInArrow(read, "a_id long, b_id long, links long, is_best boolean")


def text_key(text) -> F.Column:
    """Key of a text: null for those without tokens (null and empty)."""
    return F.when(F.length(text) > 0, F.sha2(text.cast("binary"), 256))


def align_texts(docs: DataFrame, path_a: str, path_b: str, text: str = "text", keep_groups: bool = False) -> Alignment:
    """Align every distinct text once and count links over all rows.

    Null and empty texts are left out. A text that a tokenizer does not give
    back byte by byte has no tokens: zeros and an empty digest, and its links
    count nowhere. An empty table gives no texts and no pairs.
    """
    spark = docs.sparkSession
    body = F.col(text).cast("string")
    folder = shared.new_folder(spark, "align")
    texts = docs.select(body.alias("text")).where(F.length("text") > 0)
    shards = min(1024, runs.shards_for(texts.rdd.getNumPartitions()))
    distinct = texts.groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    src = distinct.select(F.concat(F.lit(" "), "text").alias("text"), text_key(F.col("text")).alias("text_key"), "copies")
    path = f"{folder}/linked.parquet"
    src.mapInArrow(_link_texts(path_a, path_b, shards, keep_groups), LINKED).write.option("compression", "zstd").parquet(path)
    linked = spark.read.schema(LINKED).parquet(path)
    links, rows = linked.where("kind = 1"), linked.where("kind = 0").select(*[c.split()[0] for c in _ROW.split(", ")[1:]])

    combined = links.select("shard", "n", "keys", "totals").mapInArrow(totals.combine, totals.SCHEMA)
    stored = totals.shard_totals(combined, _store(folder), "shard int, pairs long", links.rdd.getNumPartitions()).collect()  # one row per shard

    salt = F.pmod(F.xxhash64("portion"), F.lit(max(1, links.rdd.getNumPartitions())))
    dealt = links.select("portion", "shard", "n", "keys", "times", "texts", "counts").repartition(F.col("shard"), salt).sortWithinPartitions("shard")
    sums = dealt.mapInArrow(_look_up(folder), LOOKED_UP)
    measured = rows.groupBy("portion").cogroup(sums.groupBy("portion")).applyInArrow(_measured, MEASURED)
    return Alignment(shared.written(measured, "texts", folder), folder, [r["shard"] for r in stored])


def measure(docs: DataFrame, alignment: Alignment, text: str = "text", prefix: str = "") -> DataFrame:
    """Rows and columns of ``docs`` without the text, and :data:`MEASURES`
    and ``groups_sha256`` of their texts.

    Texts without tokens have zeros and an empty digest. Repeated rows each
    get their measures. A clashing column of the input is replaced; give a
    ``prefix`` to keep it. A text that makes up a large share of the rows is
    joined by broadcast (a bounded number of texts), so no key of the shuffle
    join is hot.
    """
    names = [*MEASURES, "groups_sha256"]
    kept = [c for c in docs.columns if c != text and c not in [prefix + n for n in names]]
    body = F.col(text).cast("string")
    key, hot, spread = (fresh(docs, x) for x in ("text_key", "hot_key", "spread_key"))
    total = alignment.texts.agg(F.sum("copies")).first()[0] or 0
    measures = alignment.texts.select("text_key", "copies", F.struct(*names).alias("m"))
    often = measures.where(F.col("copies") * HOT_SHARE > F.lit(total)).select(F.col("text_key").alias(hot), F.col("m").alias("hot_m"))
    rest = measures.where(F.col("copies") * HOT_SHARE <= F.lit(total)).select(F.col("text_key").alias(spread), F.col("m").alias("rest_m"))
    rows = docs.select(*[F.col(c).alias(f"_{k}") for k, c in enumerate(kept)], text_key(body).alias(key))
    own = [f"_{k}" for k in range(len(kept))]
    joined = rows.join(F.broadcast(often), F.col(key) == F.col(hot), "left")
    settled = F.col(hot).isNotNull() | F.col(key).isNull()
    # rows that need no match are spread by a key that matches nothing
    joined = joined.withColumn(spread, F.when(settled, F.concat(F.lit("-"), F.xxhash64(*own, F.lit(0)).cast("string"))).otherwise(F.col(key)))
    joined = joined.join(rest, spread, "left")
    m = F.coalesce("hot_m", "rest_m")
    out = [F.col(o).alias(c) for o, c in zip(own, kept, strict=True)]
    return joined.select(*out, *[F.coalesce(m[n], F.lit(0)).alias(prefix + n) for n in MEASURES], F.coalesce(m["groups_sha256"], F.lit("")).alias(prefix + "groups_sha256"))
