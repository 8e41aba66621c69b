"""Phrase collocations: direct-address tiles over frequency-ranked ids.

Words that are frequent enough get ids by falling count per language, so
that frequent words have neighbouring ids. A pair of ids falls in a tile of
``SIDE x SIDE`` cells. Tasks count crowded tiles in dense arrays with
``bincount`` and the others as sorted coordinate lists; both go on as sorted
runs, merged per shard of tiles. Frequent pairs are ranked and numbered
again, and a longer phrase is such a number and one more word, counted the
same way; a phrase can only be frequent if both its parts without an end
word are, so nothing else is looked at.

Words are looked up by a 64-bit hash whose seed is changed until no two
words of the table share one, so the counts are exact. Tables that tasks
look ids up in are sorted arrays in files that workers map.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.indexing import dense_index
from . import runs, shared, totals, units
from .bytewords import U64, mix
from .util import join_counted

NO_LANG = "und"
#: A tile's side; occurrences in one block that make a tile dense, and dense tiles at most.
SIDE_BITS = 10
SIDE = 1 << SIDE_BITS
CROWDED, DENSE_TILES = SIDE * SIDE // 32, 6
#: Entries a task gathers before it gives them out, and rows per file of a lookup table.
ENTRIES, FILE_ROWS = 2_000_000, 1_000_000

_STOP = np.zeros(256, bool)
_STOP[list(b".,;:!?\n\v\f\r")] = True
_WORD = ~_STOP
_WORD[[0x20, 0x09]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


# ------------------------------------------------------------ words and pieces
def _gaps(data: np.ndarray) -> np.ndarray:
    return np.flatnonzero(~_WORD[data])


@dataclass
class Block:
    """Words of a block of texts: offsets and bytes without gaps, the row of
    each word, and whether a stop or a text's start lies before it."""

    at: np.ndarray
    data: np.ndarray
    row: np.ndarray
    fresh: np.ndarray
    open_end: bool  # no stop behind the last word, if any
    more: bool


def _blocks(col: pa.Array, size: int) -> Iterator[Block]:
    for lo, hi, data, offsets, more in units.blocks(col, _gaps, size):
        data = _LOWER[data]
        inside = _WORD[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        edges = offsets[:-1][offsets[:-1] < len(data)]
        begins[edges] = inside[edges]
        start = np.flatnonzero(begins)
        kept = np.concatenate(([0], np.cumsum(inside)))
        row = np.searchsorted(offsets, start, "right") - 1
        stops = np.cumsum(_STOP[data])
        seen = stops[start]
        before = np.concatenate(([-1], row[:-1])) if len(row) else row
        fresh = (row != before) | (seen != np.concatenate(([0], seen[:-1]))) if len(row) else np.zeros(0, bool)
        if len(row):
            fresh[0] = seen[0] > 0  # decided by the caller for a text that goes on
        yield Block(np.append(kept[start], kept[-1]), data[inside], row + lo, fresh, not len(stops) or bool(stops[-1] == (seen[-1] if len(row) else 0)), more)


def _by_lang(langs: list[str], block: Block) -> tuple[np.ndarray, list[tuple[str, str]]]:
    """Per word the place of its ``(language, word)`` among the distinct ones."""
    place, found = units.distinct(block.at, block.data)
    names = sorted(set(langs))
    number = {x: k for k, x in enumerate(names)}
    lang = np.array([number[x] for x in langs], np.int64)[block.row]
    both, code = np.unique(lang * max(len(found), 1) + place, return_inverse=True)
    return code, [(names[b // len(found)], found[b % len(found)]) for b in both.tolist()]


def _count_words(block_bytes: int):
    """``(lang, word, f)`` of a task's texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], int] = {}

        def out() -> Iterator[pa.RecordBatch]:
            items = list(held.items())
            held.clear()
            for k in range(0, len(items), 20_000):
                part = items[k:k + 20_000]
                yield pa.RecordBatch.from_pydict({"lang": [x[0][0] for x in part], "word": [x[0][1] for x in part], "f": pa.array([x[1] for x in part], pa.int64())})

        for batch in batches:
            langs = batch.column(0).to_pylist()
            for block in _blocks(batch.column(1), block_bytes):
                if not len(block.row):
                    continue
                code, found = _by_lang(langs, block)
                for w, n in zip(found, np.bincount(code, minlength=len(found)).tolist(), strict=True):
                    held[w] = held.get(w, 0) + n
                if len(held) > 500_000:
                    yield from out()
        yield from out()
    return run


# ------------------------------------------------------------ tables to look up in
@dataclass
class Lookup:
    """Rows sorted by a long key, in files of arrays that workers map."""

    folder: str
    name: str
    first: list[int]
    parts: list[int]

    def get(self, column: str, keys: np.ndarray, missing: int = -1) -> np.ndarray:
        """Values of ``column`` at ``keys``."""
        distinct, place = np.unique(keys, return_inverse=True)
        out = np.full(len(distinct), missing, np.int64)
        if self.first:
            file = np.maximum(np.searchsorted(np.array(self.first), distinct, "right") - 1, 0)
            for f, a, b in runs.by_shard(file):
                at, there = runs.find(self._array("key", f), distinct[a:b])
                out[a:b][there] = self._array(column, f)[at[there]]
        return out[place]

    def _array(self, column: str, file: int) -> np.ndarray:
        return shared.mapped(f"{self.folder}/{self.name}-{self.parts[file]}-{column}", np.int64)


def build_lookup(df: DataFrame, key: str, columns: list[str], folder: str, name: str, rows: int) -> Lookup:
    """``df``'s long ``columns`` by its distinct ``key``; the driver gets one
    row per file."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols = [[] for _ in range(len(columns) + 1)]
        for batch in batches:
            for c, given in zip(cols, batch.columns, strict=True):
                c.append(given.to_numpy())
        if cols[0]:
            part, arrays = TaskContext.get().partitionId(), [np.concatenate(c) for c in cols]
            for c, a in zip(["key", *columns], arrays, strict=True):
                shared.put(f"{folder}/{name}-{part}-{c}", a)
            yield pa.RecordBatch.from_pydict({"first": pa.array([int(arrays[0][0])], pa.int64()), "part": pa.array([part], pa.int32())})

    dealt = df.select(key, *columns).repartitionByRange(max(1, rows // FILE_ROWS), key).sortWithinPartitions(key)
    files = sorted((r["first"], r["part"]) for r in dealt.mapInArrow(write, "first long, part int").collect())
    return Lookup(folder, name, [f for f, _ in files], [p for _, p in files])


@dataclass
class Level:
    """Frequent phrases of some number of words: ids by key (a word's hash,
    or the id of all but the last word times the vocabulary, plus the last
    word's), and columns by id."""

    ids: Lookup
    columns: Lookup


@dataclass
class Vocabulary:
    """Frequent words; ``size`` of them. ``seed`` of their hashes."""

    seed: int
    size: int
    level: Level

    def ids_of(self, found: list[tuple[str, str]]) -> np.ndarray:
        base = xxhash.xxh64_intdigest(struct.pack("<q", self.seed), 42)
        seeds: dict[str, int] = {}
        hashes = np.empty(len(found), U64)
        for k, (lang, word) in enumerate(found):
            if lang not in seeds:
                seeds[lang] = xxhash.xxh64_intdigest(lang.encode(), base)
            hashes[k] = xxhash.xxh64_intdigest(word.encode(), seeds[lang])
        return self.level.ids.get("id", hashes.view(np.int64))


def word_hash(seed: int):
    """The words' hash as a column: the 64-bit xxHash of seed, language and
    word in turn, each with the one before as its seed."""
    return F.xxhash64(F.lit(seed).cast("long"), "lang", "word")


# ------------------------------------------------------------ counting
class Tiles:
    """Counts of id pairs of one task."""

    def __init__(self, size: int, shards: int, part: int, crowded: int = 0, most: int = 0):
        self.crowded, self.most = crowded or CROWDED, most or ENTRIES
        self.row_bits = max(1, (size >> SIDE_BITS).bit_length())
        self.shards, self.part = shards, part
        self.start()

    def start(self) -> None:
        self.dense: dict[int, np.ndarray] = {}
        self.lists: list[tuple[np.ndarray, np.ndarray]] = []
        self.entries = 0

    def keys(self, u: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Tile, then cell in it."""
        u, w, low = u.astype(U64), w.astype(U64), U64(SIDE - 1)
        s = U64(SIDE_BITS)
        tile = ((u >> s) << U64(self.row_bits)) | (w >> s)
        return (tile << U64(2 * SIDE_BITS)) | ((u & low) << s) | (w & low)

    def pairs(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        s, low = U64(SIDE_BITS), U64(SIDE - 1)
        tile = keys >> U64(2 * SIDE_BITS)
        u = ((tile >> U64(self.row_bits)) << s) | ((keys >> s) & low)
        w = ((tile & U64((1 << self.row_bits) - 1)) << s) | (keys & low)
        return u.astype(np.int64), w.astype(np.int64)

    def add(self, u: np.ndarray, w: np.ndarray) -> Iterator[pa.RecordBatch]:
        keys = self.keys(u, w)
        for tile, cells in self.dense.items():
            mine = keys >> U64(2 * SIDE_BITS) == U64(tile)
            cells += np.bincount((keys[mine] & U64(SIDE * SIDE - 1)).astype(np.int64), minlength=SIDE * SIDE)
            keys = keys[~mine]
        keys, counts = np.unique(keys, return_counts=True)
        if len(keys):
            tiles = keys >> U64(2 * SIDE_BITS)
            at = np.flatnonzero(np.concatenate(([True], tiles[1:] != tiles[:-1])))
            held = np.add.reduceat(counts, at)
            for k in np.argsort(-held, kind="stable")[:DENSE_TILES - len(self.dense)]:
                if held[k] >= self.crowded:
                    self.dense[int(tiles[at[k]])] = np.zeros(SIDE * SIDE, np.int64)
        self.lists.append((keys, counts))
        self.entries += len(keys)
        if self.entries >= self.most:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        for tile, cells in self.dense.items():
            at = np.flatnonzero(cells)
            self.lists.append((at.astype(U64) | U64(tile << 2 * SIDE_BITS), cells[at]))
        if self.lists:
            keys, counts = runs.summed(*(np.concatenate(x) for x in zip(*self.lists, strict=True)))
            shard = runs.shard_of(mix((keys >> U64(2 * SIDE_BITS)) + U64(1)), self.shards)
            order = np.argsort(shard, kind="stable")
            keys, counts, shard = keys[order], counts[order], shard[order]
            for s, a, b in runs.by_shard(shard):
                yield totals.run_batch(s, self.part, keys[a:b], counts[a:b])
        self.start()


def _lang_word(key: str) -> tuple[str, str]:
    size, rest = key.split(":", 1)
    return rest[:int(size)], rest[int(size):]


def _next(unit: np.ndarray, ids: np.ndarray, fresh: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where a frequent phrase of ``words`` words goes on in its piece
    with a frequent one that starts a word later, and the word added there."""
    n = len(ids) - words
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero((unit[:n] >= 0) & (unit[1:n + 1] >= 0) & ~fresh[words:])
    return at, ids[at + words]


def _count_phrases(vocabulary: Vocabulary, levels: list[Level], size: int, shards: int):
    """Count the phrases of one more word than those of the last level."""
    words, block_bytes, crowded, most = len(levels), units.BLOCK_BYTES, CROWDED, ENTRIES

    def units_of(ids: np.ndarray, fresh: np.ndarray) -> np.ndarray:
        unit = ids
        for m in range(1, words):
            at, added = _next(unit, ids, fresh, m)
            longer = np.full(len(ids), -1, np.int64)
            if len(at):
                longer[at] = levels[m].ids.get("id", unit[at] * vocabulary.size + added)
            unit = longer
        return unit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = Tiles(vocabulary.size, shards, TaskContext.get().partitionId(), crowded, most)
        cache = units.Cache(lambda keys: vocabulary.ids_of([_lang_word(k) for k in keys]).tolist())
        none = np.zeros(0, np.int64), np.zeros(0, bool)
        for batch in batches:
            langs = batch.column(0).to_pylist()
            tail, is_open = none, False  # of a text that goes on
            for block in _blocks(batch.column(1), block_bytes):
                if len(block.row):
                    code, found = _by_lang(langs, block)
                    ids = np.array(cache.values([f"{len(a)}:{a}{b}" for a, b in found]), np.int64)[code]
                    fresh = block.fresh.copy()
                    fresh[0] |= not is_open
                    ids, fresh = np.concatenate([tail[0], ids]), np.concatenate([tail[1], fresh])
                    unit = units_of(ids, fresh)
                    at, added = _next(unit, ids, fresh, words)
                    new = at + words >= len(tail[0])
                    yield from tiles.add(unit[at[new]], added[new])
                if block.more:
                    if len(block.row):
                        tail, is_open = (ids[-words:], fresh[-words:]), block.open_end
                    else:
                        is_open &= block.open_end
                else:
                    tail, is_open = none, False
        yield from tiles.flush()
    return run


def _keep_frequent(tiles: Tiles, least: int):
    def keep(_: int, keys: np.ndarray, counts: np.ndarray) -> pa.Table:
        often = counts >= least
        u, w = tiles.pairs(keys[often])
        return pa.table({"prefix": u, "last": w, "f": counts[often]})
    return keep


# ------------------------------------------------------------ levels
def _vocabulary(words: DataFrame, least: int, folder: str) -> tuple[Vocabulary, DataFrame]:
    seed = 1
    while words.groupBy(word_hash(seed).alias("h")).count().where("count > 1").limit(1).count():
        seed += 1
    often = words.where(F.col("f") >= least)
    ranked = dense_index(often, [F.col("lang").asc(), F.col("f").desc(), F.col("word").asc()], "id")
    languages = words.select("lang").distinct().orderBy("lang")
    numbered = dense_index(languages, [F.col("lang").asc()], "lang_no")
    table = shared.written(ranked.join(numbered, "lang").select("id", "lang", "lang_no", "word", "f", word_hash(seed).alias("h")), "words", folder)
    size = table.count()
    level = Level(build_lookup(table, "h", ["id"], folder, "word-ids", size), build_lookup(table, "id", ["f", "lang_no"], folder, "word-counts", size))
    return Vocabulary(seed, max(size, 1), level), table


def _level(texts: DataFrame, vocabulary: Vocabulary, levels: list[Level], least: int, tasks: int, folder: str) -> tuple[Level, DataFrame]:
    """Frequent phrases of one more word."""
    words, size = len(levels) + 1, vocabulary.size
    shards = min(1 << 14, runs.shards_for(tasks))
    counted = texts.mapInArrow(_count_phrases(vocabulary, levels, size, shards), totals.SCHEMA)
    found = totals.shard_totals(counted, _keep_frequent(Tiles(size, shards, 0), least), "prefix long, last long, f long", tasks)
    found = shared.written(found, f"phrases-{words}", folder)
    ranked = dense_index(found, [F.col("f").desc(), F.col("prefix").asc(), F.col("last").asc()], "id")

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix, last = batch["prefix"].to_numpy(), batch["last"].to_numpy()
            if words == 2:
                suffix = last
            else:
                suffix = levels[-1].ids.get("id", levels[-1].columns.get("suffix", prefix) * size + last)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(suffix, pa.int64()), pa.array(prefix * size + last, pa.int64())], names=[*batch.schema.names, "suffix", "key"])

    table = shared.written(ranked.select("id", "prefix", "last", "f").mapInArrow(suffixes, "id long, prefix long, last long, f long, suffix long, key long"), f"level-{words}", folder)
    n = table.count()
    return Level(build_lookup(table, "key", ["id"], folder, f"ids-{words}", n), build_lookup(table, "id", ["f", "prefix", "last", "suffix"], folder, f"columns-{words}", n)), table


CUT = "id long, a long, lang_no long, words array<long>, cuts array<struct<l:long,r:long>>"


def _cuts(levels: list[Level], words: int):
    """Per phrase its word ids and, for every cut, the counts of both parts.

    Parts of a frequent phrase are frequent, so their counts are known: the
    first k words are reached by dropping last words, the rest by dropping
    first ones.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            left, right = batch["prefix"].to_numpy(), batch["suffix"].to_numpy()
            lefts, rights, ids = [], [], [batch["last"].to_numpy()]
            for size in range(words - 1, 0, -1):  # words of the part
                at = levels[size - 1].columns
                lefts.append(at.get("f", left))
                rights.append(at.get("f", right))
                if size > 1:
                    ids.append(at.get("last", left))
                    left, right = at.get("prefix", left), at.get("suffix", right)
            ids.append(left)
            lang = levels[0].columns.get("lang_no", left)
            # cut after k words: k words on the left, the others on the right
            cuts = np.stack([np.stack([x, y], axis=1) for x, y in zip(lefts[::-1], rights, strict=True)], axis=1)
            n = len(batch)
            offsets = np.arange(n + 1, dtype=np.int32)
            flat = cuts.reshape(-1, 2)
            pairs = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], names=["l", "r"])
            yield pa.RecordBatch.from_arrays([
                batch["id"], batch["f"], pa.array(lang, pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets * words), pa.array(np.stack(ids[::-1], axis=1).ravel(), pa.int64())),
                pa.ListArray.from_arrays(pa.array(offsets * (words - 1)), pairs)], names=["id", "a", "lang_no", "words", "cuts"])
    return run


def _above_cut(scored: DataFrame, top: int, folder: str) -> DataFrame:
    """The rows of each language whose score is among its ``top`` best, with
    all that tie with the last of them.

    Scores are 0 to a million, so the cut comes from counts per thousand of
    them, then per score within the one thousand it falls in: about a
    thousand counters per language meet in a task, however many phrases.
    """
    def cut(rows: DataFrame, bucket: Column, name: str) -> DataFrame:
        counts = rows.groupBy("lang_no", bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
        before = F.sum("_n").over(Window.partitionBy("lang_no").orderBy(F.col("_b").desc())) - F.col("_n")
        least = counts.withColumn("_before", before).where(F.col("_before") < top).groupBy("lang_no").agg(F.min("_b").alias("_cut"))
        return shared.written(least, name, folder)  # a row per language, counted before it is broadcast

    coarse, fine = F.floor(F.col("score") / 1000) * 1000, F.col("score")
    scored = join_counted(scored, cut(scored, coarse, "cut-coarse"), "lang_no", "inner").where(coarse >= F.col("_cut"))
    # scores above the thousand of the cut count as one
    least = cut(scored, F.least(fine, F.col("_cut") + 1000), "cut-fine")
    return join_counted(scored.drop("_cut"), least, "lang_no", "inner").where(fine >= F.col("_cut")).drop("_cut")


def mine(docs: DataFrame, text: str = "text", lang: str = "lang", max_words: int = 3, least: int = 10, covered: int = 50, top: int = 2000) -> DataFrame:
    """``lang, rank, phrase, words, a, l, r, n, score`` of each language's
    first ``top`` phrases of 2 to ``max_words`` words.

    A phrase stands ``a`` times (``least`` or more) inside pieces between
    stops; its score is the least over its cuts of ``floor(10^6 a^2 / (l r))``
    for the counts of the two parts, in exact decimals (up to 3e15
    occurrences). Phrases that lie in a longer one with ``covered`` percent
    of their count or more are dropped. Null languages are ``und`` and count
    with it; null and empty texts have no words; repeated rows count again;
    equal scores are ordered by count, then by the phrase's bytes. An empty
    table gives no rows. Other columns are not read.
    """
    if max_words < 2:
        raise ValueError("phrases have two words or more")
    spark = docs.sparkSession
    folder = shared.new_folder(spark, "phrases")
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(text).cast("string").alias("text")).where("text is not null")
    tasks = texts.rdd.getNumPartitions()
    words = texts.mapInArrow(_count_words(units.BLOCK_BYTES), "lang string, word string, f long").groupBy("lang", "word").agg(F.sum("f").alias("f"))
    words = shared.written(words, "all-words", folder)
    vocabulary, spelled_words = _vocabulary(words, least, folder)
    levels, tables = [vocabulary.level], [spelled_words]
    for _ in range(2, max_words + 1):
        level, table = _level(texts, vocabulary, list(levels), least, tasks, folder)
        levels.append(level)
        tables.append(table)

    found = None
    for size in range(2, max_words + 1):
        part = tables[size - 1].select("id", "prefix", "last", "suffix", "f").mapInArrow(_cuts(levels, size), CUT)
        if size < max_words:
            longer = tables[size]
            over = longer.select(F.col("prefix").alias("id"), "f").unionByName(longer.select(F.col("suffix").alias("id"), "f")).groupBy("id").agg(F.max("f").alias("most"))
            part = part.join(over, "id", "left").where(F.coalesce(F.col("most") * 100 < F.col("a") * covered, F.lit(True))).drop("most")
        found = part if found is None else found.unionByName(part)

    best = F.expr("array_min(transform(cuts, (c, k) -> struct(cast((cast(1000000 as decimal(7,0)) * cast(a as decimal(20,0)) * cast(a as decimal(20,0))) div (cast(c.l as decimal(20,0)) * cast(c.r as decimal(20,0))) as long) as score, k, c.l as l, c.r as r)))")
    scored = found.withColumn("b", best).select("lang_no", "words", "a", "b.l", "b.r", "b.score")
    scored = _above_cut(shared.written(scored, "scored", folder), top, folder)
    by_score = Window.partitionBy("lang_no").orderBy(F.col("score").desc(), F.col("a").desc())
    # with all ties at the cut: their order is that of the phrases
    ahead = shared.written(scored.withColumn("_r", F.rank().over(by_score)).where(F.col("_r") <= top).drop("_r").withColumn("no", F.monotonically_increasing_id()), "ahead", folder)
    names = spelled_words.select("id", "word")
    spelled = ahead.select("no", F.posexplode("words").alias("k", "id")).join(names, "id").groupBy("no").agg(F.array_sort(F.collect_list(F.struct("k", "word"))).alias("w"))
    spelled = spelled.select("no", F.array_join(F.transform("w", lambda x: x["word"]), " ").alias("phrase"))
    totals_ = words.groupBy("lang").agg(F.sum("f").alias("n")).join(spelled_words.select("lang", "lang_no").distinct(), "lang")
    last = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())
    out = ahead.join(spelled, "no").join(totals_, "lang_no").withColumn("rank", F.row_number().over(last).cast("long")).where(F.col("rank") <= top)
    return out.select("lang", "rank", "phrase", F.size("words").alias("words"), "a", "l", "r", "n", "score")
