"""Interpolated modified Kneser-Ney bigram model over a corpus, and its
scores of whole texts.

Counted in Spark, kept as sorted hash arrays in the shared folder, and
memory-mapped by the workers that score:

1. *Vocabulary.* Tasks hash the words of the training texts and emit sorted
   runs of (word hash, count); a shard (hash range) merges its runs into the
   files ``words`` and ``count``. A word's id is its place in all shards.
2. *Bigrams.* The same with keys ``id(first) << 32 | id(second)``, dealt by
   the first word, so a context's bigrams meet and its continuation counts
   are complete there. Contexts with more tokens than a shard should hold
   are dealt by both words; their partial counts are few and add up later.
3. *Contexts.* Per word: in how many contexts it stands, and how many of its
   own bigrams were seen once, twice, or more. Partial arrays are dealt by
   id range and added.

The driver sees one row of totals per shard. With ``c`` the bigram count,
``N1+(.w)`` the number of contexts of ``w`` and discounts ``D`` from the
counts of counts (Chen and Goodman's formula)::

    p(w|v)  = max(c(vw) - D(c(vw)), 0) / c(v) + g(v) * p1(w)
    g(v)    = (D1 * N1(v.) + D2 * N2(v.) + D3 * N3+(v.)) / c(v)
    p1(w)   = max(N1+(.w) - D'(N1+(.w)), 0) / N1+(..) + g' / (V + 1)

so the probabilities of the ``V`` known tokens and one unknown token add up
to 1 after every context; an unknown context backs off with weight 1. A text
starts after a begin mark (a context only) and ends with one end token.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import runs, shared
from .bytewords import NONSPACE, U64, mix, split_words, text_slices
from .util import fresh

#: Hashes of the end token and the begin mark.
END, BEGIN = U64(0x5EED00E2D), U64(0x5EED0B0)
PORTION = 2_000_000  # entries a task gathers before it emits runs


@dataclass
class Model:
    """Totals, and where the arrays are. ``starts``: first id of each shard."""

    folder: str
    word_shards: int
    pair_shards: int
    tokens: int = 0
    texts: int = 0
    starts: list[int] = field(default_factory=list)
    types: int = 0
    pair_types: int = 0
    hot: list[int] = field(default_factory=list)
    discounts: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0)
    low_discounts: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0)
    low_rest: float = 1.0

    @property
    def begin(self) -> int:
        """Id of the begin mark, after all words."""
        return self.types

    def file(self, name: str, shard: int, dtype) -> np.ndarray:
        return shared.mapped(f"{self.folder}/{name}-{shard}", dtype)

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of sorted distinct hashes, -1 where unknown."""
        out = np.full(len(hashes), -1, np.int64)
        for s, a, b in runs.by_shard(runs.shard_of(hashes, self.word_shards)):
            at, there = runs.find(self.file("words", s, U64), hashes[a:b])
            out[a:b] = np.where(there, at + self.starts[s], -1)
        return out

    def gather(self, name: str, dtype, ids: np.ndarray) -> np.ndarray:
        """Values of file ``name`` at sorted ids (all known words)."""
        out = np.zeros(len(ids), np.int64)
        for s, a, b in runs.by_shard(np.searchsorted(self.starts, ids, "right") - 1):
            out[a:b] = self.file(name, s, dtype)[ids[a:b] - self.starts[s]]
        return out

    def pair_shard(self, keys: np.ndarray, _: int = 0) -> np.ndarray:
        """Shard of bigram keys: by the first word, of hot ones by both."""
        first = keys >> U64(32)
        spread = mix(first + U64(1))
        if self.hot:
            spread = np.where(np.isin(first, np.array(self.hot, U64)), mix(keys), spread)
        return runs.shard_of(spread, self.pair_shards)


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of the texts, each text with its end token, and ranges."""
    w = split_words(data, offsets, NONSPACE)
    n = w.texts
    first = w.first + np.arange(n + 1)
    out = np.empty(first[-1], U64)
    ends = first[1:] - 1
    keep = np.ones(len(out), bool)
    keep[ends] = False
    out[keep], out[ends] = w.hash, END
    return out, first


def _coded(model: Model, data: np.ndarray, offsets: np.ndarray):
    """Distinct ids of a slice, and per token the place in them."""
    tokens, first = _tokens(data, offsets)
    distinct, place = np.unique(tokens, return_inverse=True)
    return model.ids(distinct), place, first


def _pairs(ids: np.ndarray, first: np.ndarray, begin: int) -> np.ndarray:
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[first[:-1]] = begin
    return (before.astype(U64) << U64(32)) | ids.astype(U64)


def _count_words(shards: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        portion = runs.Portion(shards, PORTION)
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0)):
                yield from portion.add(_tokens(data, offsets)[0])
        yield from portion.flush()
    return count


def _store_words(folder: str):
    def store(group: pa.Table) -> pa.Table:
        shard = group["shard"][0].as_py()
        keys, counts = runs.merged(group)
        shared.put(f"{folder}/words-{shard}", keys)
        shared.put(f"{folder}/count-{shard}", counts)
        # one word's count is bounded by the corpus, so these are few
        return pa.table({"shard": pa.array([shard], pa.int32()), "types": [len(keys)], "tokens": [int(counts.sum())],
                         "ends": [int(counts[keys == END].sum())],
                         "top": pa.array([_top(counts)], pa.list_(pa.int64()))})
    return store


def _top(counts: np.ndarray, most: int = 64) -> list[int]:
    """Places of the largest counts of a shard, as ``place, count, ...``."""
    at = np.argsort(counts)[-most:]
    return [int(x) for p in at for x in (p, counts[p])]


def _count_pairs(model: Model):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        portion = runs.Portion(model.pair_shards, PORTION, model.pair_shard)
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0)):
                distinct, place, first = _coded(model, data, offsets)
                yield from portion.add(_pairs(distinct[place], first, model.begin))
        yield from portion.flush()
    return count


NODE_SCHEMA = "kind string, shard int, n long, keys binary, counts binary, totals array<long>"


def _store_pairs(model: Model):
    def store(group: pa.Table) -> pa.Table:
        shard = group["shard"][0].as_py()
        keys, counts = runs.merged(group)
        shared.put(f"{model.folder}/pairs-{shard}", keys)
        shared.put(f"{model.folder}/pair-count-{shard}", counts.astype(np.uint32))
        rows = [("totals", shard, len(keys), b"", b"", [int((counts == k).sum()) for k in (1, 2, 3, 4)])]
        contexts = (keys >> U64(32)).astype(np.int64)
        seconds = np.sort((keys & U64(0xFFFFFFFF)).astype(np.int64))
        for kind, ids in (("in", seconds), *((f"out{k}", contexts[(counts == k) if k < 3 else (counts >= 3)]) for k in (1, 2, 3))):
            distinct, many = np.unique(ids, return_counts=True)
            where = np.searchsorted(model.starts, distinct, "right") - 1
            for s, a, b in runs.by_shard(where):
                rows.append((kind, s, b - a, runs.pack_sorted(distinct[a:b].astype(U64)), runs.pack(many[a:b].astype(np.uint32)), []))
        return pa.table({"kind": pa.array([r[0] for r in rows], pa.string()), "shard": pa.array([r[1] for r in rows], pa.int32()),
                         "n": pa.array([r[2] for r in rows], pa.int64()), "keys": pa.array([r[3] for r in rows], pa.binary()),
                         "counts": pa.array([r[4] for r in rows], pa.binary()), "totals": pa.array([r[5] for r in rows], pa.list_(pa.int64()))})
    return store


KINDS = ("in", "out1", "out2", "out3")


def _store_nodes(model: Model):
    sizes = np.diff([*model.starts, model.types + 1])  # the begin mark is the last id of the last shard

    def store(group: pa.Table) -> pa.Table:
        shard = group["shard"][0].as_py()
        totals = [0] * 5
        for kind in KINDS:
            part = group.filter(pa.compute.equal(group["kind"], kind))
            out = np.zeros(sizes[shard], np.uint32)
            keys, counts = runs.merged(part)
            out[keys.astype(np.int64) - model.starts[shard]] = counts
            shared.put(f"{model.folder}/{kind}-{shard}", out)
            if kind == "in":
                totals = [int((out == k).sum()) for k in (1, 2, 3, 4)] + [int((out >= 3).sum())]
        return pa.table({"shard": pa.array([shard], pa.int32()), "totals": pa.array([totals], pa.list_(pa.int64()))})
    return store


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float, float]:
    """Discount of counts 0, 1, 2 and 3 or more, each within [0, count].

    Where a count of counts is 0 (tiny corpora) the formula has no value; a
    discount of half the count stands in.
    """
    if not (n1 and n2):
        return 0.0, 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return 0.0, *(float(min(max(x, 0.01), k - 0.01)) for k, x in zip((1, 2, 3), d, strict=True))


def train(docs: DataFrame, text: str = "text", when: Column | None = None) -> Model:
    """Count the model over the texts of all rows (of those with ``when``).

    Null texts are empty texts; a repeated row counts again; an empty table
    gives a model of one unknown token. Other columns are not read.
    """
    spark = docs.sparkSession
    texts = (docs if when is None else docs.where(when)).select(F.col(text).cast("string").alias("text"))
    tasks = texts.rdd.getNumPartitions()
    shards = runs.shards_for(tasks)
    folder = shared.new_folder(spark, "kn")
    model = Model(folder, shards, 2 * shards)

    counted = texts.mapInArrow(_count_words(shards), runs.RUN_SCHEMA)
    rows = counted.groupBy("shard").applyInArrow(_store_words(folder), "shard int, types long, tokens long, ends long, top array<long>").collect()
    have = {r["shard"]: r for r in rows}
    for s in range(shards):
        model.starts.append(model.types)
        if s not in have:
            shared.put(f"{folder}/words-{s}", b"")
            shared.put(f"{folder}/count-{s}", b"")
            continue
        model.types += have[s]["types"]
        model.tokens += have[s]["tokens"]
        model.texts += have[s]["ends"]
    if model.types >= 1 << 32:
        raise ValueError("bigram keys hold 32-bit word ids")
    most = model.tokens / model.pair_shards / 4
    for s, r in have.items():
        model.hot += [model.starts[s] + p for p, c in zip(r["top"][::2], r["top"][1::2], strict=True) if c > most]
    model.hot = sorted(model.hot + ([model.begin] if model.texts > most else []))

    pairs = texts.mapInArrow(_count_pairs(model), runs.RUN_SCHEMA)
    nodes = shared.written(pairs.groupBy("shard").applyInArrow(_store_pairs(model), NODE_SCHEMA), "nodes", folder)
    totals = np.zeros(4, np.int64)
    stored = set()
    for r in nodes.where("kind = 'totals'").select("shard", "n", "totals").collect():
        model.pair_types += r["n"]
        totals += np.array(r["totals"])
        stored.add(r["shard"])
    for s in set(range(model.pair_shards)) - stored:
        shared.put(f"{folder}/pairs-{s}", b"")
        shared.put(f"{folder}/pair-count-{s}", b"")
    model.discounts = discounts(*map(int, totals))

    low, more, there = np.zeros(4, np.int64), 0, set()
    for r in nodes.where("kind != 'totals'").groupBy("shard").applyInArrow(_store_nodes(model), "shard int, totals array<long>").collect():
        low += np.array(r["totals"][:4])
        more += r["totals"][4]
        there.add(r["shard"])
    sizes = np.diff([*model.starts, model.types + 1])
    for s in set(range(shards)) - there:
        for kind in KINDS:
            shared.put(f"{folder}/{kind}-{s}", np.zeros(sizes[s], np.uint32))
    shared.discard(f"{folder}/nodes.parquet")
    model.low_discounts = discounts(*map(int, low))
    if model.pair_types:
        d = model.low_discounts
        model.low_rest = (d[1] * int(low[0]) + d[2] * int(low[1]) + d[3] * more) / model.pair_types
    return model


def _scores(model: Model, data: np.ndarray, offsets: np.ndarray):
    """Per text: tokens, known tokens, base score, model score."""
    distinct, place, first = _coded(model, data, offsets)
    known = distinct >= 0
    count = np.zeros(len(distinct), np.int64)
    unseen = model.low_rest / (model.types + 1)
    lower, back = np.full(len(distinct), unseen), np.ones(len(distinct))
    if known.any():
        ids = distinct[known]
        order = np.argsort(ids)
        at = np.flatnonzero(known)[order]
        ids = ids[order]
        count[at] = model.gather("count", np.int64, ids)
        seen = model.gather("in", np.uint32, ids)
        d = np.array(model.low_discounts)
        lower[at] = np.maximum(seen - d[np.minimum(seen, 3)], 0) / max(model.pair_types, 1) + unseen
        out = [model.gather(f"out{k}", np.uint32, ids) for k in (1, 2, 3)]
        rest = sum(model.discounts[k + 1] * out[k] for k in range(3))
        back[at] = np.where(sum(out) > 0, rest / np.maximum(count[at], 1), 1.0)
    base = np.log10((count + 1) / (model.tokens + model.types + 1))
    tokens = distinct[place]
    before = np.empty_like(place)  # as a place among the distinct ids, -1: begin
    before[1:] = place[:-1]
    before[first[:-1]] = -1
    last = len(model.starts) - 1
    b = model.texts
    b_out = [int(model.file(f"out{k}", last, np.uint32)[-1]) for k in (1, 2, 3)]
    b_back = sum(model.discounts[k + 1] * b_out[k] for k in range(3)) / b if b else 1.0
    weight = np.where(before >= 0, back[before], b_back)
    total = np.where(before >= 0, count[before], b)
    p = weight * lower[place]
    context = np.where(before >= 0, distinct[before], model.begin)
    both = np.flatnonzero((tokens >= 0) & (context >= 0) & (total > 0))
    keys, where = np.unique((context[both].astype(U64) << U64(32)) | tokens[both].astype(U64), return_inverse=True)
    if len(keys):
        shard = model.pair_shard(keys)
        order = np.argsort(shard, kind="stable")
        found = np.zeros(len(keys), np.int64)
        for s, x, y in runs.by_shard(shard[order]):
            mine = order[x:y]
            at, there = runs.find(model.file("pairs", s, U64), keys[mine])
            found[mine[there]] = model.file("pair-count", s, np.uint32)[at[there]]
        d = np.array(model.discounts)
        gain = np.maximum(found - d[np.minimum(found, 3)], 0)
        p[both] += gain[where] / total[both]
    start = first[:-1]  # every text has its end token, so no range is empty
    n = np.diff(first)
    add = np.add.reduceat
    return n, add(known[place].astype(np.int64), start), add(base[place], start), add(np.log10(p), start)


def score(docs: DataFrame, model: Model, text: str = "text", prefix: str = "") -> DataFrame:
    """All rows and columns of ``docs`` and ``n_tokens``, ``n_known``,
    ``base_score``, ``score`` (log10 probability) and ``perplexity``.

    A null or empty text is its end token alone. A clashing column of the
    input is replaced; give a ``prefix`` to keep it.
    """
    names = [prefix + x for x in ("n_tokens", "n_known", "base_score", "score", "perplexity")]
    kept = [c for c in docs.columns if c not in names]
    inner = fresh(docs, "text_of_score")
    src = docs.select(*kept, F.col(text).cast("string").alias(inner))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column(batch.num_columns - 1)
            for lo, hi, data, offsets in text_slices(col):
                n, known, base, s = _scores(model, data, offsets)
                rest = [batch.column(i).slice(lo, hi - lo) for i in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*rest, *(pa.array(x, t) for x, t in ((n, pa.int64()), (known, pa.int64()), (base, pa.float64()), (s, pa.float64()), (np.power(10.0, np.minimum(-s / n, 300.0)), pa.float64())))], names=[*kept, *names])

    schema = [src.schema[c] for c in kept]
    out = T.StructType([*schema, *(T.StructField(x, T.LongType() if k < 2 else T.DoubleType()) for k, x in enumerate(names))])
    return src.mapInArrow(run, out)
