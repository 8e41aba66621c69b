"""Inverted-list vector index for similarity search (RAG-07).

``fit`` finds list centres by k-means on a bounded sample and, on the same
sample, how many lists a query has to probe for a target recall. ``build``
assigns *every* row to its nearest centre and writes the lists as Parquet
partitions; a long list is dealt to blocks of bounded size. ``search`` sends
each query to its nearest lists, reads only those partitions, and scores a
block of queries against a block of rows at a time with one matrix product,
so neither a hot list nor many queries meet in one task, and no row per
(query, vector) pair is ever made. The score of a candidate is its exact
cosine, so only candidates can be missing, never a rank be wrong among them.

``exact=True`` closes that gap: with the k-th best score of the first round,
a list can be left out only if the angle between query and centre minus the
list's radius proves that nothing in it reaches that score.

Vectors that are null, all zeros, hold nulls or NaN, or have another length
than the centres have no cosine: as rows they are never found, as queries
they find nothing. Rows with equal score come in id order.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package

#: Rows that centres are fitted on, and lists, at most.
SAMPLE_ROWS, MAX_LISTS = 20_000, 4096
#: Rows and queries of one block: what a scoring task holds at a time.
BLOCK_ROWS, BLOCK_QUERIES = 16_384, 4096
#: Numbers of one matrix that a worker holds at a time (scores of rows by
#: centres, vectors of queries by lists), 32 MB: a batch is cut by it, so a
#: worker's memory does not grow with the lists.
SLICE_NUMBERS = 1 << 22
#: Digits that a score is compared by: sums of products differ in the last bits.
DIGITS = 12


@dataclass(frozen=True)
class Centres:
    """Unit vectors of the lists' centres, and the lists to probe."""

    vectors: np.ndarray
    probes: int

    @property
    def lists(self) -> int:
        return len(self.vectors)


@dataclass(frozen=True)
class VectorIndex:
    """Parquet table ``(list, part, id, vec)`` at ``path``; per list its
    number of blocks and its radius (the largest angle to the centre)."""

    path: str
    centres: Centres
    parts: dict[int, int]
    radius: dict[int, float]
    id_type: str

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(f"id {self.id_type}, vec array<double>, part int, list int").parquet(self.path)


# ------------------------------------------------------------------ vectors
def _slices(batches: Iterator[pa.RecordBatch], a_row: int) -> Iterator[pa.RecordBatch]:
    """The batches, cut to ``SLICE_NUMBERS`` where each row takes ``a_row``."""
    rows = max(1, SLICE_NUMBERS // max(1, a_row))
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def _unit(col: pa.Array | pa.ChunkedArray, dim: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows that have a direction, and their unit vectors."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    size = np.asarray(pc.fill_null(pc.list_value_length(col), 0))
    if dim is None:
        dim = int(np.bincount(size).argmax()) if len(size) else 0
    rows = np.flatnonzero((size == dim) & (dim > 0))
    flat = pc.list_flatten(col.take(pa.array(rows)))
    x = np.asarray(flat.to_numpy(zero_copy_only=False), np.float64).reshape(len(rows), dim)
    norm = np.sqrt((x * x).sum(axis=1))
    good = np.isfinite(norm) & (norm > 0)
    return rows[good], x[good] / norm[good, None]


def _kmeans(x: np.ndarray, lists: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    """Spherical k-means; an empty list takes the row farthest from its own."""
    centres = x[rng.choice(len(x), lists, replace=False)]
    for _ in range(rounds):
        score = x @ centres.T
        near = score.argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        empty = np.flatnonzero(np.bincount(near, minlength=lists) == 0)
        sums[empty] = x[np.argsort(score.max(axis=1), kind="stable")[:len(empty)]]
        norm = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(norm > 0, sums / np.where(norm > 0, norm, 1), centres)
    return centres


def _probes(x: np.ndarray, centres: np.ndarray, k: int, recall: float, rng: np.random.Generator) -> int:
    """Fewest nearest lists that hold ``recall`` of the k nearest sample rows
    of sample queries. A whole corpus is denser than its sample, so its
    nearest rows are nearer and the figure is on the safe side."""
    near = (x @ centres.T).argmax(axis=1)
    asked = rng.choice(len(x), min(len(x), 400), replace=False)
    best = np.argsort(-(x[asked] @ x.T), axis=1, kind="stable")[:, :k]
    order = np.argsort(-(x[asked] @ centres.T), axis=1, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(len(centres))[None, :].repeat(len(asked), 0), axis=1)
    needed = np.sort(np.take_along_axis(place, near[best], axis=1).ravel())
    return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) + 1


# ------------------------------------------------------------------ fit and build
def fit(corpus: DataFrame, id_col: str = "vec_id", vec: str = "embedding", lists: int | None = None, k: int = 10,
        recall: float = 0.97, sample_rows: int = SAMPLE_ROWS, rounds: int = 8, seed: int = 7) -> Centres:
    """Centres from at most ``sample_rows`` rows, those with the smallest
    hashes of their ids. By default as many lists as the square root of the
    corpus' rows, 4096 at most."""
    n = corpus.count()
    sample = (corpus.select(F.col(vec).cast("array<double>").alias("v"), F.xxhash64(F.col(id_col).cast("string"), F.lit(seed)).alias("h"))
              .orderBy("h", "v").limit(sample_rows).select("v").toArrow())
    _, x = _unit(sample["v"])
    rng = np.random.default_rng(seed)
    if not len(x):
        return Centres(np.zeros((1, 0)), 1)
    count = max(1, min(lists or int(n ** 0.5), MAX_LISTS, len(x)))
    centres = _kmeans(x, count, rounds, rng)
    return Centres(centres, _probes(x, centres, k, recall, rng))


def _assign(centres: np.ndarray):
    """Nearest list and the angle to its centre."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, len(centres)):
            rows, x = _unit(batch.column(1), centres.shape[1])
            score = x @ centres.T
            near = score.argmax(axis=1)
            angle = np.arccos(np.clip(score[np.arange(len(x)), near], -1.0, 1.0)) if len(x) else np.zeros(0)
            kept = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1), pa.array(near, pa.int32()), pa.array(angle, pa.float64())], names=["id", "vec", "list", "angle"])
    return run


def build(corpus: DataFrame, centres: Centres, path: str | None = None, id_col: str = "vec_id", vec: str = "embedding") -> VectorIndex:
    """Assign every row and write the lists; ``path`` is by default a fresh
    folder below ``spark.checkpoint.dir``. The driver gets one row per list."""
    spark = corpus.sparkSession
    ship_package(spark)
    root = path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/tesela-index-{uuid.uuid4().hex}"
    kind = corpus.schema[id_col].dataType.simpleString()
    assigned = (corpus.select(F.col(id_col).alias("id"), F.col(vec).cast("array<double>").alias("vec"))
                .mapInArrow(_assign(centres.vectors), f"id {kind}, vec array<double>, list int, angle double"))
    # rows with their list once, then the blocks that the lists' sizes call for
    assigned.write.mode("overwrite").parquet(f"{root}/assigned")
    rows = spark.read.schema(assigned.schema).parquet(f"{root}/assigned")
    sizes = rows.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("radius")).collect()
    parts = {r["list"]: -(-r["n"] // BLOCK_ROWS) for r in sizes}
    per_list = F.broadcast(spark.createDataFrame(list(parts.items()), "list int, _parts int"))
    part = F.pmod(F.xxhash64("id"), F.col("_parts")).cast("int")
    dealt = rows.join(per_list, "list").select("id", "vec", part.alias("part"), "list")
    dealt.repartition("list", "part").write.mode("overwrite").partitionBy("list").parquet(f"{root}/lists")
    return VectorIndex(f"{root}/lists", centres, parts, {r["list"]: float(r["radius"]) for r in sizes}, kind)


# ------------------------------------------------------------------ search
def _route(index: VectorIndex, probes: int, second: bool):
    """Lists of each query: the nearest ``probes``; in the second round those
    beyond them that may hold something above the query's ``floor``."""
    centres = index.centres.vectors
    there = np.array(sorted(index.parts), np.int64)
    radius = np.array([index.radius[i] for i in there.tolist()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, len(there) * centres.shape[1]):
            rows, q = _unit(batch.column(1), centres.shape[1])
            kept = batch.take(pa.array(rows))
            score = q @ centres[there].T
            order = np.argsort(-score, axis=1, kind="stable")
            if second:
                floor = np.asarray(kept.column(2).to_numpy(zero_copy_only=False), np.float64)
                least = np.maximum(np.arccos(np.clip(score, -1.0, 1.0)) - radius[None, :], 0.0)
                rest = np.take_along_axis(np.cos(least) + 1e-9 >= np.where(np.isnan(floor), -2.0, floor)[:, None], order, axis=1)
                rest[:, :probes] = False
            else:
                rest = np.zeros(score.shape, bool)
                rest[:, :probes] = True
            at, place = np.nonzero(rest)
            yield pa.RecordBatch.from_arrays([kept.column(0).take(pa.array(at)), kept.column(1).take(pa.array(at)), pa.array(there[order[at, place]], pa.int32())], names=["qid", "qvec", "list"])
    return run


def _score_block(dim: int, k: int):
    """The best ``k`` rows of a block for each query of a block."""
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        at, x = _unit(rows["vec"], dim)
        asked, q = _unit(queries["qvec"], dim)
        ids = rows["id"].combine_chunks().take(pa.array(at)) if len(at) else rows["id"].combine_chunks().slice(0, 0)
        rank = np.empty(len(at), np.int64)
        rank[pc.sort_indices(ids).to_numpy()] = np.arange(len(at))
        qs, found, scores = [], [], []
        for lo in range(0, len(q), 256):
            score = np.round(q[lo:lo + 256] @ x.T, DIGITS)
            for row, s in enumerate(score):
                if len(s) > k:
                    floor = s[np.argpartition(-s, k - 1)[k - 1]]
                    mine = np.flatnonzero(s >= floor)
                else:
                    mine = np.arange(len(s))
                mine = mine[np.lexsort((rank[mine], -s[mine]))][:k]
                qs.append(np.full(len(mine), asked[lo + row]))
                found.append(mine)
                scores.append(s[mine])
        none = np.zeros(0, np.int64)
        return pa.table({"qid": queries["qid"].combine_chunks().take(pa.array(np.concatenate(qs) if qs else none)), "id": ids.take(pa.array(np.concatenate(found) if found else none)), "score": np.concatenate(scores) if scores else np.zeros(0)})
    return run


def _scored(spark: SparkSession, index: VectorIndex, routed: DataFrame, k: int, qtype: str) -> DataFrame:
    """The best ``k`` of every block for the routed queries."""
    blocks = {r["list"]: -(-r["count"] // BLOCK_QUERIES) for r in routed.groupBy("list").count().collect()}  # one row per list
    wanted = sorted(blocks)
    if not wanted:
        return spark.createDataFrame([], f"qid {qtype}, id {index.id_type}, score double")
    small = F.broadcast(spark.createDataFrame([(i, index.parts[i], blocks[i]) for i in wanted], "list int, _parts int, _blocks int"))
    rows = index.table(spark).where(F.col("list").isin(wanted)).join(small, "list").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    asked = (routed.join(small, "list").withColumn("block", F.pmod(F.xxhash64("qid"), F.col("_blocks")).cast("int"))
             .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))))
    tile = ["list", "part", "block"]
    return (rows.select(*tile, "id", "vec").groupBy(*tile).cogroup(asked.select(*tile, "qid", "qvec").groupBy(*tile))
            .applyInArrow(_score_block(index.centres.vectors.shape[1], k), f"qid {qtype}, id {index.id_type}, score double"))


def _best(scored: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("id").asc())
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def search(index: VectorIndex, queries: DataFrame, k: int = 10, probes: int | None = None, exact: bool = False,
           qid: str = "qid", qvec: str = "query_vec") -> DataFrame:
    """``(qid, id, score, rank)``: the ``k`` nearest rows of every query among
    its ``probes`` nearest lists (all rows that can matter if ``exact``).
    Query ids must be distinct."""
    spark = queries.sparkSession
    ship_package(spark)
    kind = queries.schema[qid].dataType.simpleString()
    asked = queries.select(F.col(qid).alias("qid"), F.col(qvec).cast("array<double>").alias("qvec"))
    width = min(probes or index.centres.probes, max(1, len(index.parts)))
    ensure_checkpoint_dir(spark)
    if not index.parts:
        return spark.createDataFrame([], f"qid {kind}, id {index.id_type}, score double, rank int")
    routed = asked.mapInArrow(_route(index, width, False), f"qid {kind}, qvec array<double>, list int").checkpoint(eager=True)
    first = _best(_scored(spark, index, routed, k, kind), k)
    if exact:
        first = first.checkpoint(eager=True)
        # fewer than k found: no floor
        floors = first.groupBy("qid").agg(F.when(F.count(F.lit(1)) == k, F.min("score")).alias("floor"))
        again = asked.join(floors, "qid", "left").select("qid", "qvec", "floor")
        routed = again.mapInArrow(_route(index, width, True), f"qid {kind}, qvec array<double>, list int").checkpoint(eager=True)
        first = _best(first.drop("rank").unionByName(_scored(spark, index, routed, k, kind)), k)
    return first


def recall_at(found: DataFrame, truth: DataFrame) -> DataFrame:
    """``(hits, wanted, recall)``: how much of ``truth(qid, id)`` is in ``found``."""
    t = truth.select("qid", "id")
    hit = found.select("qid", "id", F.lit(1).alias("_hit"))
    return (t.join(hit, ["qid", "id"], "left").agg(F.sum(F.coalesce("_hit", F.lit(0))).alias("hits"), F.count(F.lit(1)).alias("wanted"))
            .select("hits", "wanted", F.try_divide("hits", "wanted").alias("recall")))
