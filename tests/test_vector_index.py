"""The vector index against plain numpy, its recall, and what it reads."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tesela.operators import documents, vector_index


def nearest(ids, x, q, k):
    """Ids of the k best cosines, ties by id."""
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    score = np.round(unit @ (q / np.linalg.norm(q)), vector_index.DIGITS)
    return [int(ids[i]) for i in np.lexsort((ids, -score))[:k]]


@pytest.fixture(scope="module")
def corpus(spark):
    """Forty clusters, a third of all rows one and the same vector, and rows without a direction."""
    rng = np.random.default_rng(4)
    hubs = rng.normal(size=(40, 16))
    x = hubs[rng.integers(0, 40, 4000)] + 0.4 * rng.normal(size=(4000, 16))
    x[rng.random(4000) < 0.33] = x[0]
    odd = [(9001, None), (9002, [0.0] * 16), (9003, [1.0] * 5), (9004, []), (9005, [float("nan")] * 16), (9006, [1.0] * 15 + [None]), (None, [1.0] * 16)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + odd, "vec_id long, embedding array<double>").repartition(6)
    return df, x


@pytest.fixture(scope="module")
def index(corpus):
    return vector_index.build(corpus[0], vector_index.fit(corpus[0]))


def queries(df):
    return df.where("vec_id % 50 = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("query_vec"))


def found(df):
    out = {}
    for r in df.orderBy("qid", "rank").collect():
        out.setdefault(r["qid"], []).append(r["id"])
    return out


def test_every_row_is_indexed(spark, corpus, index):
    df, x = corpus
    assert index.table(spark).count() == len(x) + 1  # and the row without an id
    assert index.table(spark).groupBy("list", "part").count().agg(F.max("count")).first()[0] <= 1.3 * vector_index.BLOCK_ROWS


@pytest.mark.parametrize("block_rows, block_queries", [(vector_index.BLOCK_ROWS, vector_index.BLOCK_QUERIES), (100, 7)])
def test_exact_search_and_recall(corpus, monkeypatch, block_rows, block_queries):
    monkeypatch.setattr(vector_index, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(vector_index, "BLOCK_QUERIES", block_queries)
    df, x = corpus
    index = vector_index.build(df, vector_index.fit(df))
    if block_rows == 100:
        assert max(index.parts.values()) > 10  # the hot list is dealt out
    ids = np.array([*range(len(x)), -1])
    rows = np.vstack([x, np.ones(16)])
    want = {q: [None if i < 0 else i for i in nearest(ids, rows, x[q], 10)] for q in range(0, 4000, 50)}
    got = found(vector_index.search(index, queries(df), exact=True))
    assert got == want
    near = vector_index.search(index, queries(df))
    truth = vector_index.search(index, queries(df), exact=True)
    assert vector_index.recall_at(near, truth).first()["recall"] >= 0.9
    assert index.centres.probes < index.centres.lists / 3


def test_only_probed_lists_are_read(spark, corpus, index):
    df, x = corpus
    one = queries(df).where("qid = 50")
    routed = one.selectExpr("qid", "query_vec as qvec").mapInArrow(vector_index._route(index, 2, False), "qid long, qvec array<double>, list int")
    wanted = [r["list"] for r in routed.collect()]
    assert len(wanted) == 2
    plan = index.table(spark).where(F.col("list").isin(wanted))._jdf.queryExecution().toString()
    assert "PartitionFilters: [list" in plan
    sizes = {r["list"]: r["count"] for r in index.table(spark).groupBy("list").count().collect()}
    candidates = sum(sizes[i] for i in wanted)
    assert candidates < len(x) / 2
    assert vector_index.search(index, one, k=5000, probes=2).count() == candidates


def test_agrees_with_the_exact_form(corpus, index):
    df, _ = corpus
    some = queries(df).where("qid < 500")
    plain = {(r["qid"], r["rank"]): round(r["score"], 9) for r in documents.similarity_search(df.where("vec_id < 9000"), some, k=5).collect()}
    mine = {(r["qid"], r["rank"]): round(r["score"], 9) for r in vector_index.search(index, some, k=5, exact=True).collect()}
    assert plain == mine


def test_nothing_to_find(spark, corpus, index):
    df, _ = corpus
    none = df.limit(0)
    empty = vector_index.build(none, vector_index.fit(none))
    assert vector_index.search(empty, queries(df)).count() == 0
    assert vector_index.search(index, queries(none)).count() == 0
    odd = df.where("vec_id in (9001, 9002, 9003, 9005)").selectExpr("vec_id as qid", "embedding as query_vec")
    assert vector_index.search(index, odd, exact=True).count() == 0
    named = df.where("vec_id < 300").selectExpr("concat('v', vec_id) as vec_id", "embedding")
    texts = vector_index.build(named, vector_index.fit(named, lists=5))
    assert vector_index.search(texts, named.limit(3).selectExpr("vec_id as qid", "embedding as query_vec"), k=4).count() == 12


def test_a_worker_holds_slices_whatever_the_lists(monkeypatch):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(300, 16))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    x = rng.normal(size=(2000, 16))
    vecs = pa.array([None, *x.tolist()], pa.list_(pa.float64()))
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(2001)), vecs, pa.array(np.full(2001, np.nan))], names=["id", "vec", "floor"])
    index = vector_index.VectorIndex("", vector_index.Centres(centres, 40), {i: 1 for i in range(300)}, {i: 0.1 for i in range(300)}, "bigint")
    runs = [lambda: vector_index._assign(centres), lambda: vector_index._route(index, 40, False), lambda: vector_index._route(index, 40, True)]
    want = []
    for size in (1 << 40, 100_000):
        monkeypatch.setattr(vector_index, "SLICE_NUMBERS", size)
        made = [list(run()(iter([batch]))) for run in runs]
        for i, out in enumerate(made):
            if size > 1 << 30:
                want.append(pa.Table.from_batches(out))
            else:  # what is held, and passed on, keeps to the bound
                assert max(b.num_rows for b in out) * (300 if i == 0 else 16) <= size
                got = pa.Table.from_batches(out)
                if i == 0:  # a product of fewer rows may differ in the last bits
                    assert np.allclose(got["angle"], want[i]["angle"])
                    got, want[i] = got.drop(["angle"]), want[i].drop(["angle"])
                assert got.equals(want[i])
