"""Row numbers from files in order: the same as sorting, without a sort."""

import numpy as np
from pyspark.sql import functions as F

from small_tables import SF_SMALL
from tesela.operators import documents
from tesela.operators.indexing import dense_index, stored_index
from tesela.plans import q_documents, warehouse
from tesela.plans.q_contracts import master


def test_equals_the_sorted_numbering(spark, tmpdir_path):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(int(k) if k % 11 else None, f"t{i}") for i, k in enumerate(rng.permutation(5000))], "k long, t string")
    order = [F.col("k").asc_nulls_first(), F.col("t").asc_nulls_first()]
    (df.repartitionByRange(120, *order).sortWithinPartitions(*order).write.option("maxRecordsPerFile", 17).parquet(f"{tmpdir_path}/t"))
    got = stored_index(spark.read.parquet(f"{tmpdir_path}/t"), "i", start=1)
    want = dense_index(df, order, "i", start=1)
    assert sorted(map(tuple, got.select("t", "i").collect())) == sorted(map(tuple, want.select("t", "i").collect()))
    few = got.where("k between 100 and 120").collect()  # a filter after the numbering does not change it
    assert {(r["t"], r["i"]) for r in few} <= {(r["t"], r["i"]) for r in want.collect()}


def test_documents_are_numbered_without_a_sort(spark):
    df = q_documents.q_rag_01(spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Sort" not in plan and "row_index" in plan
    plain = documents.to_documents(master(spark, SF_SMALL), "contratacion", q_documents.MASTER_ORDER)
    assert {(r["id"], r["content"]) for r in df.collect()} == {(r["id"], r["content"]) for r in plain.select("id", "content").collect()}
    assert warehouse.materialize(spark, SF_SMALL, "master_in_order", master, sort_within=q_documents.MASTER_ORDER).count() == df.count()
