"""Layers are built with shuffle partitions that grow with the input."""

import pytest

from tesela.plans import warehouse
from tesela.sources import fixtures

SF = "/root/testdata/sf0.001"


def test_partitions_grow_with_the_input_and_come_back(spark, monkeypatch):
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = [spark.conf.get(n, None) for n in names]
    size = warehouse.input_bytes(spark, SF)
    monkeypatch.setattr(warehouse, "PARTITION_BYTES", size // 50)
    with pytest.raises(ValueError), warehouse.sized(spark, SF):
        assert int(spark.conf.get(names[0])) >= 50
        raise ValueError
    assert [spark.conf.get(n, None) for n in names] == before


def test_large_supplier_table_is_not_broadcast(spark, monkeypatch):
    want = fixtures.contracts(spark, SF)
    monkeypatch.setattr(fixtures, "BROADCAST_SUPPLIERS", 0)
    got = fixtures.contracts(spark, SF)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_contracts_keep_departments_together_in_order_of_dates(spark):
    from itertools import groupby

    from pyspark.sql import functions as F

    layer = warehouse.contracts(spark, SF)
    rows = layer.select(F.input_file_name().alias("f"), F.col("_metadata.row_index").alias("i"), "departamento", "fecha_inicio").collect()
    for _, part in groupby(sorted(rows, key=lambda r: (r["f"], r["i"])), key=lambda r: r["f"]):
        runs = [(d, [r["fecha_inicio"] for r in g]) for d, g in groupby(part, key=lambda r: r["departamento"])]
        assert len({d for d, _ in runs}) == len(runs)
        assert all(days == sorted(days) for _, days in runs)
    assert fixtures.contracts(spark, SF).exceptAll(layer).count() == 0
    # one number, which a radix sort orders without reading the rows
    plan = spark.range(1).selectExpr("'x' as departamento", "date'2020-01-01' as fecha_inicio").select(warehouse.by_department_and_date().alias("k"))
    assert dict(plan.dtypes) == {"k": "bigint"}
