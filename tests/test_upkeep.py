"""Marts kept from snapshots equal a rebuild, whatever is repeated."""

import datetime as dt
import decimal

import pytest

from tesela.operators import marts, upkeep

SCHEMA = ("id_contrato string, nombre_entidad string, departamento string, sector string, proceso_de_compra string, modalidad string, "
          "fecha_firma date, fecha_inicio date, valor_contrato decimal(20,2), proveedor string")
AS_OF = "2024-03-01"


def rows_of(n, shift=0):
    out = []
    for i in range(shift, shift + n):
        day = dt.date(2024, 1, 1) + dt.timedelta(days=i % 80) if i % 9 else None
        out.append((f"c{i}", None if i % 13 == 0 else f"e{i % 7}", [None, "Sin info", "a", "b"][i % 4], [None, "Sin info", "x"][i % 3], None if i % 5 == 0 else f"p{i % 17}",
                    [None, "m1", "m2"][i % 3], day, day, decimal.Decimal(f"{i * 37 % 1000 + 1}.{i % 100:02d}"), "s"))
    return out


def whole(spark, df):
    return {"dep": marts.resumen_departamento(df), "ent": marts.resumen_entidad(df, 10), "sec": marts.resumen_sector(df), "proc": marts.resumen_tipo_proceso(df),
            "cat": marts.resumen_catalogo(marts.catalog_from_master(df), AS_OF)}


def kept(spark, root):
    return {"dep": upkeep.resumen_departamento(spark, root), "ent": upkeep.resumen_entidad(spark, root, 10), "sec": upkeep.resumen_sector(spark, root),
            "proc": upkeep.resumen_tipo_proceso(spark, root), "cat": upkeep.resumen_catalogo(spark, root, AS_OF)}


def same(a, b):
    for name in a:
        assert a[name].columns == b[name].columns, name
        assert [t for _, t in a[name].dtypes] == [t for _, t in b[name].dtypes], name
        assert sorted(map(str, a[name].collect())) == sorted(map(str, b[name].collect())), name


def test_snapshots_and_a_rerun_equal_a_rebuild(spark, tmpdir_path):
    root = f"{tmpdir_path}/state"
    with pytest.raises(ValueError):
        upkeep.resumen_departamento(spark, root)
    parts = [spark.createDataFrame(rows_of(200, k * 200), SCHEMA) for k in range(3)]
    for k in (0, 1):
        upkeep.apply_snapshot(parts[k], root, f"2024-0{k + 1}")
    same(kept(spark, root), whole(spark, parts[0].unionByName(parts[1])))
    upkeep.apply_snapshot(parts[2].limit(30), root, "2024-03")  # corrected by a rerun
    upkeep.apply_snapshot(parts[2], root, "2024-03")
    upkeep.apply_snapshot(parts[0], root, "2024-01")
    upkeep.apply_snapshot(parts[0].limit(0), root, "2024-04")
    same(kept(spark, root), whole(spark, parts[0].unionByName(parts[1]).unionByName(parts[2])))


def test_repeated_epochs_count_once(spark, tmpdir_path):
    src, root = f"{tmpdir_path}/in", f"{tmpdir_path}/state"
    parts = [spark.createDataFrame(rows_of(150, k * 150), SCHEMA) for k in range(2)]
    parts[0].write.parquet(f"{src}/a")
    stream = spark.readStream.schema(parts[0].schema).option("recursiveFileLookup", True).parquet(src)
    upkeep.follow(stream, root)
    same(kept(spark, root), whole(spark, parts[0]))
    parts[1].write.parquet(f"{src}/b")
    upkeep.follow(stream, root)
    upkeep.follow(stream, root)  # nothing new
    both = parts[0].unionByName(parts[1])
    same(kept(spark, root), whole(spark, both))
    upkeep.apply_snapshot(parts[1], root, f"epoch-{1:012d}")  # the epoch once more, as after a failure
    same(kept(spark, root), whole(spark, both))


def test_a_snapshot_is_read_for_two_states(spark, tmpdir_path, monkeypatch):
    spark.createDataFrame(rows_of(300), SCHEMA).write.parquet(f"{tmpdir_path}/rows")
    read, publish = {}, upkeep.publish.publish
    monkeypatch.setattr(upkeep.publish, "publish", lambda df, root, name, date: (
        read.__setitem__(name, any(f"{tmpdir_path}/rows" in f for f in df.inputFiles())), publish(df, root, name, date))[1])
    df = spark.read.parquet(f"{tmpdir_path}/rows")
    counts = upkeep.apply_snapshot(df, f"{tmpdir_path}/state", "s")
    assert read == {"ent": True, "cat": True, "sec": False, "proc": False}
    assert counts["sec"] == marts.resumen_sector(df).count() and counts["proc"] == marts.resumen_tipo_proceso(df).count()


def test_more_modalities_than_bits(spark, tmpdir_path, monkeypatch):
    df = spark.createDataFrame(rows_of(300), SCHEMA)
    upkeep.apply_snapshot(df, tmpdir_path, "s")
    want = sorted(map(str, marts.resumen_catalogo(marts.catalog_from_master(df), AS_OF).collect()))
    for bits in (2, 1, 0):  # there are two modalities, and none
        monkeypatch.setattr(upkeep, "BITS", bits)
        got = upkeep.resumen_catalogo(spark, tmpdir_path, AS_OF)
        assert ("bit_or" in got._jdf.queryExecution().optimizedPlan().toString()) == (bits == 2)
        assert sorted(map(str, got.collect())) == want
