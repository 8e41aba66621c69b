"""Publishing by pointer, counted writes, and runs taken up again."""

import os

import pytest
from pyspark.sql import functions as F

from tesela.plans import pipeline
from tesela.sources import publish, sinks


def test_readers_find_the_old_or_the_new_version(spark, tmpdir_path):
    root = f"{tmpdir_path}/out"
    with pytest.raises(ValueError):
        publish.published(spark, root, "t")
    first = publish.publish(spark.range(10), root, "t", "d1", {"even": F.col("id") % 2 == 0})
    assert first["counts"] == {"rows": 10, "even": 5}
    old = publish.published(spark, root, "t")

    # a write that ends half-way: data of some tasks, no pointer
    bad = spark.range(20).select(F.when(F.col("id") < 15, F.col("id")).otherwise(F.raise_error(F.lit("stop")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        publish.publish(bad, root, "t", "d2")
    assert publish.published(spark, root, "t").count() == 10
    with pytest.raises(ValueError):
        publish.published(spark, root, "t", "d2")
    publish.publish(spark.range(7), root, "t", "d2")
    assert (old.count(), publish.published(spark, root, "t").count()) == (10, 7)  # who read the old one still does
    publish.publish(spark.range(8), root, "t", "d1")  # the same date again
    assert [publish.published(spark, root, "t", x).count() for x in ("d1", "d2", "latest")] == [8, 7, 8]
    assert not [f for f in os.listdir(root) if not f.endswith(".json") and "versions" not in f and not f.endswith(".crc")]
    assert len(publish.drop_unreferenced(spark, root, "t")) >= 1
    assert [publish.published(spark, root, "t", x).count() for x in ("d1", "d2", "latest")] == [8, 7, 8]
    assert publish.publish(spark.range(0), root, "t", "d3")["counts"] == {"rows": 0}


def test_a_run_is_taken_up_where_it_ended(spark, tmp_path, monkeypatch):
    for ds, ids in (("secop_ii", "ab"), ("secop_integrado", "cd")):
        (tmp_path / ds).mkdir()
        name = "id_contrato,nombre_entidad,nit_entidad,departamento,valor_del_contrato,fecha_de_firma,proceso_de_compra,sector" if ds == "secop_ii" else "numero_del_contrato,nombre_de_la_entidad,nit_de_la_entidad,departamento_entidad,valor_contrato,fecha_de_firma,proceso,sector"
        (tmp_path / ds / "a.csv").write_text(name + "\n" + "".join(f"{i},uno,80{k}-1,bogota,$ {k + 1}00,2024-01-02,P,salud\n" for k, i in enumerate(ids)))
    landing, root = {ds: str(tmp_path / ds) for ds in ("secop_ii", "secop_integrado")}, str(tmp_path / "run")
    spark.sql("drop table if exists clean.secop_ii")
    done = []
    clean, export = pipeline.jobs.clean_contracts, sinks.export_clean
    monkeypatch.setattr(pipeline.jobs, "clean_contracts", lambda df: done.append("clean") or clean(df))

    def fails_second(s, a, b):
        if "integrado" in a:
            raise RuntimeError("lost")
        return export(s, a, b)

    monkeypatch.setattr(sinks, "export_clean", fails_second)
    with pytest.raises(RuntimeError):
        pipeline.run(spark, "all", landing, root, resume=True)
    assert done == ["clean", "clean"]
    monkeypatch.setattr(sinks, "export_clean", export)
    read = []
    csv = pipeline.landed.read_csv_text
    monkeypatch.setattr(pipeline.landed, "read_csv_text", lambda s, p, *a: read.append(p) or csv(s, p, *a))
    report = pipeline.run(spark, "all", landing, root, resume=True)
    assert read == [] and done == ["clean"] * 3  # only the item that did not end
    rows = {(r["phase"], r["item"]): r["rows"] for r in report.collect()}
    assert rows[("extract", "secop_ii")] == 2 and rows[("transform", "secop_integrado")] == 2 and rows[("consolidate", "SECOP_II")] == 2
    assert rows[("marts", "marts.contratacion")] == 2
    again = {(r["phase"], r["item"]): r["rows"] for r in pipeline.run(spark, "all", landing, root, resume=True).collect()}
    assert again == rows and done == ["clean"] * 3
    # another landed file: its dataset and what comes from it are done again, the other is not
    (tmp_path / "secop_ii" / "b.csv").write_text("id_contrato,nombre_entidad,nit_entidad,departamento,valor_del_contrato,fecha_de_firma,proceso_de_compra,sector\nz,dos,809-1,meta,$ 500,2024-01-02,P,\n")
    more = {(r["phase"], r["item"]): r["rows"] for r in pipeline.run(spark, "all", landing, root, resume=True).collect()}
    assert read == [landing["secop_ii"]] and done == ["clean"] * 4
    assert more[("extract", "secop_ii")] == 3 and more[("marts", "marts.contratacion")] == 3 and more[("extract", "secop_integrado")] == 2
    whole = {(r["phase"], r["item"]): r["rows"] for r in pipeline.run(spark, "all", landing, root).collect()}
    assert whole == more and len(done) == 6  # without resume all is done
    assert sinks.read_consolidated(spark, f"{root}/export/consolidated").count() == 5
