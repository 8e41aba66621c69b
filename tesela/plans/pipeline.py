"""JOB-05: the phase runner (extract / transform / consolidate / load /
marts / all) over landed files.

Every phase reads tables or folders the previous phase wrote, so a phase
can run alone. Each item of a phase leaves a marker with its row counts,
taken while it was written; a failed run that is resumed goes on with the
first item that has none.
Contract and education drops are extracted, cleaned (JOB-01, JOB-02) and
loaded; the contracts are consolidated, and the marts are built from the
loaded ``clean.secop_ii``.
Paths are under one root (on a cluster: shared storage). The extract phase
here reads already-landed files; fetching them over HTTP is out of scope.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import marts
from ..sources import landed, sinks
from ..sources.publish import Markers, counted, files_of
from . import jobs

PHASES = ["extract", "transform", "consolidate", "load", "marts"]
MASTER_TABLE = "clean.secop_ii"


@dataclass
class Layout:
    root: str

    def raw(self, ds: str) -> str:
        return f"{self.root}/raw/{ds}"

    def clean(self, ds: str) -> str:
        return f"{self.root}/clean/{ds}"

    def clean_spark(self, ds: str) -> str:
        return f"{self.root}/clean_spark/{ds}"

    def export(self, ds: str) -> str:
        return f"{self.root}/export/{ds}"

    @property
    def consolidated(self) -> str:
        return f"{self.root}/export/consolidated"

    @property
    def warehouse(self) -> str:
        return f"{self.root}/warehouse"


def extract(spark: SparkSession, landing: dict[str, str], lay: Layout, snapshot_date: str, marks: Markers) -> dict[str, int]:
    """Landed CSV drops -> dated raw snapshots (all text, pandas NA rules)."""
    def one(ds: str, path: str) -> dict[str, int]:
        df = landed.read_csv_text(spark, path)
        return {ds: counted(df, lambda d: sinks.write_snapshot(d, lay.raw(ds), snapshot_date))["rows"]}

    out = {}
    for ds, path in landing.items():
        out |= marks.do("extract", ds, [snapshot_date, files_of(spark, path)], lambda: one(ds, path))  # noqa: B023
    return out


def transform(spark: SparkSession, datasets: list[str], education: list[str], lay: Layout,
              snapshot_date: str, marks: Markers) -> dict[str, int]:
    """JOB-01 per contract dataset, JOB-02 per education dataset -> clean
    Parquet + export CSV (one computation)."""
    def one(ds: str) -> dict[str, int]:
        raw = spark.read.parquet(f"{lay.raw(ds)}/snapshot_date={snapshot_date}")
        cleaned = jobs.clean_education(raw) if ds in education else jobs.clean_contracts(raw)
        rows = counted(cleaned, lambda d: d.write.mode("overwrite").parquet(lay.clean(ds)))["rows"]
        sinks.export_clean(spark, lay.clean(ds), lay.export(ds))
        return {ds: rows}

    out = {}
    for ds in [*datasets, *education]:
        out |= marks.do("transform", ds, [marks.id("extract", ds)], lambda: one(ds))  # noqa: B023
    return out


def transform_spark(spark: SparkSession, datasets: list[str], education: list[str], lay: Layout,
                    snapshot_date: str, marks: Markers) -> dict[str, int]:
    """The Spark variant (JOB-03) to Parquet in a folder of its own, which no
    later phase reads; as in the source, education passes through."""
    def one(ds: str) -> dict[str, int]:
        raw = spark.read.parquet(f"{lay.raw(ds)}/snapshot_date={snapshot_date}")
        cleaned = raw if ds in education else jobs.clean_contracts_spark_variant(raw)
        return {ds: counted(cleaned, lambda d: sinks.write_parquet(d, lay.clean_spark(ds)))["rows"]}

    out = {}
    for ds in [*datasets, *education]:
        out |= marks.do("transform_spark", ds, [marks.id("extract", ds)], lambda: one(ds))  # noqa: B023
    return out


def consolidate(spark: SparkSession, datasets: list[str], lay: Layout, date_str: str, marks: Markers) -> dict[str, int]:
    """JOB-04 over the clean outputs, published under its date and as latest;
    the per-origin row counts (QRY-47) are taken while it is written."""
    def work() -> dict[str, int]:
        cons = jobs.consolidate({ds: spark.read.parquet(lay.clean(ds)) for ds in datasets})
        origins = sorted({jobs.SOURCE_RENAMES[ds][1] for ds in datasets})
        seen = sinks.write_dated_and_latest(cons, lay.consolidated, date_str, {o: F.col("origen") == o for o in origins})["counts"]
        return {o: seen[o] for o in origins if seen[o]}

    return marks.do("consolidate", "consolidated", [date_str, *[marks.id("transform", ds) for ds in datasets]], work)


def as_loaded(clean: DataFrame) -> DataFrame:
    """What a load of the CSV copy gives: missing-value tokens null, dates text."""
    text = {c: F.col(c).cast("string") for c, t in clean.dtypes if t in ("string", "date")}
    return clean.withColumns({c: F.when(~x.isin(list(landed.PANDAS_NA_TOKENS)), x) for c, x in text.items()})


def load(spark: SparkSession, datasets: list[str], lay: Layout, marks: Markers) -> dict[str, int]:
    """Clean outputs as ``clean.<dataset>`` tables (replace-load), as a load
    of the CSV copies gives them: missing-value tokens null, dates text."""
    sinks.init_schemas(spark, location=lay.warehouse)

    def one(ds: str) -> dict[str, int]:
        clean = as_loaded(spark.read.parquet(lay.clean(ds)))
        return {f"clean.{ds}": counted(clean, lambda d: sinks.load_as_table(d, ds, "clean"))["rows"]}

    out = {}
    for ds in datasets:
        # a catalog that forgot the table (a new session) is loaded again
        known = marks.id("transform", ds) if spark.catalog.tableExists(f"clean.{ds}") else uuid.uuid4().hex
        out |= marks.do("load", ds, [known], lambda: one(ds))  # noqa: B023
    return out


def build_marts(spark: SparkSession, lay: Layout, marks: Markers) -> dict[str, int]:
    """MRT-01 ... MRT-05 as ``marts.*`` tables (DROP + CTAS) from what the
    load phase wrote."""
    if not spark.catalog.tableExists(MASTER_TABLE):
        raise ValueError(f"marts need {MASTER_TABLE}; run the load phase first")
    sinks.init_schemas(spark, ["marts"], location=lay.warehouse)
    out = {}

    def table(name: str, build: Callable[[], DataFrame], inputs: list[str | None]) -> None:
        known = inputs if spark.catalog.tableExists(name) else [uuid.uuid4().hex]
        out.update(marks.do("marts", name, known, lambda: {name: counted(build(), lambda d: sinks.rebuild_table(d, name))["rows"]}))

    table("marts.contratacion", lambda: marts.master(spark.table(MASTER_TABLE)), [marks.id("load", MASTER_TABLE.split(".")[1])])
    m = spark.table("marts.contratacion")
    for name, build in (("marts.resumen_departamento", marts.resumen_departamento), ("marts.resumen_entidad", marts.resumen_entidad),
                        ("marts.resumen_sector", marts.resumen_sector), ("marts.resumen_tipo_proceso", marts.resumen_tipo_proceso)):
        table(name, lambda: build(m), [marks.id("marts", "marts.contratacion")])  # noqa: B023
    return out


def run(spark: SparkSession, phase: str, landing: dict[str, str], root: str,
        snapshot_date: str = "20240101", education: dict[str, str] | None = None,
        spark_variant: bool = False, resume: bool = False) -> DataFrame:
    """Run one phase or ``all``; returns ``(phase, item, rows)``.

    With ``resume`` an item that ended in an earlier run over the same root,
    and whose inputs are still those it was made from, is not done again.

    ``landing`` and ``education`` are the landed contract and education
    datasets by name. ``spark_variant`` cleans with JOB-03 in the transform
    phase; it is an option of that phase only.
    """
    if phase not in [*PHASES, "all"]:
        raise ValueError(f"unknown phase {phase!r}")
    if spark_variant and phase != "transform":
        raise ValueError("spark_variant is an option of the transform phase")
    lay = Layout(root.rstrip("/"))
    education = education or {}
    if both := set(landing) & set(education):
        raise ValueError(f"contract and education datasets of one name: {sorted(both)}")
    contracts, schools = list(landing), list(education)
    marks = Markers(spark, lay.root, resume)
    rows: list[tuple[str, str, int]] = []
    for p in PHASES if phase == "all" else [phase]:
        if p == "extract":
            res = extract(spark, {**landing, **education}, lay, snapshot_date, marks)
        elif p == "transform":
            clean = transform_spark if spark_variant else transform
            res = clean(spark, contracts, schools, lay, snapshot_date, marks)
        elif p == "consolidate":
            res = consolidate(spark, contracts, lay, snapshot_date, marks)
        elif p == "load":
            res = load(spark, [*contracts, *schools], lay, marks)
        else:
            res = build_marts(spark, lay, marks)
        rows += [(p, k, int(v)) for k, v in res.items()]
    return spark.createDataFrame(rows, "phase string, item string, rows long").withColumn(
        "rows", F.col("rows").cast("long"))
