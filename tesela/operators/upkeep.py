"""Keeping the summary marts up to date from snapshots (MRT-02 ... MRT-06).

A rebuild reads the whole master. Here each snapshot of new rows leaves
partial aggregates of its own, a published version per state and snapshot,
and the marts are merged from all of them when they are read. Counts and sums
add up, first and last dates are least and greatest, and distinct counts come
from states that hold one row per distinct value.

A snapshot that is applied again replaces what it left before, in one step.
So a stream's micro-batch that is repeated after a failure (same epoch
number) counts once.

States: ``ent`` per (entity, department, raw sector), which MRT-02 and MRT-03
need; ``sec`` per raw sector; ``cat`` per (entity, process, modality) for the
catalogue; ``proc`` per process. A snapshot's rows are read for ``ent`` and
``cat`` only: ``sec`` and ``proc`` add up what these two hold.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..sources import publish
from . import marts
from .aggregates import avg_2_of, order_limit

_COUNTS = {"n": F.sum, "valued": F.sum, "value": F.sum}
_DATES = {"first": F.min, "last": F.max}


def _money() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.count("valor_contrato").alias("valued"), F.sum("valor_contrato").alias("value")]


#: Per state read from master rows its partial form, its keys, and how its columns merge.
STATES: dict[str, tuple[Callable[[DataFrame], DataFrame], list[str], dict[str, Callable]]] = {
    "ent": (lambda m: m.groupBy("nombre_entidad", C.no_info("departamento").alias("depto"), "sector").agg(*_money()),
            ["nombre_entidad", "depto", "sector"], _COUNTS),
    "cat": (lambda m: m.groupBy("nombre_entidad", "proceso_de_compra", "modalidad").agg(F.min("fecha_firma").alias("first"), F.max("fecha_inicio").alias("last"), *_money()),
            ["nombre_entidad", "proceso_de_compra", "modalidad"], _COUNTS | _DATES),
}
#: Per state added up from another one's rows: that one, and its key there.
SUMMED: dict[str, tuple[str, str, Callable[[], Column]]] = {
    "sec": ("ent", "sector", lambda: F.col("sector")),
    "proc": ("cat", "proceso", lambda: C.no_info("proceso_de_compra")),
}


def apply_snapshot(rows: DataFrame, root: str, snapshot: str) -> dict[str, int]:
    """Add the master rows of ``snapshot``, or replace what it left before;
    returns the rows of each state. Reads the snapshot only."""
    counts = {name: publish.publish(partial(rows), root, name, snapshot)["counts"]["rows"] for name, (partial, _, _) in STATES.items()}
    for name, (of, key, column) in SUMMED.items():
        added = _added(publish.published(rows.sparkSession, root, of, snapshot).withColumn(key, column()), [key], _COUNTS)
        counts[name] = publish.publish(added, root, name, snapshot)["counts"]["rows"]
    return counts


def _added(parts: DataFrame, keys: list[str], columns: Mapping[str, Callable]) -> DataFrame:
    """Rows of a state per ``keys``; columns keep their types."""
    kinds = dict(parts.dtypes)
    return parts.groupBy(*keys).agg(*[how(c).cast(kinds[c]).alias(c) for c, how in columns.items()])


def _parts(spark: SparkSession, root: str, name: str) -> DataFrame:
    parts = publish.published_all(spark, root, name)
    if parts is None:
        raise ValueError(f"no snapshot was applied below {root}")
    return parts


def _merged(spark: SparkSession, root: str, name: str, keys: list[str]) -> DataFrame:
    return _added(_parts(spark, root, name), keys, _COUNTS)


def resumen_departamento(spark: SparkSession, root: str) -> DataFrame:
    """MRT-02 of all snapshots."""
    ent = _merged(spark, root, "ent", ["nombre_entidad", "depto"])
    total = F.sum("value").cast(ent.schema["value"].dataType)
    return ent.groupBy("depto").agg(F.sum("n").alias("num_contratos"), total.alias("valor_total"),
                                    avg_2_of(total, F.sum("valued")).alias("valor_promedio"), F.count("nombre_entidad").alias("num_entidades"))


def resumen_entidad(spark: SparkSession, root: str, n: int = 100) -> DataFrame:
    """MRT-03 of all snapshots."""
    ent = _merged(spark, root, "ent", ["nombre_entidad", "depto"]).select("nombre_entidad", "depto", F.col("n").alias("num_contratos"), F.col("value").alias("valor_total"))
    return order_limit(ent, n, F.col("valor_total").desc(), F.col("nombre_entidad").asc(), F.col("depto").asc())


def resumen_sector(spark: SparkSession, root: str) -> DataFrame:
    """MRT-04 of all snapshots: merged on the raw sector, labelled after."""
    return _merged(spark, root, "sec", ["sector"]).select(C.no_info("sector").alias("sector"), F.col("n").alias("num_contratos"), F.col("value").alias("valor_total"),
                                              avg_2_of(F.col("value"), F.col("valued")).alias("valor_promedio"))


def resumen_tipo_proceso(spark: SparkSession, root: str) -> DataFrame:
    """MRT-05 of all snapshots."""
    return _merged(spark, root, "proc", ["proceso"]).select("proceso", F.col("n").alias("num_contratos"), F.col("value").alias("valor_total"))


#: Modalities that are kept as bits of a number, at most.
BITS = 62


def _tags(parts: DataFrame) -> Column:
    """The set of modalities, as an aggregate: a bit each, which hash
    aggregation merges in place, or an array if they are too many for that."""
    known = [r[0] for r in parts.select("modalidad").where("modalidad is not null").distinct().limit(BITS + 1).collect()]
    if len(known) > BITS:
        return F.array_sort(F.collect_set("modalidad"))
    bit = F.when(F.lit(False), F.lit(0).cast("bigint"))
    for i, modality in enumerate(sorted(known)):
        bit = bit.when(F.col("modalidad") == modality, F.lit(1 << i).cast("bigint"))
    return F.bit_or(bit.otherwise(F.lit(0).cast("bigint")))


def resumen_catalogo(spark: SparkSession, root: str, as_of: str) -> DataFrame:
    """MRT-06 of all snapshots: the catalogue's datasets first, then its organisations."""
    parts = _parts(spark, root, "cat")
    catalog = (parts.groupBy(F.col("nombre_entidad").alias("organization"), F.col("proceso_de_compra").alias("id"))
               .agg(_tags(parts).alias("tags"), F.min("first").alias("created_at"), F.max("last").alias("last_modified_at")))
    return marts.resumen_catalogo(catalog, as_of)


def follow(stream: DataFrame, root: str, to_master: Callable[[DataFrame], DataFrame] = lambda df: df) -> None:
    """Apply what a stream has that was not applied yet, a snapshot per
    micro-batch, named by its epoch."""
    def batch(df: DataFrame, epoch: int) -> None:
        apply_snapshot(to_master(df), root, f"epoch-{epoch:012d}")

    q = stream.writeStream.foreachBatch(batch).option("checkpointLocation", f"{root.rstrip('/')}/_checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()

