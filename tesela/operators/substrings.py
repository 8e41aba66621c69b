"""Which names stand in which texts, without trying every pair (RAG-03, RAG-04).

An inverted index of character n-grams: a text holds a name only if it holds
every gram of it, so each name is looked up by one of its grams, the one that
the fewest texts hold. That is an equi-join on grams; the exact test follows
on the few pairs it leaves. Neither side has to be small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .aggregates import settled

GRAM = 3


def grams(text: Column, size: Column | int) -> Column:
    """Distinct stretches of ``size`` characters."""
    n = F.lit(size) if isinstance(size, int) else size
    starts = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - n + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, n)))


def names_in_texts(texts: DataFrame, names: DataFrame, key: str, text: str, name: str, gram: int = GRAM) -> DataFrame:
    """``(key, name)`` for every text of ``texts`` that contains a distinct
    name. Null texts and names contain and match nothing; the empty name is in
    every text, as SQL has it. ``key`` must be distinct over the texts."""
    t = texts.where(F.col(text).isNotNull()).select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    v = names.where(F.col(name).isNotNull()).select(F.col(name).alias("_name")).distinct()
    v = settled(v.withColumn("_size", F.least(F.length("_name"), F.lit(gram))))
    sizes = [r["_size"] for r in v.select("_size").distinct().collect()]  # 0 to gram
    held = None
    for size in (s for s in sizes if s > 0):
        part = t.select("_key", "_text", F.explode(grams(F.col("_text"), size)).alias("_gram"))
        held = part if held is None else held.unionByName(part)
    out = None
    if held is not None:
        # of a name's grams the one that the fewest texts hold; a name with a
        # gram that none holds is in no text
        of_name = v.where("_size > 0").select("_name", F.explode(grams(F.col("_name"), F.col("_size"))).alias("_gram"))
        often = held.groupBy("_gram").agg(F.count(F.lit(1)).alias("_texts"))
        counted = of_name.join(often, "_gram", "left").withColumn("_texts", F.coalesce("_texts", F.lit(0)))
        rarest = counted.groupBy("_name").agg(F.min(F.struct("_texts", "_gram")).alias("_r")).where("_r._texts > 0").select("_name", F.col("_r._gram").alias("_gram"))
        out = held.join(rarest, "_gram").where(F.contains("_text", "_name")).select("_key", "_name")
    if 0 in sizes:
        every = t.select("_key", F.lit("").alias("_name"))
        out = every if out is None else out.unionByName(every)
    if out is None:
        out = t.select("_key", F.lit("").alias("_name")).where(F.lit(False))
    return out.select(F.col("_key").alias(key), F.col("_name").alias(name))
