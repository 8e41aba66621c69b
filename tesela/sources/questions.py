"""Question batches and the department vocabulary, derived from the
driver's ``nation`` and ``region`` tables (the vocabulary is
``lower(n_name)``; ``nation_1`` is a substring of ``nation_10`` ...
``nation_19``, which exercises the over-match of substring detection)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One question per department, one naming two departments per region
    and one naming none per region (the fallback path)."""
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    per_dept = nation.select(
        F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("qid"),
        F.concat(F.lit("¿Cuántos contratos hay en "), F.col("n_name"), F.lit("?")).alias("question"))
    pairs = (region.join(nation, F.col("n_regionkey") == F.col("r_regionkey"))
             .groupBy("r_regionkey", "r_name")
             .agg(F.min("n_name").alias("a"), F.max("n_name").alias("b"))
             .select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string"), F.lit("-par")).alias("qid"),
                     F.concat(F.lit("Compara "), F.col("a"), F.lit(" y "), F.col("b"), F.lit(" en "),
                              F.col("r_name")).alias("question")))
    none = region.select(
        F.concat(F.lit("r"), F.col("r_regionkey").cast("string"), F.lit("-sin")).alias("qid"),
        F.concat(F.lit("¿Qué entidades contratan más en la región "), F.col("r_name"), F.lit("?")).alias("question"))
    return per_dept.unionByName(pairs).unionByName(none)


def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "nation", "n_name").select(F.lower("n_name").alias("name")).distinct()


QUESTIONS_SQL = """
select concat('n', cast(n_nationkey as varchar)) as qid, concat('¿Cuántos contratos hay en ', n_name, '?') as question
from nation
union all
select concat('r', cast(r_regionkey as varchar), '-par') as qid,
  concat('Compara ', min(n_name), ' y ', max(n_name), ' en ', r_name) as question
from region join nation on n_regionkey = r_regionkey group by r_regionkey, r_name
union all
select concat('r', cast(r_regionkey as varchar), '-sin') as qid,
  concat('¿Qué entidades contratan más en la región ', r_name, '?') as question
from region
"""

VOCABULARY_SQL = "select distinct lower(n_name) as name from nation"
