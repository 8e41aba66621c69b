"""The corpus pipeline: five stages over ``documents``, each an operator of
``tesela.llm``.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``. Null ids, texts and groups, empty
tables, repeated rows and extra columns are treated as the operators state;
extra columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesela.llm import cnn_toxicity, decontaminate, icws_dedup, mil_quality, pareto_mix, shared
from tesela.llm.util import fresh, ship, table

TOXIC = 0.7
GOOD = 0.3


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    ship(spark)
    model = cnn_toxicity.train(docs, table(spark, sf_dir, "labels"))
    name = fresh(docs, "toxicity_score")
    return cnn_toxicity.score(docs, model, name=name).where(F.col(name) < TOXIC).select(*docs.columns)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    ship(spark)
    model = mil_quality.train(docs, table(spark, sf_dir, "labels"))
    name = fresh(docs, "quality_score")
    return mil_quality.score(docs, model, name=name).where(F.col(name) >= GOOD).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    ship(spark)
    return icws_dedup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; spans of benchmark windows go from the rest,
    whose ``n_chars`` then is the length of what is left."""
    ship(spark)
    p = "decontaminate_"
    while any(c.startswith(p) for c in docs.columns):
        p += "_"
    out = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), prefix=p)
    hit = F.col(p + "n_hit") > 0
    text = F.when(hit, F.col(p + "clean_text")).otherwise(F.col("text"))
    new = {"text": text, "n_chars": F.when(hit, F.length(F.col(p + "clean_text"))).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)}
    return out.where(~decontaminate.contaminated(p + "n_hit", p + "n_words")).select(*(new[c].alias(c) if c in new else F.col(c) for c in docs.columns))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix: ``doc_id, source, size, source_size, target,
    copies, taken``, without those that the mix takes no copy of."""
    out = pareto_mix.mix(docs).where("copies > 0")
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


STAGES = [("toxicity", toxicity), ("quality classifier", quality_classifier), ("near duplicates", near_duplicates),
          ("benchmark decontamination", decontamination), ("mixing sources", source_mixing)]

#: Classifiers and sampled signatures have no SQL form; tests hold the
#: decontamination stage against brute force and check columns, subsets and
#: counts of the others.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = shared.new_folder(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        docs = shared.written(stage(spark, docs, sf_dir), f"stage-{k}", folder)
    return docs
