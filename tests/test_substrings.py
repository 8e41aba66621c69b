"""Names found through n-grams against trying every pair."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesela.operators import documents
from tesela.operators.substrings import names_in_texts


def pairs(df):
    return sorted((r["k"], r["n"]) for r in df.collect())


@pytest.mark.parametrize("with_short", [False, True])
def test_against_every_pair(spark, with_short):
    rng = np.random.default_rng(6)
    letters = list("abcñ é\U0001F600")
    texts = [(i, "".join(rng.choice(letters, rng.integers(0, 40)))) for i in range(120)] + [(500, None), (501, ""), (502, "ab"), (503, "valle del cauca")]
    names = ["".join(rng.choice(letters, rng.integers(3, 6))) for _ in range(60)] + [None, "cauca", "valle del cauca", "valle", "zzz", "abc", "abc"]
    names += ["", "a", "ñ ", "\U0001F600"] if with_short else []
    t = spark.createDataFrame(texts, "k int, t string").repartition(3)
    n = spark.createDataFrame([(x,) for x in names], "n string")
    want = sorted((k, x) for k, text in texts for x in set(names) if text is not None and x is not None and x in text)
    assert pairs(names_in_texts(t, n, "k", "t", "n")) == want
    assert pairs(names_in_texts(t, n.limit(0), "k", "t", "n")) == []
    assert pairs(names_in_texts(t.limit(0), n, "k", "t", "n")) == []


def test_no_theta_join(spark):
    t = spark.range(1000).select(F.col("id").alias("qid"), F.concat(F.lit("Pregunta sobre nation_"), (F.col("id") % 25).cast("string")).alias("question"))
    v = spark.range(500).select(F.concat(F.lit("nation_"), F.col("id").cast("string")).alias("name"))
    found = documents.detect_mentions(t, v)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    # nation_1 is also in nation_12, and so on
    assert found.count() == sum(1 for i in range(1000) for n in range(500) if f"nation_{n}" in f"nation_{i % 25}")
