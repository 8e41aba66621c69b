"""Mixing sources to target weights by Pareto order sampling.

Every source gets a share of all words by its weight, at most ``most`` times
its own size; what a full source cannot take is reshared by weight among the
others, until none is above its limit. With ``r = target / size`` each of its
documents is taken ``floor(r)`` times for certain. The rest is a sample
without replacement of a fixed size in words: documents are ranked by random
odds over inclusion odds, ``(u / (1 - u)) / (p / (1 - p))``, with unequal
inclusion probabilities ``p`` proportional to a power of the document's size
(and to a weight column, if given), and taken in that order until the
source's words are used up; the document at the boundary goes to the nearer
side. So a source misses its target by half a document at most.

The running total of words in rank order is taken in two steps, so a source
that holds most of the rows is never ordered in one task: words are added up
per source and rank bucket (equal parts of rank / (1 + rank)), the bucket
that reaches the limit is found on those sums, first among 256 spans of
buckets, then among the 256 buckets of one span, and only its documents are
ordered (the ranks at the limit are near 1, where a bucket holds about one
part in 65,536 of a source).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import shared
from .util import join_counted

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1.0, 2.0, 3.0)
MOST = 3.0
SIZE_POWER = 0.5
BUCKETS = 1 << 16
SPAN = 1 << 8  # buckets of a span


def n_words(text):
    """Number of words (0 for null): runs are shortened to one character
    first, so the count is a difference of lengths."""
    once = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), WORD, "\x01")
    # spaces go, other control characters cannot be there any more
    return F.length(F.translate(once, " \t\n\x0b\x0c\r", "")).cast("long")


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.0, most: float = MOST) -> DataFrame:
    """``target`` of each row of ``sources(source, source_size)``, ordered by
    code point, null last, with the weights repeating in that order.

    The fixed point of resharing is ``min(most * size, level * weight)``: in
    order of ``most * size / weight`` a prefix of the sources is full, and
    the level is what is left over the other weights. One row per source, so
    a window over all of them is small; documents are never in it.
    """
    rank = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(rank) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sources.withColumn("weight", w).withColumn("limit", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    s = s.withColumn("level", (F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(onward))
    # the first source whose limit is above its part at that level sets the level for all after it
    s = s.withColumn("level", F.min(F.when(F.col("limit") >= F.col("level") * F.col("weight"), F.struct(F.col("limit") / F.col("weight"), "level"))).over(everything)["level"])
    return s.select("source", "source_size", F.coalesce(F.least("limit", F.col("level") * F.col("weight")), F.col("limit")).alias("target"))


def uniform(doc_id, seed: int):
    """A number in (0, 1) from the md5 of seed and id: the same in every run."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))


def _power(x, by: float):
    return F.sqrt(x) if by == 0.5 else F.pow(x, F.lit(by))


def _reached(sums: DataFrame, key: str) -> DataFrame:
    """``of`` (source), ``key`` at which ``before`` and the running words reach
    the source's limit, and ``before`` it; a window of at most ``BUCKETS /
    SPAN`` or ``SPAN`` rows."""
    run = Window.partitionBy("source").orderBy(key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    over = sums.withColumn("upto", F.col("before") + F.sum("words").over(run)).where(F.col("upto") >= F.col("limit"))
    first = over.groupBy("source").agg(F.min(F.struct(key, (F.col("upto") - F.col("words")).alias("before"))).alias("c"))
    return first.select(F.col("source").alias("of"), F.col(f"c.{key}").alias(key), F.col("c.before").alias("before"))


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", weights: tuple[float, ...] = WEIGHTS,
        share: float = 1.0, most: float = MOST, size_power: float = SIZE_POWER, weight: str | None = None, seed: int = 42) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``source``, ``size`` (words),
    ``source_size``, ``target``, ``copies``, ``taken`` (copies times size),
    and what the choice came from (``certain``, ``inclusion``, ``rank``).

    A null text has size 0; documents of size 0 are taken 0 words and as many
    copies as certain. A null source is a source of its own, the last. Rows
    that repeat an id share its random number; such ties are ordered by size
    (equal rows may be told apart either way, the result as a whole being the
    same). A source of size 0 has target 0. An empty table gives no row.
    """
    extra = F.col(weight).cast("double") if weight else F.lit(1.0)
    sized = shared.written(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), n_words(F.col(text)).alias("size"), extra.alias("extra")), "mix-sized")
    sized = sized.withColumn("pull", F.when(F.col("size") > 0, _power(F.col("size").cast("double"), size_power) * F.greatest(F.coalesce("extra", F.lit(0.0)), F.lit(1e-9))))
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("pull") * F.col("size")).alias("pulled"))
    sums = shared.written(sums, "mix-sums")
    plan = targets(sums.select("source", "source_size"), weights, share, most)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = plan.join(sums.select(F.col("source").alias("of"), "pulled"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    # a target that is a whole multiple up to rounding has nothing left over
    plan = plan.withColumn("certain", F.floor(ratio + F.lit(1e-9))).withColumn("part", F.greatest(ratio - F.col("certain"), F.lit(0.0)))
    plan = shared.written(plan.withColumn("part", F.when(F.col("part") < 1e-9, 0.0).otherwise(F.col("part"))), "mix-plan")
    named = plan.select(F.col("source").alias("of"), "source_size", "target", "certain", "part", "pulled")
    n = plan.count()
    d = join_counted(sized, named, F.col("source").eqNullSafe(F.col("of")), "left", n).drop("of")
    # probability of inclusion beyond the certain copies, kept inside (0, 1)
    p = F.least(F.greatest(F.col("part") * F.col("pull") * F.col("source_size") / F.col("pulled"), F.lit(1e-9)), F.lit(1 - 1e-9))
    d = d.withColumn("inclusion", F.when((F.col("part") > 0) & (F.col("size") > 0), p))
    u = uniform(F.col("doc_id"), seed)
    d = d.withColumn("rank", F.when(F.col("inclusion").isNotNull(), (u / (1 - u)) / (F.col("inclusion") / (1 - F.col("inclusion")))))
    spread = F.col("rank") / (1 + F.col("rank"))
    d = d.withColumn("bucket", F.when(F.col("rank").isNotNull(), F.least(F.floor(spread * F.lit(BUCKETS)), F.lit(BUCKETS - 1)).cast("int")))
    per = d.where("bucket is not null").groupBy("source", "bucket").agg(F.sum("size").alias("words"), F.max(F.col("part") * F.col("source_size")).alias("limit"))
    per = shared.written(per.withColumn("span", F.floor(F.col("bucket") / SPAN)), "mix-buckets")
    spans = per.groupBy("source", "span").agg(F.sum("words").alias("words"), F.max("limit").alias("limit"))
    at_span = shared.written(_reached(spans.withColumn("before", F.lit(0).cast("long")), "span"), "mix-spans")
    inner = join_counted(per.withColumnRenamed("span", "of_span"), at_span, F.col("source").eqNullSafe(F.col("of")) & (F.col("of_span") == F.col("span")), "inner", n)
    cut = shared.written(_reached(inner.drop("of", "of_span", "span"), "bucket").withColumnRenamed("bucket", "cut"), "mix-cut")
    d = join_counted(d, cut, F.col("source").eqNullSafe(F.col("of")), "left", n).drop("of")
    # only the documents of one bucket per source are ordered
    limit = F.col("part") * F.col("source_size")
    edge = Window.partitionBy("source").orderBy("rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at_cut = F.coalesce(F.col("bucket") == F.col("cut"), F.lit(False))
    # the boundary document is in if half of it or more is below the limit
    inside = d.where(at_cut).withColumn("upto", F.col("before") + F.sum("size").over(edge)).withColumn("chosen", F.col("upto") - F.col("size") / 2 <= limit).drop("upto")
    others = d.where(~at_cut).withColumn("chosen", F.when(F.col("bucket").isNull(), False).when(F.col("cut").isNull(), True).otherwise(F.col("bucket") < F.col("cut")))
    d = others.unionByName(inside)
    copies = (F.col("certain") + F.col("chosen").cast("int")).cast("long")
    return d.withColumn("copies", copies).select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "certain", "inclusion", "rank")
