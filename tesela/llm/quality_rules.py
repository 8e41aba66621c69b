"""Quality rules with thresholds that adapt to language and source.

Every document gets a few exact measures. Per (language, source) and measure
a quantile sketch is kept: counts of logarithmic buckets of 16 steps per
doubling, so a quantile is off by 1/16 of its value at most. Sketches of this
kind merge by adding counts in any order, which is also how they are built
(map-side partial counts) and how a group with few documents falls back: to
the merged sketch of its language, then to that of all documents.

A document fails a measure beyond the fences ``median + WIDTH * spread`` and,
as a ratio so that it stays above zero, ``median / (1 + WIDTH * spread / median)``.
The spread is taken from the sketch: the distance from the median to the
quartile of that side, half the distance to the outer tenth, or one bucket
step at the median, whichever is most; there are no fixed widths. As a share
of a short text moves by a lot with one occurrence, a share fails only where
it comes from more than ``FEW`` occurrences. The thresholds are joined back
by language and source. Native functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import shared
from .util import join_counted

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
SCALE = 1000  # ratios are kept as integers per SCALE
STEPS = 16  # buckets per doubling
WIDTH = 6.0
FEW = 2  # occurrences that no share fails by
ENOUGH = 200  # documents from which a group's own sketch is used


def _ratio(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.floor(F.col(a) * SCALE / F.col(b))).otherwise(F.lit(0)).cast("long")


def measure_columns() -> dict[str, tuple[Column, Column, str]]:
    """``name: (integer measure, its occurrences are more than FEW, sides)``;
    a passage that stands twice is one occurrence of six words."""
    return {
        "word_length": (_ratio("word_chars", "n_words"), F.lit(True), "both"),
        "symbol_share": (_ratio("n_symbols", "n_words"), F.col("n_symbols") > FEW, "above"),
        "line_share": (_ratio("n_dup_lines", "n_lines"), F.col("n_dup_lines") > FEW, "above"),
        "repeat_share": (_ratio("n_repeat_words", "n_words"), F.col("n_repeat_words") > 6 * FEW, "above"),
        "capital_share": (_ratio("n_capitals", "word_chars"), F.col("n_capitals") > FEW, "above"),
    }


def counted(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and a struct ``quality`` of exact counts.

    Words are runs without white space; a null text has none. Windows of
    three words are told apart by 64-bit hashes.
    """
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    src = docs.drop("quality") if "quality" in docs.columns else docs
    src = src.withColumn("quality", F.struct(t.alias("text"), F.array_remove(F.split(t, SPACE), "").alias("words"), F.split(t, "\n").alias("lines")))
    q = F.col("quality")
    # a line with a word is not empty once its white space is gone
    filled = F.filter(q["lines"], lambda x: F.translate(x, " \t\x0b\x0c\r", "") != "")
    src = src.withColumn("quality", F.struct(
        F.size(q["words"]).cast("long").alias("n_words"), F.length(F.translate(q["text"], " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length(q["text"]) - F.length(F.translate(q["text"], SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length(q["text"]) - F.length(F.translate(q["text"], "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("long").alias("n_capitals"),
        filled.alias("filled"), F.transform(q["words"], lambda w: F.xxhash64(w)).alias("hashes")))
    h, n = F.col("quality.hashes"), F.col("quality.n_words")
    windows = F.when(n >= 3, F.transform(F.slice(h, 1, F.greatest(n - 2, F.lit(1)).cast("int")), lambda a, i: F.xxhash64(a, F.get(h, i + 1), F.get(h, i + 2))))
    src = src.withColumn("quality", F.struct("quality.n_words", "quality.word_chars", "quality.n_symbols", "quality.n_capitals",
                                             F.size("quality.filled").cast("long").alias("n_lines"), F.size(F.array_distinct("quality.filled")).cast("long").alias("n_other_lines"), windows.alias("windows")))
    w = F.col("quality.windows")
    # most texts repeat no window: only the others order their windows
    some = F.size(F.array_distinct(w)) < F.size(w)
    ordered = F.when(some, F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("x"), i.alias("i")))))
    src = src.withColumn("quality", F.struct("quality.n_words", "quality.word_chars", "quality.n_symbols", "quality.n_capitals", "quality.n_lines",
                                             (F.col("quality.n_lines") - F.col("quality.n_other_lines")).alias("n_dup_lines"), ordered.alias("ordered")))
    s = F.col("quality.ordered")
    twice = F.filter(s, lambda e, k: F.coalesce(F.get(s, k - 1)["x"] == e["x"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["x"] == e["x"], F.lit(False)))
    at = F.sort_array(F.transform(twice, lambda e: e["i"]))
    src = src.withColumn("quality", F.struct("quality.n_words", "quality.word_chars", "quality.n_symbols", "quality.n_capitals", "quality.n_lines", "quality.n_dup_lines", at.alias("at")))
    p = F.col("quality.at")
    # a window covers three words, less where the next one starts inside it
    covered = F.aggregate(F.transform(p, lambda a, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - a, F.lit(3)))), F.lit(0).cast("long"), lambda acc, x: acc + x)
    return src.withColumn("quality", F.struct("quality.n_words", "quality.word_chars", "quality.n_symbols", "quality.n_dup_lines", F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"), "quality.n_lines", "quality.n_capitals"))


def bucket(x: Column) -> Column:
    """Bucket of an integer of 0 or more: 0 to STEPS each its own, then
    STEPS per doubling; integer arithmetic only."""
    exponent = F.length(F.bin(x)) - 1
    shift = F.greatest(exponent - 4, F.lit(0)).cast("int")
    return (shift * STEPS + F.call_function("shiftright", x, shift)).cast("long")


def bucket_value(b: Column) -> Column:
    """Lower end of a bucket."""
    shift = F.greatest(F.floor(b / STEPS) - 1, F.lit(0)).cast("int")
    return F.call_function("shiftleft", b - shift * STEPS, shift).cast("double")


def thresholds(measured: DataFrame, names: list[str], enough: int = ENOUGH, width: float = WIDTH, least: dict[str, int] | None = None) -> DataFrame:
    """``lang, source, <name>_low, <name>_high`` per group of ``measured``.

    One pass makes the sketches of all groups (rows: group x bucket); the
    ones of languages and of everything are sums of those rows. ``least``
    gives least spreads by name, none if not given.
    """
    cuts = {"t1": 2, "b1": 5, "b2": 10, "b3": 15, "t9": 18}  # quantiles in twentieths
    pairs = F.explode(F.array(*(F.struct(F.lit(n).alias("name"), bucket(F.col(n)).alias("bucket")) for n in names)))
    sketch = measured.select("lang", "source", pairs.alias("e")).groupBy("lang", "source", F.col("e.name").alias("name"), F.col("e.bucket").alias("bucket")).agg(F.count("*").alias("n"))
    sketch = shared.written(sketch, "sketch")
    of_lang = sketch.groupBy("lang", "name", "bucket").agg(F.sum("n").alias("n"))
    of_all = of_lang.groupBy("name", "bucket").agg(F.sum("n").alias("n"))

    def quantiles(s: DataFrame, keys: list[str]) -> DataFrame:
        w = Window.partitionBy(*keys, "name")
        run = s.withColumn("upto", F.sum("n").over(w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow))).withColumn("all", F.sum("n").over(w))
        first = [F.min(F.when(F.col("upto") * 20 >= F.col("all") * k, F.col("bucket"))).alias(c) for c, k in cuts.items()]
        return run.groupBy(*keys, "name").agg(F.max("all").alias("docs"), *first)

    own = quantiles(sketch, ["lang", "source"])
    lang = quantiles(of_lang, ["lang"]).select(F.col("lang").alias("lang_"), F.col("name").alias("name_"), *(F.col(c).alias(f"l_{c}") for c in ("docs", *cuts)))
    every = quantiles(of_all, []).select(F.col("name").alias("every"), *(F.col(c).alias(f"a_{c}") for c in cuts))
    q = own.join(lang, F.col("lang").eqNullSafe(F.col("lang_")) & (F.col("name") == F.col("name_"))).join(every, F.col("name") == F.col("every"))
    pick = {c: F.when(F.col("docs") >= enough, F.col(c)).when(F.col("l_docs") >= enough, F.col(f"l_{c}")).otherwise(F.col(f"a_{c}")) for c in cuts}
    q = q.select("lang", "source", "name", *(bucket_value(v).alias(k) for k, v in pick.items()), (bucket_value(pick["b2"] + 1) - bucket_value(pick["b2"])).alias("step"))
    floor = reduce(lambda acc, kv: F.when(F.col("name") == kv[0], F.lit(float(kv[1]))).otherwise(acc), (least or {}).items(), F.lit(0.0))
    below = F.greatest(F.col("b2") - F.col("b1"), (F.col("b2") - F.col("t1")) / 2, F.col("step"), floor)
    above = F.greatest(F.col("b3") - F.col("b2"), (F.col("t9") - F.col("b2")) / 2, F.col("step"), floor)
    q = q.withColumn("low", F.col("b2") * F.col("b2") / (F.col("b2") + width * below)).withColumn("high", F.col("b2") + width * above)
    return q.groupBy("lang", "source").agg(*(F.max(F.when(F.col("name") == n, F.col(c))).alias(f"{n}_{c}") for n in names for c in ("low", "high")))


def judge(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang", source: str = "source", min_words: int = 50, enough: int = ENOUGH) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``lang``, ``source``, the
    counts, ``base_failed``, ``failed`` (names of the measures beyond their
    fences) and ``kept``.

    A null language or source is a group of its own. Documents of fewer than
    ``min_words`` words fail the base rule and stay out of the sketches, as
    shares of a few words say little. Repeated rows count as often as they
    stand there; an empty table gives no row.
    """
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")
    flat = counted(docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).cast("string").alias("lang"), F.col(source).cast("string").alias("source"), F.col(text).alias("text")))
    flat = flat.select("doc_id", "lang", "source", *(f"quality.{c}" for c in counts))
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    flat = shared.written(flat.withColumn("base_failed", base), "quality-counts")
    spec = measure_columns()
    flat = flat.select("*", *(c.alias(n) for n, (c, _, _) in spec.items()))
    limits = shared.written(thresholds(flat.where(F.col("n_words") >= min_words), list(spec), enough), "quality-limits")
    limits = limits.withColumnsRenamed({"lang": "lang_", "source": "source_"})
    out = join_counted(flat, limits, F.col("lang").eqNullSafe(F.col("lang_")) & F.col("source").eqNullSafe(F.col("source_")))
    beyond = [F.when(F.coalesce(((F.col(n) > F.col(f"{n}_high")) & many) | ((F.col(n) < F.col(f"{n}_low")) if sides == "both" else F.lit(False)), F.lit(False)), F.lit(n)) for n, (_, many, sides) in spec.items()]
    failed = F.filter(F.array(*beyond), lambda x: x.isNotNull())
    return out.select("doc_id", "lang", "source", *counts, "base_failed", failed.alias("failed"), (~F.col("base_failed") & (F.size(failed) == 0)).alias("kept"))
