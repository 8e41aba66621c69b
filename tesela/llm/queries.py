"""Registered queries of the operators, and their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import cnn_toxicity, collocations, decontaminate, ffd_pack, icws_dedup, kn_lm, license_join, mil_quality, pareto_mix, quality_rules, token_align, url_templates, warc_chain
from .util import fold, ship, table

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = mil_quality.train(docs, labels, when=fold("sample_id", 5) != 0)
    out = mil_quality.score(docs.select("doc_id", "text"), model, name="score")
    return out.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_join.digest(license_join.scan(docs))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = kn_lm.train(docs, when=fold("doc_id", 7) != 2)
    return kn_lm.score(docs, model).select("doc_id", (fold("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score", "perplexity")


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pareto_mix.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.judge(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = cnn_toxicity.train(docs, labels, when=fold("sample_id", 3) != 1)
    out = cnn_toxicity.score(docs.select("doc_id", "text", "lang"), model, name="score")
    return out.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"),
                      cnn_toxicity.flagged(model, F.col("score"), F.col("lang")).alias("flagged"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    out = decontaminate.decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), decontaminate.contaminated().alias("contaminated"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    out = warc_chain.round_trip(table(spark, sf_dir, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_templates.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return icws_dedup.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_texts", "is_kept")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return collocations.mine(table(spark, sf_dir, "documents").select("lang", "text")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    aligned = token_align.align_texts(docs, *map(public_tokenizers.path, (token_align.TOKENIZER_A, token_align.TOKENIZER_B)))
    return token_align.measure(docs, aligned)


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = ffd_pack.pack(docs, public_tokenizers.path(ffd_pack.TOKENIZER))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, QueryFn] = {f.__name__: f for f in (
    op1_quality_classifier, op2_license_scan, op3_lm_scoring, op4_source_mixing, op5_quality_rules,
    op6_toxicity, op7_decontamination, op8_warc, op9_url_filter, op10_near_duplicates,
    op11_collocations, op12_token_alignment, op13_packing, pipeline)}

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPACED = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE: dict[str, str] = {
    "op4_source_mixing": rf"""
WITH d AS (SELECT doc_id, source, length(regexp_extract_all(coalesce(text, ''), '{_SPACED}')) AS size FROM documents),
s AS (SELECT source, sum(size) AS source_size, sum(CASE WHEN size > 0 THEN sqrt(size::DOUBLE) * size END) AS pulled FROM d GROUP BY source),
w AS (SELECT *, ((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1)::DOUBLE AS weight, source_size * 3.0::DOUBLE AS cap FROM s),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source IS NULL, encode(source) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (ORDER BY cap / weight, source IS NULL, encode(source) ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
v AS (SELECT arg_min(level, cap / weight) AS level FROM l WHERE cap >= level * weight),
t AS (SELECT source, source_size, pulled, coalesce(least(cap, v.level * weight), cap) AS target FROM l LEFT JOIN v ON true),
p0 AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS ratio FROM t),
p AS (SELECT *, floor(ratio + 1e-9) AS certain, CASE WHEN ratio - floor(ratio + 1e-9) < 1e-9 THEN 0 ELSE ratio - floor(ratio + 1e-9) END AS part FROM p0),
j AS (SELECT d.doc_id, d.size, p.*, (('0x' || substr(md5('42:' || coalesce(d.doc_id::VARCHAR, 'null')), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0 AS u,
      CASE WHEN part > 0 AND size > 0 THEN least(greatest(part * sqrt(size::DOUBLE) * source_size / pulled, 1e-9), 1 - 1e-9) END AS incl
      FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source),
r AS (SELECT *, CASE WHEN incl IS NOT NULL THEN (u / (1 - u)) / (incl / (1 - incl)) END AS rnk FROM j),
c AS (SELECT *, sum(size) OVER (PARTITION BY source, incl IS NULL ORDER BY rnk, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM r)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
  ((certain + CASE WHEN incl IS NOT NULL AND upto - size / 2.0 <= part * source_size THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM c""",
    "op11_collocations": rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, doc, unnest(range(1, len(x) + 1)) AS piece, unnest(x) AS s
           FROM (SELECT row_number() OVER () AS doc, lang, regexp_split_to_array(translate(text, '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]') AS x FROM documents WHERE text IS NOT NULL)),
w AS (SELECT lang, regexp_extract_all(s, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, k, unnest([w[i:i + k - 1] FOR i IN range(1, len(w) - k + 2)]) AS g FROM w, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k),
f AS (SELECT lang, k, g, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND f >= 10),
cut AS (SELECT c.*, unnest(range(1, k)) AS j FROM c),
sc AS (SELECT cut.lang, cut.k, cut.g, cut.f AS a, j, x.f AS l, y.f AS r, (1000000::HUGEINT * cut.f * cut.f // (x.f::HUGEINT * y.f))::BIGINT AS score
       FROM cut JOIN f x ON x.lang = cut.lang AND x.g = cut.g[1:j] JOIN f y ON y.lang = cut.lang AND y.g = cut.g[j + 1:]),
b AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
o AS (SELECT lang, part, max(a) AS most FROM (SELECT lang, unnest([g[1:2], g[2:3]]) AS part, a FROM b WHERE k = 3) GROUP BY ALL),
s AS (SELECT b.lang, array_to_string(b.g, ' ') AS phrase, a, l, r, score FROM b LEFT JOIN o ON o.lang = b.lang AND o.part = b.g WHERE most IS NULL OR 100 * most < 50 * a)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM s JOIN n ON n.lang = s.lang QUALIFY rank <= 2000""",
    "op7_decontamination": rf"""
WITH b AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_WORD}') AS w FROM benchmark WHERE text IS NOT NULL),
win AS (SELECT DISTINCT item, least(len(w), 13) AS n, unnest([array_to_string(w[i:i + least(len(w), 13) - 1], ' ') FOR i IN range(1, greatest(len(w) - 12, 1) + 1)]) AS g FROM b WHERE len(w) > 0),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS w FROM documents),
lens AS (SELECT DISTINCT n FROM win),
g AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM d, lens WHERE len(w) >= n),
occ AS (SELECT doc_id, g.n, i, item FROM (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s FROM g) g JOIN win ON win.g = g.s AND win.n = g.n),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS k FROM occ) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM occ) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN its ON d.doc_id = its.doc_id""",
    "op8_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT h, max(page_id) AS top FROM p GROUP BY h),
x AS (SELECT p.*, g.top, sha1(p.h) AS s FROM p JOIN g ON p.h = g.h),
k AS (SELECT *, [('0x' || substr(s, (1 + 10 * j)::BIGINT, 10))::BIGINT FOR j IN range(0, 4)] AS five FROM x)
SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (1 + ((five[1 + j // 8] >> (35 - 5 * (j % 8))::INTEGER) & 31))::BIGINT, 1) FOR j IN range(0, 32)], '') AS payload_digest,
  CASE WHEN page_id IS DISTINCT FROM top AND top IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM top AND top IS NOT NULL THEN top END AS refers_to FROM k""",
}
