"""License scans: exact set-similarity join of text blocks with templates.

A block is a run of words, twice as long as a template, starting at every
template length, so a span of a template's length lies whole in some block.
A block is found if it holds at least ``ceil(THRESHOLD * m)`` of the ``m``
distinct words of a template (containment).

Words of each template are ordered by their frequency over all documents,
rarest first. Then (all exact):

* *prefix filter*: a block that holds ``o`` of ``m`` words holds one of the
  first ``m - o + 1``; only blocks around such a word are candidates;
* *length filter*: a block of fewer than ``o`` words is none;
* *positional filter*: if a block's first common word is at place ``i`` of
  the order, at most ``m - i`` words are common; less than ``o`` ends it.

Templates are a short parameter; their words' frequencies (a bounded table)
are the only thing the driver sees. The join runs inside each row, so no
document is shuffled and hot texts or phrases meet in no task. Native
functions only.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Sentences of public licenses and their labels.
TEMPLATES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under the apache license version 2.0 you may not use this file except in compliance with the license", "apache-2.0"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("this work is licensed under a creative commons attribution license", "cc-by"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("all rights reserved no part of this publication may be reproduced", "reserved"),
)
THRESHOLD = 0.8
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: str) -> list[str]:
    return re.findall(WORD, text.translate({c: c + 32 for c in range(65, 91)}))


def words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; a null text has none."""
    low = F.translate(F.coalesce(text.cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(low, BREAK), "")


def _lits(values) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def places(ws: Column, phrase: list[str]) -> Column:
    """Start places of a phrase's words standing consecutively."""
    n = len(phrase)
    at = F.filter(F.transform(ws, lambda w, i: F.when(w == F.lit(phrase[0]), i)), lambda i: i.isNotNull())
    rest = _lits(phrase)
    return F.filter(at, lambda i: F.slice(ws, i + 1, n) == rest) if n > 1 else at


def frequencies(docs: DataFrame, text: str, vocabulary: list[str]) -> dict[str, int]:
    """How many documents hold each word of ``vocabulary`` (a bounded list)."""
    held = docs.select(F.explode(F.array_intersect(words(F.col(text)), _lits(vocabulary))).alias("w"))
    return {r["w"]: r["n"] for r in held.groupBy("w").agg(F.count("*").alias("n")).collect()}


def scan(docs: DataFrame, text: str = "text", phrases=PHRASES, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """All rows and columns of ``docs`` and a struct ``license`` of
    ``n_words``, ``base`` (places of phrases: start, words, label), ``blocks``
    (found blocks: start, words, label, containment).

    Phrases are templates of themselves with blocks as above, so reordered
    or interrupted phrases are found too. Null and empty texts have no words
    and no finds. Rows are independent, so repeated rows get equal results.
    A column of the input called ``license`` is replaced.
    """
    vocabulary = sorted({w for t, _ in [*phrases, *templates] for w in words_of(t)})
    often = frequencies(docs, text, vocabulary)
    src = docs.drop("license") if "license" in docs.columns else docs
    src = src.withColumn("license", words(F.col(text)))
    ws = F.col("license")

    def find_phrase(t: str, label: str) -> Column:
        p = words_of(t)
        found = F.transform(places(ws, p), lambda i: F.struct(i.cast("long").alias("start"), F.lit(len(p)).alias("words"), F.lit(label).alias("label")))
        return F.when(F.array_contains(ws, p[-1]), found).otherwise(F.array().cast("array<struct<start:bigint,words:int,label:string>>"))

    def find_template(t: str, label: str) -> Column:
        p = words_of(t)
        order = sorted(set(p), key=lambda w: (often.get(w, 0), w))
        m, step = len(order), len(p)
        least = math.ceil(threshold * m - 1e-9)
        prefix, bag = order[:m - least + 1], _lits(order)
        none = F.array().cast("array<struct<start:bigint,words:int,label:string,containment:double>>")
        # candidates: the two blocks (starts are multiples of step) around each prefix word
        seeds = F.filter(F.transform(ws, lambda w, i: F.when(F.array_contains(_lits(prefix), w), F.floor(i / F.lit(step)).cast("int"))), lambda b: b.isNotNull())
        starts = F.array_distinct(F.flatten(F.transform(seeds, lambda b: F.array(F.greatest(b - 1, F.lit(0)), b))))
        blocks = F.transform(starts, lambda b: F.struct((b * step).cast("long").alias("start"), F.slice(ws, b * step + 1, 2 * step).alias("w")))
        blocks = F.filter(blocks, lambda b: F.size(b["w"]) >= least)  # length filter
        # the first common word in the order bounds what can follow
        room = F.transform(blocks, lambda b: F.struct(b["start"].alias("start"), F.array_intersect(bag, b["w"]).alias("common")))
        room = F.filter(room, lambda b: (F.size(b["common"]) > 0) & (F.lit(m + 1) - F.array_position(bag, F.element_at(b["common"], 1)) >= least))
        found = F.filter(room, lambda b: F.size(b["common"]) >= least)
        out = F.transform(found, lambda b: F.struct(b["start"].alias("start"), F.lit(2 * step).alias("words"), F.lit(label).alias("label"), (F.size(b["common"]) / F.lit(float(m))).alias("containment")))
        return F.when(F.arrays_overlap(ws, _lits(prefix)), out).otherwise(none)

    base = F.concat(*(find_phrase(t, k) for t, k in phrases))
    blocks = F.concat(*(find_template(t, k) for t, k in [*phrases, *templates]))
    return src.withColumn("license", F.struct(F.size("license").cast("long").alias("n_words"), base.alias("base"), blocks.alias("blocks")))


def digest(scanned: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Counts, places, labels and score of each scanned row."""
    base, blocks = F.col("license.base"), F.col("license.blocks")
    starts = F.transform(base, lambda b: b["start"])
    names = F.array_distinct(F.transform(base, lambda b: b["label"]))
    more = F.array_distinct(F.concat(names, F.transform(blocks, lambda b: b["label"])))
    best = F.coalesce(F.array_max(F.transform(blocks, lambda b: b["containment"])), F.lit(0.0))
    return scanned.select(F.col(doc_id).alias("doc_id"), "license.n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                          F.array_join(F.sort_array(names), ",").alias("base_labels"), F.array_join(F.sort_array(more), ",").alias("labels"),
                          F.when(F.size(base) > 0, F.lit(1.0)).otherwise(best).alias("score"))
