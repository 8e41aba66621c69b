"""Toxicity: a convolutional text classifier in numpy.

Words (letters, digits, non-ASCII; lower-cased) are embedded by hashing: the
sum of the rows of the whole word and of its first 4, 5 and 6 bytes, so
inflected and compounded words share what they have in common, and one
collision of buckets is a part of the sum only. Filters of widths 1, 2 and
3 run over the embeddings, are max-pooled over the whole text and feed a
logistic output. Rows of the embedding that training never touched are
zero, so unknown words are neutral.

Training reads every labelled text, whole. Labelled texts are dealt to
learners by a hash; the first share of them starts the model in one task,
then all learners go on from it, each streaming through its own texts, and
their changes are averaged by bucket over the learners that made any
(``ROUNDS`` times, at a falling rate). Only the model, whose size is fixed
by ``BUCKETS``, meets on the driver. A sixth of the labelled texts, dealt by
the same hash, trains nothing; decision thresholds are calibrated on all of
it, per language. Scoring runs over all texts in tasks, in blocks of words,
so memory does not grow with a text; the score never sees labels, language,
source or id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import shared
from .bytewords import ALNUM, U64, Words, mix, split_words, text_slices
from .util import join_counted, with_text

BUCKETS = 1 << 17
DIM = 16
PREFIXES = (4, 5, 6)  # bytes
PARTS = 1 + len(PREFIXES)
WIDTHS = (1, 2, 3)
FILTERS = 16
SHARE_ROWS, SHARE_BYTES = 8000, 16 << 20  # labelled texts of a share, about
LEARNERS = 48  # beyond so many shares each learner streams through more texts
ROUNDS = 2  # passes of all learners after the start
REFINE_RATE = 0.01
BLOCK = 1 << 16
ROWS_PER_BLOCK = 1024  # rows of the embedding that are averaged together
BINS = 10_000  # steps of a calibrated threshold


def buckets_of(w: Words) -> np.ndarray:
    """Bucket numbers (words x PARTS) of each word and its beginnings."""
    parts = [w.hash, *(w.span_hash(w.start, np.minimum(w.start + k, w.end)) + U64(k) for k in PREFIXES)]
    return np.stack([(mix(h) & U64(BUCKETS - 1)).astype(np.int32) for h in parts], 1)


@dataclass
class Cnn:
    table: np.ndarray  # BUCKETS x DIM
    conv: list[np.ndarray]  # per width: width x DIM x FILTERS
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)

    @classmethod
    def new(cls, seed: int) -> Cnn:
        rng = np.random.default_rng(seed)
        conv = [rng.normal(0, 0.5 / np.sqrt(w), (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        return cls(rng.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32), conv,
                   [np.zeros(FILTERS, np.float32) for _ in WIDTHS], rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32))

    def embed(self, buckets: np.ndarray) -> np.ndarray:
        x = self.table[buckets[:, 0]]
        for k in range(1, PARTS):
            x += self.table[buckets[:, k]]
        return x

    def pooled(self, buckets: np.ndarray, first: np.ndarray, where: bool = False):
        """Max-pooled filter values per text (0 at least), and the word at
        which each maximum stands (-1: none above 0) if ``where``."""
        n = len(first) - 1
        best = np.zeros((n, len(WIDTHS) * FILTERS), np.float32)
        at = np.full(best.shape, -1, np.int64) if where else None
        ahead = max(WIDTHS) - 1
        for lo in range(0, len(buckets), BLOCK):
            hi = min(lo + BLOCK, len(buckets))
            x = self.embed(buckets[lo:min(hi + ahead, len(buckets))])
            texts = np.arange(np.searchsorted(first, lo, "right") - 1, np.searchsorted(first, hi, "left"))
            texts = texts[first[texts + 1] > first[texts]]
            begin, stop = np.maximum(first[texts], lo) - lo, np.minimum(first[texts + 1], hi) - lo
            for k, width in enumerate(WIDTHS):
                y = np.zeros((hi - lo, FILTERS), np.float32)
                for j in range(width):
                    part = x[j:j + hi - lo] @ self.conv[k][j]
                    y[:len(part)] += part
                y += self.bias[k]
                # a window must end inside its text
                for j in range(1, width):
                    last = first[texts + 1] - j - lo
                    y[last[(last >= 0) & (last < hi - lo) & (last >= begin)]] = -np.inf
                cols = slice(k * FILTERS, (k + 1) * FILTERS)
                peak = np.maximum.reduceat(y, begin, axis=0) if len(begin) else y[:0]
                if where:
                    for i, (t, a, b) in enumerate(zip(texts, begin, stop, strict=True)):
                        better = peak[i] > best[t, cols]
                        if better.any():
                            place = y[a:b].argmax(0) + a + lo
                            at[t, cols] = np.where(better, place, at[t, cols])
                best[texts, cols] = np.maximum(best[texts, cols], peak)
        return (best, at) if where else best

    def logits(self, buckets: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self.pooled(buckets, first) @ self.out + self.out_bias


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Trainer:
    """Adam over a model, batch by batch; ``weight`` of a text by its label."""

    def __init__(self, model: Cnn, rng: np.random.Generator, weight: tuple[float, float] = (1.0, 1.0)):
        self.model, self.rng, self.weight = model, rng, np.array(weight, np.float32)
        self.dense = [*model.conv, *model.bias, model.out]
        self.moment = [(np.zeros_like(p), np.zeros_like(p)) for p in self.dense]
        self.m_table, self.v_table = np.zeros_like(model.table), np.zeros_like(model.table)
        self.bias_m, self.steps = [0.0, 0.0], 0
        self.used = np.zeros(BUCKETS, bool)

    def _adam(self, p, g, m, v, lr):
        m *= 0.9
        m += 0.1 * g
        v *= 0.98
        v += 0.02 * g * g
        p -= lr * (m / (1 - 0.9**self.steps)) / (np.sqrt(v / (1 - 0.98**self.steps)) + 1e-7)

    def step(self, texts: list[np.ndarray], labels: np.ndarray, lr: float) -> None:
        model, m_table, v_table, bias_m = self.model, self.m_table, self.v_table, self.bias_m
        self.steps += 1
        buckets = np.concatenate(texts)
        first = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        best, at = model.pooled(buckets, first, where=True)
        drop = (self.rng.random(best.shape) > 0.3).astype(np.float32) / 0.7
        p = sigmoid((best * drop) @ model.out + model.out_bias)
        g = ((p - labels) * self.weight[labels.astype(np.int64)] / len(texts)).astype(np.float32)
        d_out = (best * drop).T @ g + 1e-4 * model.out
        d_best = g[:, None] * model.out * drop
        grads = [np.zeros_like(w) for w in model.conv]
        biases = [np.zeros_like(b) for b in model.bias]
        rows, d_rows = [], []
        for k, width in enumerate(WIDTHS):
            cols = slice(k * FILTERS, (k + 1) * FILTERS)
            t, f = np.nonzero(at[:, cols] >= 0)
            place, d = at[:, cols][t, f], d_best[:, cols][t, f]
            np.add.at(biases[k], f, d)
            for j in range(width):
                x = model.embed(buckets[place + j])
                np.add.at(grads[k][j].T, f, x * d[:, None])
                rows.append(buckets[place + j])
                d_rows.append(model.conv[k][j].T[f] * d[:, None])
        for (q, (m, v)), gr in zip(zip(self.dense, self.moment, strict=True), [*grads, *biases, d_out], strict=True):
            self._adam(q, gr, m, v, lr * 0.3)
        bias_m[0] = 0.9 * bias_m[0] + 0.1 * float(g.sum())
        bias_m[1] = 0.98 * bias_m[1] + 0.02 * float(g.sum()) ** 2
        model.out_bias -= lr * 0.3 * (bias_m[0] / (1 - 0.9**self.steps)) / (np.sqrt(bias_m[1] / (1 - 0.98**self.steps)) + 1e-7)
        if rows:
            rows, d_rows = np.concatenate(rows), np.concatenate(d_rows)
            touched, inverse = np.unique(rows, return_inverse=True)
            self.used[touched] = True
            gr = 1e-4 * model.table[touched]
            inverse = inverse.reshape(rows.shape)
            for k in range(PARTS):
                np.add.at(gr, inverse[:, k], d_rows)
            m_table[touched] = 0.9 * m_table[touched] + 0.1 * gr
            v_table[touched] = 0.98 * v_table[touched] + 0.02 * gr * gr
            model.table[touched] -= lr * m_table[touched] / (np.sqrt(v_table[touched]) + 1e-6)


def fit(texts: list[np.ndarray], labels: np.ndarray, steps: int = 500, batch: int = 32, rate: float = 0.03, seed: int = 5, prior: float | None = None) -> Cnn:
    """Train on texts given as bucket arrays (words x PARTS); Adam throughout,
    for whole epochs that make about ``steps`` batches, 12 epochs at most.

    ``prior``: the share of label 1 that scores should reflect.
    """
    model, rng = Cnn.new(seed), np.random.default_rng(seed)
    share = float(labels.mean()) if len(labels) else 0.5
    prior = share if prior is None else prior
    model.out_bias = float(np.log(max(prior, 1e-3) / max(1 - prior, 1e-3)))
    trainer = Trainer(model, rng, ((1 - prior) / max(1 - share, 1e-6), prior / max(share, 1e-6)))
    epochs = int(min(max(np.ceil(steps * batch / max(len(texts), 1)), 2), 12))
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for lo in range(0, len(order), batch):
            ids = order[lo:lo + batch]
            trainer.step([texts[i] for i in ids], labels[ids], rate * (1 - epoch / epochs) + 1e-3)
    # a row that no maximum ever came from is noise of the start: neutral
    model.table[~trainer.used] = 0
    return model


def calibrated(scored: DataFrame, least: int = 20, default: float = 0.5) -> dict[str, float]:
    """Per language the threshold of the best F1, in steps of 1/``BINS``, on
    rows ``lang``, ``label`` and ``score``; languages with fewer than
    ``least`` texts of either label take the one of all (key ``''``).

    Rows are counted per language, step and label; only a threshold per
    language reaches the driver.
    """
    lang = F.explode(F.array_distinct(F.array(F.lit(""), F.coalesce("lang", F.lit("")))))
    bins = scored.select(lang.alias("lang"), F.floor(F.col("score") * BINS).alias("bin"), "label").groupBy("lang", "bin").agg(F.sum("label").alias("pos"), F.count(F.lit(1)).alias("all"))
    every, down = Window.partitionBy("lang"), Window.partitionBy("lang").orderBy(F.col("bin").desc())
    total, rows = F.sum("pos").over(every), F.sum("all").over(every)
    cuts = bins.select("lang", "bin", total.alias("total"), rows.alias("rows"), (2 * F.sum("pos").over(down) / (F.sum("all").over(down) + total)).alias("f1"), F.coalesce(F.lead("bin").over(down) + 1, F.lit(0)).alias("below"))
    need = F.when(F.col("lang") == "", 1).otherwise(least)
    best = (cuts.where((F.col("total") >= need) & (F.col("rows") - F.col("total") >= need))
            .groupBy("lang").agg(F.max(F.struct("f1", "bin", ((F.col("bin") + F.col("below")) / (2.0 * BINS)).alias("at"))).alias("best")))
    return {"": default} | {r["lang"]: float(r["best"]["at"]) for r in best.collect()}


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, when: Column, per_class: int, keep: list[str], doc_id: str = "doc_id") -> DataFrame:
    """At most ``per_class`` labelled rows of each class, by a hash of the id,
    with the columns ``keep`` of their documents and ``label``.

    Ids and labels of the sample are bounded by ``2 * per_class``, so the
    driver holds them and they are broadcast to the documents; the share of
    label 1 among all labelled rows is counted beside. Rows with a null id
    or label, and labels other than 0 and 1, are no labelled rows; an id
    that several rows label counts once per label.
    """
    rows = labels.select(F.col(doc_id).alias("sample_id"), F.col(label).cast("int").alias("sample_label")).where(F.col("sample_id").isNotNull() & F.col("sample_label").isin(0, 1)).where(when).distinct()
    picked = [rows.where(F.col("sample_label") == k).orderBy(F.xxhash64(F.col("sample_id").cast("string"), F.lit(11)), "sample_id").limit(per_class) for k in (0, 1)]
    ids = [(r["sample_id"], r["sample_label"]) for p in picked for r in p.collect()]
    small = docs.sparkSession.createDataFrame(ids, rows.schema)
    src = docs.select(F.col(doc_id).alias("sample_id"), *keep)
    return src.join(F.broadcast(small), "sample_id")


def class_share(labels: DataFrame, label: str, when: Column, doc_id: str = "doc_id") -> float:
    """Share of label 1 among the labelled rows."""
    rows = labels.select(F.col(doc_id).alias("sample_id"), F.col(label).cast("int").alias("sample_label")).where(F.col("sample_id").isNotNull() & F.col("sample_label").isin(0, 1)).where(when)
    r = rows.agg(F.avg("sample_label").alias("s")).first()
    return 0.5 if r["s"] is None else float(r["s"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Bucket arrays and labels of rows ``label``, ``text``, slice by slice."""
    for batch in batches:
        y = batch.column(0).to_numpy(zero_copy_only=False).astype(np.float32)
        for lo, hi, data, offsets in text_slices(batch.column(1)):
            w = split_words(data, offsets, ALNUM)
            buckets = buckets_of(w)
            yield [buckets[a:b] for a, b in zip(w.first[:-1], w.first[1:], strict=True)], y[lo:hi]


_BLOCKS = "block int, learner int, texts long, touched binary, values binary"


def _blocks(learner: int, texts: int, table: np.ndarray, used: np.ndarray, rest: np.ndarray) -> pa.RecordBatch:
    """Rows of the embedding in blocks, then the rest of the model as block -1."""
    cuts = [(k // ROWS_PER_BLOCK, used[k:k + ROWS_PER_BLOCK], table[k:k + ROWS_PER_BLOCK]) for k in range(0, BUCKETS, ROWS_PER_BLOCK)]
    cuts = [c for c in cuts if c[1].any()] + [(-1, np.ones(1, bool), rest.astype(np.float64))]
    n = len(cuts)
    return pa.RecordBatch.from_arrays([pa.array([c[0] for c in cuts], pa.int32()), pa.array([learner] * n, pa.int32()), pa.array([texts] * n, pa.int64()),
                                       pa.array([c[1].tobytes() for c in cuts], pa.binary()), pa.array([c[2].tobytes() for c in cuts], pa.binary())],
                                      names=["block", "learner", "texts", "touched", "values"])


def _flat(model: Cnn) -> np.ndarray:
    return np.concatenate([*(p.ravel() for p in [*model.conv, *model.bias, model.out]), [model.out_bias]]).astype(np.float64)


def _add(model: Cnn, rows: list) -> Cnn:
    """``model`` with the changes of merged blocks."""
    out = Cnn(model.table.copy(), [c.copy() for c in model.conv], [b.copy() for b in model.bias], model.out.copy(), model.out_bias)
    for r in rows:
        if r["block"] >= 0:
            at = r["block"] * ROWS_PER_BLOCK
            out.table[at:at + ROWS_PER_BLOCK] += np.frombuffer(r["values"], np.float32).reshape(-1, DIM)
        else:
            d, at = np.frombuffer(r["values"], np.float64), 0
            for p in [*out.conv, *out.bias, out.out]:
                p += d[at:at + p.size].reshape(p.shape).astype(np.float32)
                at += p.size
            out.out_bias += float(d[at])
    return out


def _merge(group: pa.Table) -> pa.Table:
    """The mean change of a block: per row of the embedding over the learners
    that touched it, of the rest by the learners' texts."""
    group = group.sort_by("learner")  # the same sum in every run
    block = group.column("block")[0].as_py()
    total, weight = 0.0, 0.0
    for texts, touched, values in zip(*(group.column(c).to_pylist() for c in ("texts", "touched", "values")), strict=True):
        if block >= 0:
            total = total + np.frombuffer(values, np.float32).reshape(-1, DIM).astype(np.float64)
            weight = weight + np.frombuffer(touched, bool)[:, None]
        else:
            total, weight = total + np.frombuffer(values, np.float64) * texts, weight + texts
    mean = total / np.maximum(weight, 1)
    return pa.table({"block": pa.array([block], pa.int32()), "values": pa.array([(mean.astype(np.float32) if block >= 0 else mean).tobytes()], pa.binary())})


def _started(rows: DataFrame, prior: float) -> Cnn:
    """A model fitted to ``rows``, few enough for one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, y = [], []
        for t, labels in _texts(batches):
            texts += t
            y.append(labels)
        if texts:
            model = fit(texts, np.concatenate(y), prior=prior)
            yield _blocks(0, len(texts), model.table, model.table.any(1), _flat(model))

    got = rows.repartition(1).sortWithinPartitions("h", "text", "label").select("label", "text").mapInArrow(run, _BLOCKS).collect()
    if not got:  # very few, very long texts: none fell into this share
        return fit([], np.zeros(0, np.float32), prior=prior)
    zero = Cnn.new(0)
    for p in (zero.table, *zero.conv, *zero.bias, zero.out):
        p[:] = 0
    return _add(zero, got)


def _refined(model: Cnn, rows: DataFrame, learners: int, rate: float, seed: int, batch: int = 32) -> Cnn:
    """``model`` after all learners went once through their texts."""
    held = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner, start = TaskContext.get().partitionId(), held.value
        mine = Cnn(start.table.copy(), [c.copy() for c in start.conv], [b.copy() for b in start.bias], start.out.copy(), start.out_bias)
        trainer, n = Trainer(mine, np.random.default_rng((seed, learner))), 0
        for texts, labels in _texts(batches):
            for lo in range(0, len(texts), batch):
                trainer.step(texts[lo:lo + batch], labels[lo:lo + batch], rate)
            n += len(texts)
        if n:
            yield _blocks(learner, n, mine.table - start.table, trainer.used, _flat(mine) - _flat(start))

    blocks = rows.repartition(learners, "h").sortWithinPartitions("h", "text", "label").select("label", "text").mapInArrow(run, _BLOCKS)
    return _add(model, blocks.groupBy("block").applyInArrow(_merge, "block int, values binary").collect())


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", when: Column | None = None, text: str = "text", lang: str = "lang") -> Cnn:
    """Train on all labelled rows with ``when`` (over ``sample_id``) but a
    sixth, and calibrate thresholds on that sixth.

    Rows with a null id or label, and labels other than 0 and 1, are no
    labelled rows; an id that several rows label counts once per label.
    Without any labelled row of both classes the model scores the class
    share everywhere.
    """
    when = F.lit(True) if when is None else when
    marked = labels.select(F.col("doc_id").alias("sample_id"), F.col(label).cast("int").alias("label")).where(F.col("sample_id").isNotNull() & F.col("label").isin(0, 1)).where(when).distinct()
    src = docs.select(F.col("doc_id").alias("sample_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), F.col(lang).cast("string").alias("lang"))
    of = [F.col("sample_id").cast("string"), F.col("text")]
    rows = (join_counted(src, marked, "sample_id", "inner", marked.count())
            .select("label", "lang", "text", F.xxhash64(*of, F.lit(11)).alias("h"), (F.pmod(F.xxhash64(*of, F.lit(12)), F.lit(6)) == 5).alias("left_out")))
    folder = shared.new_folder(docs.sparkSession, "toxicity")
    rows = shared.written(rows, "labelled", folder)
    seen = rows.where(~F.col("left_out"))
    n, size, low, high = seen.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.min("label"), F.max("label")).first()
    share = class_share(labels, label, when)
    if not n or low == high:
        model = Cnn.new(0)
        model.out_bias = float(np.log(max(share, 1e-3) / max(1 - share, 1e-3)))
        model.thresholds = {"": 0.5}
        return model
    shares = int(max(-(-n // SHARE_ROWS), -(-size // SHARE_BYTES), 1))
    first = seen.where(F.pmod(F.xxhash64("h"), F.lit(shares)) == 0)
    model = _started(first, share)
    if shares > 1:
        for k in range(ROUNDS):
            model = _refined(model, seen, min(shares, LEARNERS), REFINE_RATE / 3**k, k)
    held = rows.where("left_out")
    model.thresholds = calibrated(score(held, model, name="score"))
    return model


def score(docs: DataFrame, model: Cnn, text: str = "text", name: str = "toxicity") -> DataFrame:
    """All rows and columns of ``docs`` and column ``name``, 0 to 1.

    Null and empty texts score as texts without any feature. An input column
    called ``name`` is replaced.
    """
    kept = [c for c in docs.columns if c != name]
    src, at = with_text(docs, kept, text)
    held = docs.sparkSession.sparkContext.broadcast(model)  # its size is fixed by BUCKETS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column(at)):
                w = split_words(data, offsets, ALNUM)
                s = sigmoid(m.logits(buckets_of(w), w.first).astype(np.float64))
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(lo, hi - lo) for i in range(len(kept))), pa.array(s)], names=[*kept, name])

    return src.mapInArrow(run, T.StructType([*(src.schema[c] for c in kept), T.StructField(name, T.DoubleType())]))


def flagged(model: Cnn, score_col: Column, lang: Column) -> Column:
    """Whether a score reaches its language's calibrated threshold."""
    out = F.lit(model.thresholds.get("", 0.5))
    for k, v in sorted(model.thresholds.items()):
        if k:
            out = F.when(lang == k, F.lit(v)).otherwise(out)
    return F.coalesce(score_col >= out, F.lit(False))
