"""Quality classifier: attention-based multiple-instance learning.

A text is a bag of passages of ``PASSAGE`` words. Each passage is encoded
(byte-class bigrams, word statistics, hashed words, then a learned layer);
gated attention, learned from document labels only, weighs the passages::

    h = relu(x W + b)        e = w . (tanh(h V) * sigmoid(h U))
    a = softmax of e over the text      score = sigmoid(c . sum(a h) + d)

The attention logit is bounded by the sum of ``|w|``, so the weighted sum
needs no running maximum.
Training takes a bounded, documented sample of labelled texts (whole texts)
on the driver; scoring covers every passage of every text in tasks. Labels,
language, source and id are never inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytewords import NONSPACE, U64, mix, split_words, text_slices
from .cnn_toxicity import class_share, labelled_sample, sigmoid
from .util import with_text

PASSAGE = 48
CLASSES = 16
WORD_BUCKETS = 64
STATS = 6
FEATURES = CLASSES * CLASSES + WORD_BUCKETS + STATS
HIDDEN, GATE = 32, 16
SAMPLE_PER_CLASS = 1500  # labelled texts per class that training may see
SAMPLE_PASSAGES = 60_000  # passages of all of them; longer samples drop whole texts

#: Byte classes: letters by case, digits, blanks, line ends, non-ASCII, and
#: punctuation by kind.
BYTE_CLASS = np.full(256, 15, np.int64)
for _k, _chars in enumerate((range(97, 123), range(65, 91), range(48, 58), (32, 9, 11, 12), (10, 13), range(128, 256),
                             b".", b",;:", b"!?", b"|", b"$%&*#@", b"<>[]{}()", b"'\"`", b"-_/\\", b"=+~^")):
    BYTE_CLASS[list(_chars)] = _k


def encode(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Passage features (passages x FEATURES) and the texts' ranges; a text
    without a word has no passage."""
    w = split_words(data, offsets, NONSPACE)
    count = w.counts()
    per = -(-count // PASSAGE)
    first = np.zeros(w.texts + 1, np.int64)
    np.cumsum(per, out=first[1:])
    n = int(first[-1])
    if not n:
        return np.zeros((0, FEATURES), np.float32), first
    text = np.repeat(np.arange(w.texts), count)
    pid = first[text] + (np.arange(len(text)) - w.first[text]) // PASSAGE
    head = np.searchsorted(pid, np.arange(n))
    size = np.diff([*head, len(pid)])
    tail = head + size - 1
    begin = w.start[head]
    stop = np.append(begin[1:], 0)
    last = np.append(text[head][1:] != text[head][:-1], True)
    stop = np.where(last, w.end[tail], stop)
    span = stop - begin
    of_byte = np.repeat(np.arange(n), span)
    at = np.arange(len(of_byte)) - np.repeat(np.cumsum(span) - span, span) + np.repeat(begin, span)
    kind = BYTE_CLASS[data]
    follow = np.append(kind[1:], 3)[at]
    follow[np.cumsum(span)[last] - 1] = 3  # nothing follows a text's last word, whatever comes next in the batch
    pairs = np.bincount(of_byte * (CLASSES * CLASSES) + kind[at] * CLASSES + follow, minlength=n * CLASSES * CLASSES)
    out = np.empty((n, FEATURES), np.float32)
    out[:, :CLASSES * CLASSES] = np.sqrt(pairs.reshape(n, -1) / span[:, None])
    bucket = (mix(w.hash) >> U64(58)).astype(np.int64)
    out[:, CLASSES * CLASSES:-STATS] = np.sqrt(np.bincount(pid * WORD_BUCKETS + bucket, minlength=n * WORD_BUCKETS).reshape(n, -1) / size[:, None])
    again = np.zeros(len(pid), bool)
    again[1:] = (w.hash[1:] == w.hash[:-1]) & (pid[1:] == pid[:-1])
    order = np.lexsort((w.hash, pid))
    same = np.zeros(len(pid), bool)
    same[1:] = (w.hash[order][1:] == w.hash[order][:-1]) & (pid[order][1:] == pid[order][:-1])
    length = w.end - w.start
    capital = kind[w.start] == 1
    shout = capital & (kind[w.end - 1] == 1) & (length > 1)
    for k, x in enumerate((length / 10.0, again, None, capital, shout)):
        out[:, -STATS + k] = np.bincount(pid[order], same, n) / size if x is None else np.bincount(pid, x, n) / size
    out[:, -1] = size / PASSAGE
    return out, first


@dataclass
class Mil:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray  # FEATURES x HIDDEN
    bias: np.ndarray
    tanh: np.ndarray  # HIDDEN x GATE
    gate: np.ndarray
    attend: np.ndarray  # GATE
    out: np.ndarray  # HIDDEN
    out_bias: float
    empty: float  # logit of a text without a passage

    def hidden(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(((x - self.mean) * self.scale) @ self.weight + self.bias, 0)

    def attention(self, h: np.ndarray) -> np.ndarray:
        return np.exp((np.tanh(h @ self.tanh) * sigmoid(h @ self.gate)) @ self.attend)

    def logits(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        n = len(first) - 1
        h = self.hidden(x)
        a = self.attention(h).astype(np.float64)
        text = np.repeat(np.arange(n), np.diff(first))
        total = np.bincount(text, a, n)
        value = np.bincount(text, a * (h @ self.out), n)
        return np.where(total > 0, value / np.maximum(total, 1e-300) + self.out_bias, self.empty)


def fit(bags: list[np.ndarray], labels: np.ndarray, prior: float, steps: int = 600, batch: int = 32, rate: float = 0.004, seed: int = 9) -> Mil:
    """Train on bags (passages x FEATURES each, at least one) with Adam."""
    rng = np.random.default_rng(seed)
    every = np.concatenate(bags)
    mean, std = every.mean(0), every.std(0)
    m = Mil(mean.astype(np.float32), (1 / (std + 0.05)).astype(np.float32), (rng.normal(0, 1, (FEATURES, HIDDEN)) / np.sqrt(FEATURES)).astype(np.float32),
            np.zeros(HIDDEN, np.float32), *((rng.normal(0, 1, (HIDDEN, GATE)) / np.sqrt(HIDDEN)).astype(np.float32) for _ in range(2)),
            rng.normal(0, 0.3, GATE).astype(np.float32), (rng.normal(0, 1, HIDDEN) / np.sqrt(HIDDEN)).astype(np.float32), 0.0, 0.0)
    share = float(labels.mean())
    weight = np.where(labels == 1, prior / share, (1 - prior) / (1 - share))
    params = {k: getattr(m, k) for k in ("weight", "bias", "tanh", "gate", "attend", "out")}
    state = {k: [np.zeros_like(p), np.zeros_like(p)] for k, p in params.items()}
    bias_state, step = np.zeros(2), 0
    epochs = int(min(max(np.ceil(steps * batch / len(bags)), 3), 25))
    for epoch in range(epochs):
        lr = rate * (1 - epoch / epochs) + 1e-4
        order = rng.permutation(len(bags))
        for lo in range(0, len(order), batch):
            ids = order[lo:lo + batch]
            step += 1
            sizes = np.array([len(bags[i]) for i in ids])
            text = np.repeat(np.arange(len(ids)), sizes)
            start = np.cumsum(sizes) - sizes
            x = (np.concatenate([bags[i] for i in ids]) - m.mean) * m.scale
            pre = x @ m.weight + m.bias
            h = np.maximum(pre, 0)
            t, s = np.tanh(h @ m.tanh), sigmoid(h @ m.gate)
            a = np.exp((t * s) @ m.attend)
            a = a / np.add.reduceat(a, start)[text]
            z = np.add.reduceat(a[:, None] * h, start)
            p = sigmoid(z @ m.out + m.out_bias)
            g = (p - labels[ids]) * weight[ids] / len(ids)
            d_z = g[:, None] * m.out
            d_a = (h * d_z[text]).sum(1)
            d_e = a * (d_a - np.add.reduceat(a * d_a, start)[text])
            d_t, d_s = d_e[:, None] * m.attend * s * (1 - t * t), d_e[:, None] * m.attend * t * s * (1 - s)
            d_h = (a[:, None] * d_z[text] + d_t @ m.tanh.T + d_s @ m.gate.T) * (pre > 0)
            grads = {"weight": x.T @ d_h + 1e-3 * m.weight, "bias": d_h.sum(0), "tanh": h.T @ d_t, "gate": h.T @ d_s,
                     "attend": (t * s).T @ d_e + 1e-3 * m.attend, "out": z.T @ g + 1e-3 * m.out}
            for k, gr in grads.items():
                u, v = state[k]
                u *= 0.9
                u += 0.1 * gr
                v *= 0.99
                v += 0.01 * gr * gr
                params[k] -= (lr * (u / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
            bias_state = np.array([0.9 * bias_state[0] + 0.1 * g.sum(), 0.99 * bias_state[1] + 0.01 * g.sum() ** 2])
            m.out_bias -= float(lr * (bias_state[0] / (1 - 0.9**step)) / (np.sqrt(bias_state[1] / (1 - 0.99**step)) + 1e-8))
    m.empty = float(np.log(max(prior, 1e-3) / max(1 - prior, 1e-3)))
    return m


def _encode_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offsets in text_slices(batch.column(1), 1 << 20):
            x, first = encode(data, offsets)
            x = x.astype(np.float16)
            bags = [x[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(bags, pa.binary())], names=["label", "bag"])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", when: Column | None = None, text: str = "text",
          per_class: int = SAMPLE_PER_CLASS, passages: int = SAMPLE_PASSAGES) -> Mil | float:
    """Train on labelled rows with ``when`` (over ``sample_id``).

    Without labelled texts of both classes there is nothing to learn; then
    the share of label 1 is returned, and every text gets it as its score.
    """
    when = F.lit(True) if when is None else when
    share = class_share(labels, label, when)
    sample = labelled_sample(docs, labels, label, when, per_class, [F.col(text).cast("string").alias("text")])
    got = sample.select(F.col("sample_label").alias("label"), "text").mapInArrow(_encode_rows, "label int, bag binary").where("length(bag) > 0").collect()
    got = sorted(got, key=lambda r: (bytes(r["bag"]), r["label"]))  # the same order in every run
    np.random.default_rng(3).shuffle(got)
    bags, y, total = [], [], 0
    for r in got:
        n = len(r["bag"]) // (2 * FEATURES)
        if total + n <= passages:
            bags.append(np.frombuffer(r["bag"], np.float16).reshape(n, FEATURES).astype(np.float32))
            y.append(r["label"])
            total += n
    if len(set(y)) < 2:
        return share
    return fit(bags, np.array(y, np.float32), min(max(share, 0.01), 0.99))


def score(docs: DataFrame, model: Mil | float, text: str = "text", name: str = "quality_score") -> DataFrame:
    """All rows and columns of ``docs`` and column ``name``, 0 to 1.

    Null and empty texts get the share of label 1. An input column called
    ``name`` is replaced.
    """
    kept = [c for c in docs.columns if c != name]
    if isinstance(model, float):
        return docs.select(*kept, F.lit(model).alias(name))
    src, at = with_text(docs, kept, text)
    held = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column(at), 1 << 20):
                s = sigmoid(m.logits(*encode(data, offsets)))
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(lo, hi - lo) for i in range(len(kept))), pa.array(s)], names=[*kept, name])

    return src.mapInArrow(run, T.StructType([*(src.schema[c] for c in kept), T.StructField(name, T.DoubleType())]))
