"""Operators 1, 3 and 6: classifiers and the language model."""

import collections
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesela.llm import cnn_toxicity, kn_lm, mil_quality
from tesela.llm.util import fold, table

MID = "/root/testdata/sf0.01"


@pytest.mark.parametrize("module,name,label", [(mil_quality, "score", "quality"), (cnn_toxicity, "score", "toxic")])
def test_odd_rows_and_empty_tables(docs, no_docs, labels, module, name, label):
    model = module.train(docs, labels, label)
    out = module.score(docs, model, name=name)
    rows = out.collect()
    assert len(rows) == docs.count() and sorted(out.columns) == sorted(docs.columns)
    assert all(0 <= r[name] <= 1 for r in rows)
    ties = {round(r[name], 6) for r in rows if r["doc_id"] == 9005}
    assert len(ties) == 1
    assert module.score(no_docs, model, name=name).count() == 0
    none = module.train(no_docs, labels.limit(0), label)
    assert module.score(docs, none, name=name).count() == docs.count()


def test_held_out_quality(llm):
    d, lab = table(llm, MID, "documents"), table(llm, MID, "labels")
    model = mil_quality.train(d, lab, when=fold("sample_id", 5) != 0)
    got = mil_quality.score(d, model, name="s").join(lab, "doc_id").where(fold("doc_id", 5) == 0).select("s", "quality").collect()
    assert np.mean([(r["s"] >= 0.3) == (r["quality"] == 1) for r in got]) > 0.97


def test_held_out_toxicity(llm):
    from tesela.llm import queries

    sf = "/root/testdata/sf0.1"
    got = queries.QUERIES["op6_toxicity"](llm, sf).join(table(llm, sf, "labels"), "doc_id").where("held_out").select("predicted", "flagged", "toxic").collect()
    toxic, clean = [r for r in got if r["toxic"] == 1], [r for r in got if r["toxic"] == 0]
    assert len(toxic) > 100 and len(clean) > 1000
    for c in ("predicted", "flagged"):
        assert np.mean([bool(r[c]) for r in toxic]) > 0.85 and np.mean([bool(r[c]) for r in clean]) < 0.03


def test_cnn_learns_words_and_beginnings():
    from tesela.llm.bytewords import ALNUM, split_words

    rng = np.random.default_rng(0)
    words = [f"{a}{b}" for a in "ba ce di fo gu ha".split() for b in "lon mer nit pos rat".split()]
    texts, y = [], []
    for k in range(600):
        t = list(rng.choice(words, rng.integers(5, 80)))
        if k % 3 == 0:
            t.insert(int(rng.integers(0, len(t))), "zzvil" + str(rng.choice(["a", "ber", "tion", "en"])))
        texts.append(" ".join(t))
        y.append(float(k % 3 == 0))
    raw = [t.encode() for t in texts]
    w = split_words(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw]))), ALNUM)
    x = [cnn_toxicity.buckets_of(w)[a:b] for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
    model = cnn_toxicity.fit(x[:450], np.array(y[:450], np.float32))
    first = np.concatenate(([0], np.cumsum([len(a) for a in x[450:]])))
    p = cnn_toxicity.sigmoid(model.logits(np.concatenate(x[450:]), first))
    assert np.mean((p >= 0.5) == np.array(y[450:])) > 0.95


def test_cnn_blocks_do_not_change_the_pool(monkeypatch):
    rng = np.random.default_rng(1)
    model = cnn_toxicity.Cnn.new(3)
    buckets = rng.integers(0, cnn_toxicity.BUCKETS, (500, cnn_toxicity.PARTS)).astype(np.int32)
    first = np.array([0, 0, 1, 3, 120, 120, 490, 500, 500])
    whole = model.pooled(buckets, first)
    monkeypatch.setattr(cnn_toxicity, "BLOCK", 7)
    assert np.allclose(whole, model.pooled(buckets, first), atol=1e-5)
    x = model.embed(buckets)
    for t in range(len(first) - 1):
        for k, width in enumerate(cnn_toxicity.WIDTHS):
            best = np.zeros(cnn_toxicity.FILTERS)
            for i in range(first[t], first[t + 1] - width + 1):
                best = np.maximum(best, sum(x[i + j] @ model.conv[k][j] for j in range(width)) + model.bias[k])
            assert np.allclose(best, whole[t, k * cnn_toxicity.FILTERS:(k + 1) * cnn_toxicity.FILTERS], atol=1e-4)


def brute_kn(train, texts):
    def tokens(t):
        return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")) + ["</s>"]

    uni, pair = collections.Counter(), collections.Counter()
    for t in train:
        w = tokens(t)
        uni.update(w)
        uni["<s>"] += 1
        pair.update(zip(["<s>", *w], w, strict=False))
    begin = uni.pop("<s>", 0)
    n, v = sum(uni.values()), len(uni)
    context = {**uni, "<s>": begin}
    seen, out = collections.Counter(), collections.defaultdict(lambda: [0, 0, 0])
    for (a, b), c in pair.items():
        seen[b] += 1
        out[a][min(c, 3) - 1] += 1
    cc = lambda cs: [sum(c == k for c in cs) for k in (1, 2, 3, 4)]
    d, low = kn_lm.discounts(*cc(pair.values())), kn_lm.discounts(*cc(seen.values()))
    types = len(pair)
    rest = sum(low[min(c, 3)] for c in seen.values()) / types if types else 1.0
    res = []
    for t in texts:
        w, base, lp, known = tokens(t), 0.0, 0.0, 0
        for a, b in zip(["<s>", *w], w, strict=False):
            base += math.log10((uni.get(b, 0) + 1) / (n + v + 1))
            known += b in uni
            p1 = (max(seen[b] - low[min(seen[b], 3)], 0) / types if types and b in seen else 0) + rest / (v + 1)
            g = sum(d[k + 1] * out[a][k] for k in range(3)) / context[a] if a in out else 1.0
            c = pair.get((a, b), 0)
            lp += math.log10((max(c - d[min(c, 3)], 0) / context[a] if c else 0) + g * p1)
        res.append((len(w), known, base, lp))
    return n, res


def test_kneser_ney_against_brute_force(llm, docs, no_docs):
    when = fold("doc_id", 7) != 2
    model = kn_lm.train(docs, when=when)
    rows = kn_lm.score(docs, model, prefix="lm_").collect()
    train = [r["text"] for r in docs.where(when).collect()]
    n, want = brute_kn(train, [r["text"] for r in rows])
    assert model.tokens == n
    for r, (k, known, base, lp) in zip(rows, want, strict=True):
        assert (r["lm_n_tokens"], r["lm_n_known"], r["score"]) == (k, known, "s")
        assert r["lm_base_score"] == pytest.approx(base, rel=1e-9) and r["lm_score"] == pytest.approx(lp, rel=1e-9)
    empty = kn_lm.train(no_docs)
    assert kn_lm.score(docs, empty, prefix="lm_").where(F.col("lm_score") == 0).count() == docs.count()  # one unknown token, probability 1
    assert kn_lm.score(no_docs, model).count() == 0


def test_kneser_ney_of_all_short_texts(llm):
    texts = ["a b a c", "a b b a", "c a b", "a a a b c d e f a b"]
    model = kn_lm.train(llm.createDataFrame([(t,) for t in texts], "text string"))
    words = [*sorted({w for t in texts for w in t.split()}), "zz"]
    asked = ["", *words, *(f"{v} {w}" for v in words for w in words)]
    got = {r["text"]: 10 ** r["score"] for r in kn_lm.score(llm.createDataFrame([(t,) for t in asked], "text string"), model).collect()}
    _, rows = brute_kn(texts, asked)
    assert got == pytest.approx({t: 10 ** r[3] for t, r in zip(asked, rows, strict=True)})
    # all texts of no, one or two words are a part of all texts
    assert sum(got.values()) < 1


def test_toxicity_learns_from_all_labelled_texts(llm):
    """More labelled texts than one share holds, each with a word of its own:
    the embedding must have met most of the words, not those of a sample."""
    from tesela.llm.bytewords import ALNUM, split_words

    n = 10_000
    spark_rows = llm.range(n).selectExpr("id as doc_id", "concat(substr(md5(concat('w', id)), 1, 12), if(id % 2 = 0, ' zzvil', ' plain')) as text", "if(id % 3 = 0, 'en', 'es') as lang", "cast(id % 2 = 0 as int) as toxic")
    model = cnn_toxicity.train(spark_rows.select("doc_id", "text", "lang"), spark_rows.select("doc_id", "toxic"))
    words = [r["w"].encode() for r in spark_rows.selectExpr("split(text, ' ')[0] as w").collect()]
    w = split_words(np.frombuffer(b"".join(words), np.uint8), np.arange(n + 1) * 12, ALNUM)
    assert model.table[cnn_toxicity.buckets_of(w)[:, 0]].any(1).mean() > 0.7
    assert set(model.thresholds) == {"", "en", "es"}
    got = cnn_toxicity.score(spark_rows, model, name="s").select("s", "toxic").collect()
    assert np.mean([(r["s"] >= 0.5) == (r["toxic"] == 1) for r in got]) > 0.99
    # the same model in another run
    again = cnn_toxicity.train(spark_rows.select("doc_id", "text", "lang"), spark_rows.select("doc_id", "toxic"))
    assert (again.table == model.table).all() and again.thresholds == model.thresholds
