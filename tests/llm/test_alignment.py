"""Token alignment against whole texts, group by group and link by link."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from odd_rows import SCHEMA, rows_of
from tokenizers import Tokenizer

from tesela.llm import token_align, units

A, B = (public_tokenizers.path(n) for n in (token_align.TOKENIZER_A, token_align.TOKENIZER_B))
SIGNS = token_align.byte_level()


def brute(texts):
    """Per text its groups and links by comparing byte ranges."""
    tok_a, tok_b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    tok_a.encode_special_tokens = True
    out = []
    for t in texts:
        full = " " + (t or "")
        a, b = tok_a.encode(full, add_special_tokens=False), tok_b.encode(t or "")
        raw_a = [bytes(SIGNS[c] for c in x) for x in a.tokens]
        raw_b = [bytes([int(p[3:5], 16)]) if tok_b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, tok_b.id_to_piece(i)) for i in b)]
        if not t or b"".join(raw_a) != full.encode() or b"".join(raw_b) != full.encode():
            out.append(None)
            continue
        ids, ends_a = a.ids, list(running(raw_a))
        ends_b = list(running(raw_b))
        cuts = sorted(set(ends_a) & set(ends_b))
        groups, links, i, j = [], [], 0, 0
        for c in cuts:
            k, m = i, j
            while k < len(ends_a) and ends_a[k] <= c:
                k += 1
            while m < len(ends_b) and ends_b[m] <= c:
                m += 1
            groups.append(f"{','.join(map(str, ids[i:k]))}|{','.join(map(str, b[j:m]))}")
            for x in range(i, k):
                for y in range(j, m):
                    if ends_a[x] - len(raw_a[x]) < ends_b[y] and ends_b[y] - len(raw_b[y]) < ends_a[x]:
                        links.append((ids[x], b[y]))
            i, j = k, m
        out.append((len(ids), len(b), ";".join(groups), links, len(groups)))
    return out


def running(raw):
    at = 0
    for r in raw:
        at += len(r)
        yield at


@pytest.mark.parametrize("block, portion, shards", [(units.BLOCK_BYTES, token_align.PORTION, 1024), (900, 4000, 3)])
def test_alignment_against_whole_texts(llm, monkeypatch, block, portion, shards):
    monkeypatch.setattr(units, "BLOCK_BYTES", block)
    monkeypatch.setattr(token_align, "PORTION", portion)
    odd = ["a  b\n\nc\t d  ", " lead", "x <|endoftext|> y <s> </s> <unk> <0x41>", "sign ▁ stands", "▁", "nbsp  em  wide　 nel\u0085 x", "é É ﬁ ½ \U0001F600 中文 字 “q” — z", " ", "  ", "\n", "\x00 nul \x1c y", "it's we'll 12 345 a1b2",
           "aaaa" * 700, "long " * 600 + "▁", "word " * 700]
    rows = rows_of(llm, [(9600 + k, t, "en", "s", 1) for k, t in enumerate(odd + odd[:3] + ["copy of all"] * 60)])
    df = llm.createDataFrame(rows, SCHEMA).repartition(4)
    want = brute([r[1] for r in rows])
    counts = Counter(x for w in want if w for x in w[3])
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(top.get(b, 0), n)
    aligned = token_align.align_texts(df, A, B, keep_groups=True)
    got = Counter()
    for r in token_align.measure(df, aligned, prefix="m_").collect():
        got[(r["doc_id"], *(r["m_" + n] for n in (*token_align.MEASURES, "groups_sha256")))] += 1
    expected = Counter()
    for r, w in zip(rows, want, strict=True):
        if w is None:
            expected[(r[0], 0, 0, 0, 0, 0, 0, "")] += 1
        else:
            expected[(r[0], w[0], w[1], w[4], len(w[3]), sum(counts[x] == top[x[1]] for x in w[3]), sum(counts[x] for x in w[3]), hashlib.sha256(w[2].encode()).hexdigest())] += 1
    assert got == expected
    assert {(r["a_id"], r["b_id"]): (r["links"], r["is_best"]) for r in aligned.pair_counts().collect()} == {x: (n, n == top[x[1]]) for x, n in counts.items()}
    by_key = {hashlib.sha256(r[1].encode()).hexdigest(): w[2] for r, w in zip(rows, want, strict=True) if w}
    kept = {r["text_key"]: r["groups"] for r in aligned.texts.collect()}
    assert {k: g for k, g in kept.items() if g} == by_key


def test_empty_table_and_small_cases(llm, no_docs):
    aligned = token_align.align_texts(no_docs, A, B)
    assert aligned.texts.count() == 0 and aligned.pair_counts().count() == 0
    assert token_align.measure(no_docs, aligned).count() == 0
    of_a, of_b, i, j = token_align.align(np.array([2, 2, 1, 4]), np.array([3, 2, 4]))
    assert of_a.tolist() == [0, 0, 0, 1] and of_b.tolist() == [0, 0, 1]
    assert list(zip(i.tolist(), j.tolist(), strict=True)) == [(0, 0), (1, 0), (1, 1), (2, 1), (3, 2)]
    text, ends = token_align.groups_text(np.array([1, 20, 300, 4]), np.array([7, 81, 9]), of_a, of_b, token_align.Decimals(400))
    assert text.tobytes() == b"1,20,300|7,81;4|9;" and ends.tolist() == [14, 18]
    assert len(set(SIGNS.values())) == 256


def test_groups_of_sf001_against_whole_texts(llm):
    df = llm.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = df.collect()
    want = {r["doc_id"]: w for r, w in zip(rows, brute([r["text"] for r in rows]), strict=True)}
    for r in token_align.measure(df, token_align.align_texts(df, A, B)).collect():
        w = want[r["doc_id"]]
        assert (r["n_a"], r["n_b"], r["n_links"]) == ((w[0], w[1], len(w[3])) if w else (0, 0, 0))
        assert r["groups_sha256"] == (hashlib.sha256(w[2].encode()).hexdigest() if w else "")
