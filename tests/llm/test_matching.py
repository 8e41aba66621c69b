"""Operators 7, 8 and 10 against brute force and round trips."""

import base64
import hashlib
import re

import numpy as np
import pytest
from odd_rows import SCHEMA, rows_of

from tesela.llm import decontaminate, icws_dedup, shared, warc_chain
from tesela.llm.components import components

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def norm(t):
    return re.findall(WORD, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


@pytest.mark.parametrize("block", [100_000, 40])
def test_decontaminate_against_brute_force(llm, no_docs, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
    rng = np.random.default_rng(2)
    letters = [f"L{k}" for k in range(4)]
    items = [(i, " ".join(rng.choice(letters, rng.integers(1, 30)))) for i in range(12)] + [(50, "solo"), (51, "Two words"), (51, "other text of the same id"), (None, "has no id here"), (52, None), (53, "  ,. "),
             (54, " ".join(f"long{k}" for k in range(120)))]
    items += [(60 + k, t) for k, t in enumerate(r["text"] for r in llm.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect())]
    extra = [(9300 + i, " ".join(rng.choice(letters, rng.integers(1, 200))), "en", "s", 1) for i in range(15)]
    extra += [(9400, "x " * 30 + " ".join(f"long{k}" for k in range(27, 55)) + " y, z", "en", "s", 1), (9401, "a Solo. it HAS no id, here two-words", "en", "s", 1)]
    df = llm.createDataFrame(rows_of(llm, extra), SCHEMA)
    bench = llm.createDataFrame(items, "item_id long, text string").repartition(3)
    windows = {}
    for name, t in items:
        w = norm(t)
        for i in range(max(len(w) - 12, 1) if w else 0):
            windows.setdefault(tuple(w[i:i + 13]), set()).add(name)
    lengths = sorted({len(w) for w in windows})
    for r in decontaminate.decontaminate(df, bench, prefix="d_").collect():
        w = norm(r["text"])
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                names = windows.get(tuple(w[i:i + n]))
                if names:
                    hit |= set(range(i, i + n))
                    found |= names
        assert (r["d_n_words"], r["d_n_hit"]) == (len(w), len(hit)), r["doc_id"]
        assert r["d_items"] == sorted(str(x) for x in found if x is not None)
        assert norm(r["d_clean_text"]) == [x for i, x in enumerate(w) if i not in hit] or not hit
        assert hit or r["d_clean_text"] == r["text"]
    assert decontaminate.decontaminate(no_docs, bench).count() == 0
    assert decontaminate.decontaminate(df, bench.limit(0)).where("n_hit > 0").count() == 0


def test_warc_round_trip(llm):
    trap = "see WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 12\r\n\r\nHTTP/1.1 200\r\n\r\nxx\r\n\r\n"
    rows = [(i, f"http://h/{i}", f"page {i} " + "é" * (i % 50)) for i in range(300)]
    rows += [(300, "u\r\nX: y", trap * 3), (301, None, None), (302, "u", ""), (303, "u", "page 7 " + "é" * 7), (304, "u", trap), (305, "u", "WARC/1.1\r\n" * 50), (7, "again", rows[7][2]), (None, "u", "page 7 " + "é" * 7),
             (None, "u", "only null"), (306, "u", "long " * 40_000), (306, "u", "long " * 40_000)]
    df = llm.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, payload string").repartition(4)
    got = sorted((tuple(r) for r in warc_chain.round_trip(df, file_bytes=60_000, split_bytes=5_000).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact").collect()), key=repr)
    top = {}
    for i, _, h in rows:
        if i is not None:
            top[h or ""] = max(top.get(h or "", -1), i)
    want = []
    for i, _, h in rows:
        b = (h or "").encode()
        t = top.get(h or "")
        other = t is not None and t != i
        want.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if other else "response", t if other else None, True))
    assert got == sorted(want, key=repr)
    assert warc_chain.round_trip(df.limit(0)).count() == 0


def test_chain_rejects_magic_in_payloads(llm):
    inner = warc_chain.record(5, "u", b"inner", "D", None)
    df = llm.createDataFrame([(1, "u", (b"<pre>" + inner * 4).decode()), (2, "u", "plain")], "page_id long, url string, html string").coalesce(1)
    folder = shared.new_folder(llm, "warc-test")
    manifest = warc_chain.write(warc_chain.decide(df), folder)
    found = warc_chain.candidates(manifest, folder, 500)
    assert found.count() == 6 and warc_chain.reachable(found, folder).count() == 2
    assert {r["page_id"] for r in warc_chain.read(warc_chain.reachable(found, folder), folder).collect()} == {1, 2}


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


@pytest.fixture(scope="module")
def copies(llm):
    """Exact copies, and a group of near copies with few to many edits."""
    rng = np.random.default_rng(4)
    base = [f"b{k}" for k in range(150)]
    extra = [(9500 + i, " ".join(f"X{k}" for k in range(70)), "en", "hot", 1) for i in range(25)]
    for i in range(60):
        t = list(base)
        for j in rng.integers(0, 150, rng.integers(0, 9)):
            t[j] = f"edit{i}-{j}"
        extra.append((9600 + i, " ".join(t), "en", "hot", 1))
    extra += [(9700, "Few words", "en", "s", 1), (9701, "few\nWORDS", "en", "s", 1)]
    return llm.createDataFrame(rows_of(llm, extra), SCHEMA).repartition(6)


def test_near_duplicates_against_brute_force(llm, copies, no_docs):
    rows = copies.select("doc_id", "text").collect()
    out = icws_dedup.near_duplicates(copies).collect()
    assert len(out) == len(rows)
    sets = [shingles(r["text"]) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a == b or (a & b and len(a & b) / len(a | b) >= 0.8):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    label = {r["doc_id"]: r["class_id"] for r in out if r["doc_id"] is not None}
    for i, r in enumerate(rows):
        for j in range(i):
            s = rows[j]
            if r["doc_id"] is not None and s["doc_id"] is not None and find(i) == find(j):
                assert label[r["doc_id"]] == label[s["doc_id"]], (r["doc_id"], s["doc_id"])
    # classes join no texts that share little
    for i, r in enumerate(rows):
        if r["doc_id"] is not None and label[r["doc_id"]] != r["doc_id"]:
            rep = next(k for k, s in enumerate(rows) if s["doc_id"] == label[r["doc_id"]])
            assert sets[i] == sets[rep] or len(sets[i] & sets[rep]) / len(sets[i] | sets[rep]) > 0.4
    assert label[9524] == 9500 and label[9701] == 9700 and label[9002] == 9001
    kept = icws_dedup.keep_one(copies)
    assert kept.columns == copies.columns
    classes = {(r["class_id"], r["text_hi"] if r["class_id"] is None else 0) for r in out}
    assert kept.count() == len(classes) and kept.where("doc_id = 9005").count() == 1
    assert icws_dedup.near_duplicates(no_docs).count() == 0 and icws_dedup.keep_one(no_docs).count() == 0


def test_weighted_similarity_and_sampling():
    a = (np.array([1, 2, 3], np.uint64), np.array([1, 2, 1], np.float32))
    b = (np.array([2, 3, 9], np.uint64), np.array([1, 3, 1], np.float32))
    assert icws_dedup.similarities(a, b) == pytest.approx((2 / 7, 0.5))
    # the share of equal samples estimates the weighted Jaccard similarity
    rng = np.random.default_rng(0)
    h = rng.integers(0, 2**63, 400, dtype=np.uint64)
    w = rng.random(400) + 1
    x = np.concatenate([h[:350], h[50:]])
    first = np.array([0, 350, 700])
    s = icws_dedup.signatures(x, np.concatenate([w[:350], w[50:]]), first, 400)
    true = w[50:350].sum() / w.sum()
    assert abs((s[0] == s[1]).mean() - true) < 0.08


def test_components(llm):
    chain = [(i, i + 1) for i in range(100, 140)] + [(1, 2), (5, 2), (7, 7)]
    got = {r["node"]: r["label"] for r in components(llm.createDataFrame(chain, "a long, b long"), shared.new_folder(llm, "cc-test")).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, 1: 1, 2: 1, 5: 1}
