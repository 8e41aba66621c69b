"""Collocations against plain counting."""

import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from odd_rows import SCHEMA, rows_of

from tesela.llm import collocations, units


def brute(rows, max_words=3, least=10, covered=50, top=2000):
    counts, total = Counter(), Counter()
    for lang, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\\x0A-\\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(words)
            for k in range(1, max_words + 1):
                counts.update((lang or "und", tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    found = {x: a for x, a in counts.items() if len(x[1]) > 1 and a >= least}
    dropped = {(lang, p[i:i + k]) for (lang, p), f in found.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * f >= covered * found[lang, p[i:i + k]]}
    out = {}
    for (lang, p), a in found.items():
        if (lang, p) not in dropped:
            cuts = [(10**6 * a * a // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
    return {(lang, i + 1, p.decode(), -a, x, y, total[lang], -s) for lang, all_ in out.items() for i, (s, a, p, x, y) in enumerate(sorted(all_)[:top])}


def mined(df, **how):
    return {(r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in collocations.mine(df, **how).collect()}


@pytest.mark.parametrize("block, entries, crowded, how", [
    (units.BLOCK_BYTES, collocations.ENTRIES, 50, {"least": 3, "top": 300}), (300, 500, 5, {"least": 2, "max_words": 5, "covered": 70, "top": 100}), (700, 900, 10**9, {"max_words": 2})])
def test_against_plain_counting(llm, monkeypatch, block, entries, crowded, how):
    monkeypatch.setattr(units, "BLOCK_BYTES", block)
    monkeypatch.setattr(collocations, "ENTRIES", entries)
    monkeypatch.setattr(collocations, "CROWDED", crowded)
    rng = np.random.default_rng(3)
    some = [f"w{k}" for k in range(12)]
    marks = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\v\f", " ; ", "! "]
    rows = [tuple(r) for r in rows_of(llm, [(9700 + i, "".join(str(rng.choice(some)) + str(rng.choice(marks)) for _ in range(rng.integers(0, 300))), str(rng.choice(["en", "de", "und"])), "s", 1) for i in range(30)]
            + [(9800, "A b A\x00c É é A b. a B," * 40, None, "s", 1), (9801, "tie one. tie two. " * 12, "1:x", "s", 1), (9802, " ".join(["no", "stop", "here"] * 400), "en", "s", 1), (9803, "... , ,, \n\n" * 300 + "x y", "en", "s", 1)])]
    rows = [r for r in rows if r[0] is None or r[0] < 40 or r[0] > 9000]
    df = llm.createDataFrame(rows, SCHEMA).repartition(4)
    assert mined(df, **how) == brute([(r[2], r[1]) for r in rows], **how)


def test_word_hash_and_empty_table(llm, no_docs):
    for lang, word in (("en", "a"), ("", "w" * 37), ("únd", "日本語" * 9)):
        h = llm.createDataFrame([(lang, word)], "lang string, word string").select(collocations.word_hash(7)).first()[0]
        first = xxhash.xxh64_intdigest((7).to_bytes(8, "little"), 42)
        assert h % (1 << 64) == xxhash.xxh64_intdigest(word.encode(), xxhash.xxh64_intdigest(lang.encode(), first))
    assert collocations.mine(no_docs).count() == 0


def test_tiles_count_alike_dense_or_not(monkeypatch):
    rng = np.random.default_rng(8)
    u, w = rng.zipf(1.3, 60_000) % 70_000, rng.zipf(1.3, 60_000) % 5000
    want = Counter(zip(u.tolist(), w.tolist(), strict=True))
    for crowded in (10, 10**9):
        monkeypatch.setattr(collocations, "CROWDED", crowded)
        tiles = collocations.Tiles(5000, 7, 0)
        got = Counter()
        batches = [b for k in range(0, 60_000, 9000) for b in tiles.add(u[k:k + 9000], w[k:k + 9000])]
        assert bool(tiles.dense) == (crowded == 10)
        for batch in [*batches, *tiles.flush()]:
            for _, keys, counts in collocations.totals.unpacked(batch):
                for x, y, n in zip(*(a.tolist() for a in tiles.pairs(keys)), counts.tolist(), strict=True):
                    got[x, y] += n
        assert got == want
