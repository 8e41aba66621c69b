"""Packing: every id in exactly one piece, sequences gapless, little padding."""

import numpy as np
import public_tokenizers
import pytest
from odd_rows import SCHEMA, rows_of
from tokenizers import Tokenizer

from tesela.llm import ffd_pack, units

PATH = public_tokenizers.path(ffd_pack.TOKENIZER)


def whole(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, ffd_pack.END]


@pytest.mark.parametrize("block", [units.BLOCK_BYTES, 700])
def test_pieces_hold_every_id_once(llm, monkeypatch, block):
    monkeypatch.setattr(units, "BLOCK_BYTES", block)
    tokenizer = Tokenizer.from_file(PATH)
    extra = [(9500, "a <|endoftext|> b<|startoftext|>c \x01 x\x01y ▁ É́ Å  nbsp em　wide\u0085nel ΑΣ ΟΔΟΣ İstanbul it's don't 123abc ½", "en", "s", 1),
             (9505, "<|EndOfText|> A.B,c;d: e!f? g.\u0338 h.. ,i 'S .T x.\u0301y É.é It's. i'LL,", "en", "s", 1), (9501, "z" * 5000 + " " + "q" * 9, "en", "s", 1), (9502, "́ ́a e ́", "en", "s", 1), (9503, " \v\f\r\n", "en", "s", 1)]
    rows = rows_of(llm, extra)
    df = llm.createDataFrame(rows, SCHEMA).repartition(3)
    out = ffd_pack.pack(df, PATH, group_bytes=100_000).collect()
    texts = {}
    for r in rows:
        texts.setdefault(r[0], []).append(r[1])
    pieces, sequences = {}, {}
    for r in out:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
        assert r["length"] * 4 == len(r["ids"]) and 0 < r["length"] <= ffd_pack.CAPACITY
    for doc, given in texts.items():
        want = [whole(tokenizer, t) for t in given]
        total = sorted(x for w in want for x in w)
        got = sorted(int(x) for r in pieces[doc] for x in np.frombuffer(r["ids"], "<u4"))
        assert got == total, doc
        if len(given) == 1:
            mine = sorted(pieces[doc], key=lambda r: r["start"])
            assert np.concatenate([np.frombuffer(r["ids"], "<u4") for r in mine]).tolist() == want[0], doc
            assert [r["start"] for r in mine] == list(np.cumsum([0, *(r["length"] for r in mine)])[:-1])
            assert {r["doc_tokens"] for r in mine} == {len(want[0])}
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= ffd_pack.CAPACITY
    joined = {r["sequence_id"]: r for r in ffd_pack.sequences(ffd_pack.pack(df, PATH, group_bytes=100_000)).collect()}
    assert set(joined) == set(sequences)
    assert all(r["used"] * 4 == len(r["ids"]) for r in joined.values())


def test_first_fit_is_the_plain_one():
    rng = np.random.default_rng(5)
    for _ in range(30):
        sizes = sorted(rng.integers(1, 60, rng.integers(1, 200)).tolist(), reverse=True)
        room, want = [], []
        for s in sizes:
            k = next((k for k, free in enumerate(room) if free >= s), len(room))
            room += [60] if k == len(room) else []
            want.append((k, 60 - room[k]))
            room[k] -= s
        assert list(zip(*ffd_pack.first_fit(sizes, 60), strict=True)) == want


def test_padding_and_empty_table(llm, no_docs):
    df = llm.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = ffd_pack.pack(df.select("doc_id", "text"), PATH)
    used = [r["u"] for r in out.groupBy("sequence_id").agg({"length": "sum"}).toDF("s", "u").collect()]
    lost = sum(map(ffd_pack.padding, used))
    assert lost < 0.01 * sum(used)
    assert ffd_pack.pack(no_docs, PATH).count() == 0
    clash = ffd_pack.pack(df.limit(20).selectExpr("doc_id", "text", "1 as start", "'x' as ids"), PATH, prefix="p_")
    assert {"start", "ids", "p_start", "p_ids"} <= set(clash.columns) and clash.where("start = 1 and ids = 'x'").count() >= 20


def test_a_long_text_is_coded_in_blocks(monkeypatch):
    """Blocks of a long text never hold much more than the bound."""
    import pyarrow as pa

    monkeypatch.setattr(units, "BLOCK_BYTES", 1000)
    text = " ".join(f"w{i}" for i in range(5000))
    got = list(units.blocks(pa.array([text, "short"]), units.spaces))
    assert max(len(b[2]) for b in got) <= 1000 and b"".join(b[2].tobytes() for b in got) == (text + "short").encode()
