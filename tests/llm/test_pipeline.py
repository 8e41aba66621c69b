"""The pipeline's stages, each against its predecessor's rows."""

import re

import pytest
from odd_rows import SCHEMA, rows_of

import corpus_pipeline
from tesela.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(llm, tmp_path_factory):
    docs = llm.createDataFrame(rows_of(llm), SCHEMA)
    out = [docs]
    for k, (_, f) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(k))
        f(llm, out[-1], SF).write.parquet(path)
        out.append(llm.read.parquet(path))
    return out


def test_columns_and_rows(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality classifier", "near duplicates", "benchmark decontamination", "mixing sources"]
    for a, b in zip(stages, stages[1:-1], strict=False):
        assert a.columns == b.columns and 0 < b.count() <= a.count()
    ids = [{r["doc_id"] for r in s.collect()} for s in stages]
    assert all(b <= a for a, b in zip(ids, ids[1:], strict=False))
    mixed = stages[-1].collect()
    assert all(0 <= r["taken"] == r["copies"] * r["size"] and r["copies"] <= 3 for r in mixed)


def test_contaminated_documents_go(llm, stages):
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = set()
    for r in llm.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = re.findall(word, r["text"].lower())
        windows |= {tuple(w[i:i + 13]) for i in range(max(len(w) - 12, 1))}
    sizes = {len(w) for w in windows}
    want = []
    for r in stages[3].collect():
        w = re.findall(word, (r["text"] or "").lower())
        hit = {i + k for n in sizes for i in range(len(w) - n + 1) if tuple(w[i:i + n]) in windows for k in range(n)}
        if not hit or 20 * len(hit) < len(w):
            want.append((r["doc_id"], len(w) - len(hit)))
    got = [(r["doc_id"], len(re.findall(word, (r["text"] or "").lower()))) for r in stages[4].collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_empty_documents(llm):
    docs = llm.createDataFrame([], SCHEMA)
    for _, f in corpus_pipeline.STAGES:
        out = f(llm, docs, SF)
        assert out.count() == 0


def test_registered_queries_have_all_operators():
    names = list(queries.QUERIES)
    assert [n.split("_")[0] for n in names] == [f"op{k}" for k in range(1, 14)] + ["pipeline"]
