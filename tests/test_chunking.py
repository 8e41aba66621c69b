"""The native chunk fold against a plain-Python fold of the same rule, on
whole document texts."""



from pyspark.sql import functions as F

from small_tables import SF_SMALL
from tesela.operators import documents as D


def python_chunks(content, size, overlap):
    out, cur, cur_size = [], [], 0
    for piece in content.split(" | "):
        n = len(piece)
        if cur_size + n > size and cur:
            out.append(" | ".join(cur))
            keep, tot = [], 0
            for p in reversed(cur):
                if tot + len(p) > overlap:
                    break
                keep.insert(0, p)
                tot += len(p)
            cur, cur_size = keep, tot
        cur.append(piece)
        cur_size += n
    if cur:
        out.append(" | ".join(cur))
    return out


def test_literal_case(spark):
    df = spark.createDataFrame([("d", "aa | bb | cc | dd")], "id string, content string")
    got = [r["content"] for r in D.split_documents(df, 5, 2, keep=("id",)).orderBy("chunk_no").collect()]
    assert got == python_chunks("aa | bb | cc | dd", 5, 2) == ["aa | bb", "bb | cc", "cc | dd"]


def test_empty_content_gives_one_empty_chunk(spark):
    df = spark.createDataFrame([("d", "")], "id string, content string")
    got = [r["content"] for r in D.split_documents(df, 10, 2, keep=("id",)).collect()]
    assert got == [""]


def test_documents_table_against_python(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(
        F.col("doc_id").alias("id"), D.sentences_as_pieces(F.col("text")).alias("content"))
    for size, overlap in [(1000, 100), (300, 60)]:
        got = {}
        for r in D.split_documents(docs, size, overlap, keep=("id",)).collect():
            got.setdefault(r["id"], []).append((r["chunk_no"], r["content"]))
        for r in docs.collect():
            want = python_chunks(r["content"], size, overlap)
            assert [c for _, c in sorted(got[r["id"]])] == want
