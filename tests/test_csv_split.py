"""CSV files are split at line ends unless a quoted field spans one."""

import os

import pytest

from tesela.sources import landed


def put(root, name, text):
    os.makedirs(root, exist_ok=True)
    with open(f"{root}/{name}", "w", newline="") as f:
        f.write(text)


PLAIN = 'a,b\n1,"x, ""y"""\n2,z\n\n3,NA\n'
MULTI = 'a,b\n4,"two\nlines ""q"" here"\n5,"end\n"\n6,plain\n'
CRLF = 'a,b\r\n7,"u"\r\n8,v\r\n'
LONE = 'a,b\n9,"c\rd"\n10,e\n'
BLANK = 'a,b\n11,f\n   \n12,g\n'


@pytest.fixture()
def folder(tmpdir_path):
    root = f"{tmpdir_path}/in put"
    for name, text in (("plain.csv", PLAIN), ("multi-1.csv", MULTI), ("crlf.csv", CRLF), ("lone.csv", LONE), ("blank.csv", BLANK), ("empty.csv", "")):
        put(root, name, text)
    return root


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_same_rows_as_reading_every_file_whole(spark, folder):
    plain, multi = landed.csv_files(spark, folder)
    assert [os.path.basename(f) for f in plain] == ["crlf.csv", "plain.csv"]
    assert [os.path.basename(f) for f in multi] == ["blank.csv", "lone.csv", "multi-1.csv"]
    whole = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(folder)
    assert rows(landed.read_csv_text(spark, folder, na_tokens=None)) == rows(whole)
    assert rows(landed.read_csv_text(spark, f"{folder}/multi-1.csv", na_tokens=None)) == [("4", 'two\nlines "q" here'), ("5", "end\n"), ("6", "plain")]
    named = landed.scan_directory(spark, folder, "*.csv")
    assert {r["source_file"] for r in named.collect()} == {"plain.csv", "multi-1.csv", "crlf.csv", "lone.csv", "blank.csv"}
    assert named.count() == whole.count()
    assert rows(landed.read_csv_text(spark, [f"{folder}/plain.csv", f"{folder}/crlf.csv"]))[-1] == ("8", "v")


def test_a_large_plain_file_is_many_tasks(spark, tmpdir_path):
    put(f"{tmpdir_path}/t", "big.csv", "a,b\n" + "".join(f'{i},"row {i}"\n' for i in range(60_000)))
    put(f"{tmpdir_path}/t", "small.csv", 'a,b\n-1,"in\nquotes"\n')
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        df = landed.read_csv_text(spark, f"{tmpdir_path}/t")
        assert df.rdd.getNumPartitions() >= 10
        assert df.count() == 60_001 and df.where("b = 'in\nquotes'").count() == 1
        assert df.where("a = '59999' and b = 'row 59999'").count() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


def test_partition_folders_and_schema(spark, tmpdir_path):
    put(f"{tmpdir_path}/p/year=1", "x.csv", PLAIN)
    put(f"{tmpdir_path}/p/year=2", "x.csv", MULTI)
    df = landed.read_csv_text(spark, f"{tmpdir_path}/p", na_tokens=None)
    assert df.columns == ["a", "b", "year"] and df.where("year = 2").count() == 3
    typed = landed.read_csv_text(spark, f"{tmpdir_path}/p/year=1", spark.createDataFrame([], "a string, b string").schema)
    assert rows(typed) == [("1", 'x, "y"'), ("2", "z"), ("3", None)]
    assert landed.read_csv_or_empty(spark, f"{tmpdir_path}/none", typed.schema).count() == 0
