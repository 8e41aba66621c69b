"""Documents of sf0.001 and awkward rows for the operators' tests."""

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, license int, quality string, text_of_score string, label int"


def rows_of(spark, extra=()):
    """Documents of sf0.001 with awkward rows and clashing extra columns."""
    base = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(80).collect()]
    long = " ".join(f"w{i % 997}" for i in range(60_000))
    odd = [(9001, None, "en", "src1", 0), (9002, "", None, None, 0), (9003, "   \n\t ", "en", None, 5), (None, "a text without an id", "en", "src1", 20),
           (9004, long, "en", "src2", len(long)), (9005, "tie tie tie", "en", "src2", 11), (9005, "tie tie tie", "en", "src2", 11), (9006, "één ünï\u00a0code 中文 \U0001F600 words", "xx", "src3", 20), (None, None, None, None, None)]
    return [(*r, "s", 1, "q", "t", 2) for r in [*base, *odd, *extra]]
