import pytest
from odd_rows import SCHEMA, SF, rows_of


@pytest.fixture(scope="session")
def llm(spark):
    from tesela.llm.util import ship

    ship(spark)
    return spark


@pytest.fixture(scope="session")
def docs(llm):
    return llm.createDataFrame(rows_of(llm), SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def no_docs(llm):
    return llm.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(llm):
    return llm.read.parquet(f"{SF}/labels.parquet").unionByName(llm.createDataFrame([(None, 1, 1), (9001, None, None), (1, 7, 7)], "doc_id long, quality int, toxic int"))


def by_id(df):
    return {r["doc_id"]: r for r in df.collect() if r["doc_id"] is not None}
