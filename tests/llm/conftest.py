import pytest

from pageloom.llm.shared import let_workers_import

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def _workers(spark):
    let_workers_import(spark)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.collect()}


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, ties and repeated rows, and columns with names that operators use."""
    rows = [
        (None, None), (1, None), (2, ""), (3, " \t\n"), (4, "a b c"), (4, "a b c"), (5, "a  b\tc"), (None, "a b c"),
        (6, "word " * 30_000), (7, "x" * 50_000), (8, "é" * 10 + " <|endoftext|> <|im_end|>"), (8, "other text"),
    ]
    made = [(i, t, "src", "k", 1, "r") for i, t in rows]
    return spark.createDataFrame(made, "doc_id long, text string, source string, key string, row int, bucket string")


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string")
