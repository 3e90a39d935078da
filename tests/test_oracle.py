"""Every check query against its DuckDB SQL on the smallest tables."""

import collections
import pathlib

import duckdb
import pytest

import __spark_entry__ as entry
from checks.catalog import ORACLE_SQL as ORACLE
from checks.catalog import QUERIES

SF_DIR = pathlib.Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, str(SF_DIR))
    columns = sorted(df.columns)
    rows = collections.Counter(repr(tuple(r[c] for c in columns)) for r in df.collect())
    assert rows
    if name not in ORACLE:
        return
    result = duck.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert rows == collections.Counter(
        repr(tuple(row[i] for i in order)) for row in result.fetchall()
    )


def test_only_models_lack_sql():
    """Fit, scores and reload as such; their checkable facts are queries of their own."""
    assert set(QUERIES) - set(ORACLE) == {"m6_fit_forest", "m9_predict_labels", "k6_model_round_trip"}


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == [
        "domain", "total_pages", "predicted_articles", "filtering_pct", "is_total",
    ]
    assert df.where("is_total").count() == 1
