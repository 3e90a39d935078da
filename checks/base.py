"""Registration of check queries and their SQL, and access to tables and fixtures."""

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.fixtures import FIXTURES

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def with_fixtures(sql: str) -> str:
    """Prefix a SELECT by the fixtures it names, as common table expressions."""
    names: list[str] = []

    def visit(text: str) -> None:
        for name in FIXTURES:
            if name not in names and re.search(rf"\b{name}\b", text):
                visit(FIXTURES[name].replace("{" + name + "}", ""))
                names.append(name)

    visit(sql)
    if not names:
        return sql
    plain = {n: re.sub(r"\{(\w+)\}", r"\1", FIXTURES[n]) for n in names}
    ctes = ",\n".join(f"{n} AS ({plain[n]})" for n in names)
    body = sql.lstrip()
    if body.startswith("WITH "):
        return f"WITH {ctes},\n{body[len('WITH '):]}"
    return f"WITH {ctes}\n{sql}"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a Spark query; ``sql`` may name the fixtures like tables."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = with_fixtures(sql)
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture as a DataFrame over the given tables."""
    sql = FIXTURES[name]
    inputs = set(re.findall(r"\{(\w+)\}", sql))
    frames = {
        n: fixture(spark, sf_dir, n) if n in FIXTURES else table(spark, sf_dir, n)
        for n in inputs
    }
    return spark.sql(sql, **frames)


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry of the pages' hosts."""
    return fixture(spark, sf_dir, "fx_sites")
