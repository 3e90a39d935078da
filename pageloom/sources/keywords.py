"""Keyword lists of the frontier filters."""

import dataclasses
import warnings
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom import fixed_values
from pageloom.schemas import KEYWORDS


@dataclasses.dataclass(frozen=True)
class KeywordLists:
    """Lower-cased keywords: those that mark a category link, and those that drop a URL."""

    category: list[str]
    irrelevant: list[str]


def keyword_table(
    spark: SparkSession,
    categories: dict[str, list[str]],
    general: Iterable[str],
    irrelevant: Iterable[str],
) -> DataFrame:
    rows = [("category", name, kw) for name, words in categories.items() for kw in words]
    rows += [("general", None, kw) for kw in general]
    rows += [("irrelevant", None, kw) for kw in irrelevant]
    return spark.createDataFrame(rows, KEYWORDS).withColumn("keyword", F.lower("keyword"))


def default_keywords(spark: SparkSession) -> DataFrame:
    return keyword_table(
        spark,
        fixed_values.CATEGORY_KEYWORDS,
        fixed_values.GENERAL_CATEGORY_KEYWORDS,
        fixed_values.IRRELEVANT_KEYWORDS,
    )


def read_keywords_yaml(spark: SparkSession, path: str) -> DataFrame:
    """Keywords of a YAML configuration file.

    The three parts are read one after another; from the first that cannot be read on, all are left
    out, with a warning.
    """
    categories, general, irrelevant = {}, [], []
    try:
        import yaml

        text = "\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())
        config = yaml.safe_load(text) or {}
        parts = (config.get("categories") or {}).items()
        categories = {name: [str(k) for k in entry.get("keywords", [])] for name, entry in parts}
        general = config.get("general_category_keywords", [])
        irrelevant = config.get("irrelevant_keywords", [])
    except Exception as error:
        warnings.warn(f"keywords of {path} not fully read: {error}")
    return keyword_table(spark, categories, general, irrelevant)


def keyword_lists(keywords: DataFrame) -> KeywordLists:
    """The lists as Python values for literal predicates.

    They come from a configuration file, which the driver has read as a whole.
    """
    rows = keywords.select("kind", "keyword").distinct().collect()
    return KeywordLists(
        category=sorted({r["keyword"] for r in rows if r["kind"] != "irrelevant"}),
        irrelevant=sorted({r["keyword"] for r in rows if r["kind"] == "irrelevant"}),
    )
