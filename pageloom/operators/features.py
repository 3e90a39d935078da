"""Page features and the rule label."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.fixed_values import ARTICLE_TEXT_CHARS, ARTICLE_TITLE_CHARS, FEATURES
from pageloom.functions import urls as U
from pageloom.functions.text import count_of
from pageloom.schemas import PAGE_ITEMS, conform


def text_density(body: Column) -> Column:
    """Characters per paragraph; 0 for an empty text."""
    return F.when(
        F.length(body) > 0, F.length(body) / (count_of(body, "\n\n") + 1)
    ).otherwise(F.lit(0.0))


def add_url_features(df: DataFrame) -> DataFrame:
    url = F.col("url")
    return df.withColumns(
        {
            "url_length": F.length(url),
            "url_depth": count_of(url, "/"),
            "has_date_pattern_in_url": U.has_date_path(url),
        }
    )


def add_text_features(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "title_length": F.coalesce(F.length("title"), F.lit(0)),
            "text_length": F.length("article_body"),
            "text_density": text_density(F.col("article_body")),
        }
    )


def add_rule_label(df: DataFrame) -> DataFrame:
    """``is_article_in_category``: a long titled text that is *not* behind a category link."""
    rule = (
        ~F.coalesce(F.col("is_category_link"), F.lit(False))
        & (F.col("text_length") > ARTICLE_TEXT_CHARS)
        & (F.col("title_length") > ARTICLE_TITLE_CHARS)
    )
    return df.withColumn("is_article_in_category", rule)


def page_items(extracted: DataFrame) -> DataFrame:
    """Page items with all features; columns beyond the item schema pass through."""
    flagged = (
        extracted
        if "is_category_link" in extracted.columns
        else extracted.withColumn("is_category_link", F.lit(False))
    )
    full = add_rule_label(add_text_features(add_url_features(flagged)))
    items = [f.name for f in PAGE_ITEMS.fields]
    extra = [c for c in full.columns if c not in items]
    shaped = {
        f.name: F.lit(None).cast(f.dataType) for f in PAGE_ITEMS.fields if f.name not in full.columns
    }
    return (full.withColumns(shaped) if shaped else full).select(*items, *extra)


def structure_path(df: DataFrame, fallback: bool = False) -> Column:
    """Column of the structure path: ``xpath`` when the table has it, else ``source_xpath``.

    With ``fallback`` the choice is made per row.
    """
    names = [c for c in ("xpath", "source_xpath") if c in df.columns]
    if not names:
        return F.lit(None).cast("string")
    return F.coalesce(*names) if fallback else F.col(names[0])


def add_path_features(df: DataFrame, fallback: bool = False) -> DataFrame:
    path = F.coalesce(structure_path(df, fallback), F.lit(""))

    def holds(pattern: str) -> Column:
        return path.rlike(f"(?iU){pattern}").cast("int")

    return df.withColumns(
        {
            "xpath_depth": count_of(path, "/"),
            "xpath_contains_article": holds("article"),
            "xpath_contains_main_content": holds("main|content"),
            "xpath_contains_story": holds("story"),
        }
    )


def aligned_features(df: DataFrame) -> list[Column]:
    """The model's inputs in fixed order as doubles; absent columns and nulls are 0."""
    return [
        (
            F.coalesce(F.col(name).cast("double"), F.lit(0.0))
            if name in df.columns
            else F.lit(0.0)
        ).alias(name)
        for name in FEATURES
    ]


def align_features(df: DataFrame, keep: list[str]) -> DataFrame:
    return df.select(*keep, *aligned_features(df))


def as_page_items(df: DataFrame) -> DataFrame:
    return conform(df, PAGE_ITEMS)
