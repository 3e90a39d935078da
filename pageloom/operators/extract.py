"""Page extraction: text, title, image, metadata."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions import html as H
from pageloom.functions import urls as U
from pageloom.operators.cleanup import apply_patterns, drop_boilerplate_lines, with_patterns


def extract_main_text(pages: DataFrame) -> DataFrame:
    return pages.withColumn("article_body", H.main_text(F.col("html")))


def with_markup(pages: DataFrame) -> DataFrame:
    """Add the visible markup and, for cheap look-ups, its ``<meta>`` tags."""
    marked = pages.withColumn("markup", H.visible_markup(F.col("html")))
    return marked.withColumn("metas", H.meta_tags(F.col("markup")))


def extract_metadata(pages: DataFrame) -> DataFrame:
    """Title, image list and the flag for pages that state both date and author."""
    return metadata_of(with_markup(pages))


def metadata_of(marked: DataFrame) -> DataFrame:
    """The same for pages with their markup, which ends here."""
    markup, metas = F.col("markup"), F.col("metas")
    described = marked.withColumns(
        {
            "title": H.page_title(markup, metas),
            "image": H.main_image(markup, metas),
            "has_trafilatura_meta": H.has_author_and_date(markup, metas),
        }
    )
    no_image = F.array().cast("array<string>")
    return described.withColumn(
        "image_urls",
        F.when(
            F.col("image").isNotNull(), F.array(U.url_join(F.col("url"), F.col("image")))
        ).otherwise(no_image),
    ).drop("markup", "metas", "image")


def fill_empty_bodies(pages: DataFrame) -> DataFrame:
    """Fallback text for pages whose body is empty after cleanup, from ``fallback_body`` or the html."""
    ready = "fallback_body" in pages.columns
    fallback = F.col("fallback_body") if ready else H.fallback_text(F.col("html"))
    filled = F.when(F.col("article_body") == "", fallback).otherwise(F.col("article_body"))
    return pages.withColumn("article_body", filled).drop("fallback_body")


def parse_pages(
    pages: DataFrame, any_rules: bool = True, hrefs: Callable[[Column], Column] | None = None
) -> DataFrame:
    """Everything that a page's html gives, in one pass; no ``html`` is left.

    With rules, which may empty any body, the fallback text is kept beside the main text; without,
    it is only needed where the line filter leaves nothing. The visible markup is made once for all, and ``hrefs``
    gives the column of that name from it.
    """
    marked, markup = with_markup(pages), F.col("markup")
    linked = marked.withColumn("hrefs", hrefs(markup)) if hrefs else marked
    bodies = metadata_of(linked.withColumn("article_body", H.markup_text(markup)))
    if any_rules:
        return bodies.withColumn("fallback_body", H.fallback_text(F.col("html"))).drop("html")
    return fill_empty_bodies(drop_boilerplate_lines(bodies)).drop("html")


def clean_pages(parsed: DataFrame, rules: DataFrame | None) -> DataFrame:
    """Bodies of parsed pages, cleaned by the rules of their sites."""
    return parsed if rules is None else clean_by_patterns(with_patterns(parsed, rules))


def clean_by_patterns(parsed: DataFrame) -> DataFrame:
    """The same for pages that have their patterns."""
    return fill_empty_bodies(drop_boilerplate_lines(apply_patterns(parsed)))


def extract_pages(pages: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """Cleaned body, title, image and metadata flag of each page.

    ``html`` is read in one narrow pass and dropped before the rules are joined.
    """
    return clean_pages(parse_pages(pages, rules is not None), rules)
