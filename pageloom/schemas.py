"""Explicit schemas of every table the engine reads or writes."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "strings": T.ArrayType(T.StringType()),
    "timestamp": T.TimestampType(),
}


def _schema(**columns: str) -> T.StructType:
    """A schema built without a session, so that modules can be imported before there is one."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


SITES = _schema(
    site_id="bigint",
    domain="string",
    start_url="string",
    last_visited="timestamp",
    active="boolean",
    priority="int",
)
KEYWORDS = _schema(kind="string", category="string", keyword="string")
RULES = _schema(domain="string", patterns="strings")
PAGES = _schema(page_id="bigint", url="string", html="string")
PAGE_ITEMS = _schema(
    url="string",
    site_domain="string",
    title="string",
    article_body="string",
    image_urls="strings",
    url_length="int",
    url_depth="int",
    title_length="int",
    text_length="int",
    text_density="double",
    xpath="string",
    source_xpath="string",
    has_date_pattern_in_url="boolean",
    is_category_link="boolean",
    has_trafilatura_meta="boolean",
    is_article_in_category="boolean",
)
LABELLED_ITEMS = T.StructType(
    [
        *PAGE_ITEMS.fields,
        *_schema(
            xpath_depth="int",
            xpath_contains_article="int",
            xpath_contains_main_content="int",
            xpath_contains_story="int",
            label="string",
        ).fields,
    ]
)
ARTICLES = _schema(
    article_id="bigint",
    site_id="bigint",
    url="string",
    title="string",
    body="string",
    image_url="string",
    content_hash="string",
    scraped_at="timestamp",
    last_cited_date="timestamp",
)
CHANGES = _schema(
    url="string", site_id="bigint", ingest_seq="bigint", content_hash="string", status="string"
)
RUN_STATS = _schema(
    domain="string",
    total_pages="bigint",
    new_count="bigint",
    unchanged_count="bigint",
    updated_count="bigint",
    predicted_articles="bigint",
    filtering_pct="double",
    status="string",
)


class MissingColumns(ValueError):
    """A required input column is absent."""


class EmptyInput(ValueError):
    """An input holds no usable row."""


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise MissingColumns(f"required columns missing: {', '.join(missing)}")
    return df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to the schema's columns and types; absent columns become null."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
