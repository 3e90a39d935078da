"""Change detection and upsert of the article state."""

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.fixed_values import NO_TITLE
from pageloom.functions.text import falsy_to_null
from pageloom.functions.urls import key_of, netloc, registry_domain
from pageloom.operators.numbering import RUN_ROWS, Ranged, number_rows, previous_value
from pageloom.operators.registry import site_lookup
from pageloom.schemas import ARTICLES, CHANGES, conform


def only_articles(predictions: DataFrame) -> DataFrame:
    return predictions.where(F.lower(F.coalesce("predicted_label", F.lit(""))) == "article")


def with_url_domain(df: DataFrame) -> DataFrame:
    return df.withColumn("domain", registry_domain(netloc(F.col("url"))))


def resolve_sites(articles: DataFrame, sites: DataFrame) -> DataFrame:
    """Add the ``site_id`` of the page's host; pages of unknown or inactive sites drop out."""
    return with_url_domain(articles).join(site_lookup(sites), "domain").drop("domain")


def unresolved_sites(articles: DataFrame, sites: DataFrame) -> DataFrame:
    return with_url_domain(articles).join(site_lookup(sites), "domain", "left_anti")


def first_image(images: Column) -> Column:
    return F.try_element_at(images, F.lit(1))


def named_by(keys: DataFrame, batch: DataFrame, fold: bool = False) -> DataFrame:
    """The keys that a batch names by URL, with all their columns."""
    if not fold:
        return keys.join(batch.select("url"), "url", "left_semi")
    named = batch.select(key_of(F.col("url"), fold).alias("_key"))
    return keys.withColumn("_key", key_of(F.col("url"), fold)).join(named, "_key", "left_semi").drop("_key")


def stored_articles(state: DataFrame, batch: DataFrame, fold: bool = False) -> DataFrame:
    """Id and hash of the stored articles that a batch names by URL."""
    return named_by(state.select("article_id", "url", "content_hash"), batch, fold)


def content_hash(body: Column) -> Column:
    return F.md5(body.cast("binary"))


def storable(articles: DataFrame) -> DataFrame:
    """Article rows as stored: defaults for missing values, and the hash of the body.

    Needs ``url, site_id, ingest_seq, title, article_body, image_urls``.
    """
    return articles.select(
        "url",
        "site_id",
        "ingest_seq",
        F.coalesce(falsy_to_null(F.col("title")), F.lit(NO_TITLE)).alias("title"),
        F.coalesce("article_body", F.lit("")).alias("body"),
        F.coalesce(first_image(F.col("image_urls")), F.lit("")).alias("image_url"),
    ).withColumn("content_hash", content_hash(F.col("body")))


def article_batch(predictions: DataFrame, sites: DataFrame) -> DataFrame:
    return storable(resolve_sites(only_articles(predictions), sites))


def change_log(
    batch: DataFrame, state: DataFrame, run_rows: int = RUN_ROWS, ranged: Ranged | None = None, fold: bool = False
) -> DataFrame:
    """Status of every batch row against the row before it, or against the stored article.

    Only URL, sequence number and hash are shuffled, never a body. ``ranged`` is a table with ``ingest_seq`` that is
    cheaper to read than the batch, or the bounds of runs over it. With ``fold``, URLs that differ in case and accents
    only are one.
    """
    rows, known = batch.select("url", "site_id", "ingest_seq", "content_hash"), state.select("url", "content_hash")
    key = "url"
    if fold:
        key = "_key"
        rows, known = (df.withColumn(key, key_of(F.col("url"), fold)) for df in (rows, known))
    looked_back = previous_value(rows, key, "ingest_seq", "content_hash", known, run_rows, ranged)
    status = (
        F.when(F.col("previous").isNull(), "NEW")
        .when(~F.col("content_hash").eqNullSafe(F.col("previous.content_hash")), "UPDATED")
        .otherwise("UNCHANGED")
    )
    return conform(looked_back.withColumn("status", status), CHANGES)


def url_outcomes(changes: DataFrame, fold: bool = False) -> DataFrame:
    """Per URL: is it new, when did it come first, and which row holds its final content.

    With ``fold``, ``url`` is the spelling that came first.
    """
    seq = F.col("ingest_seq")
    changed = F.when(F.col("status") != "UNCHANGED", F.struct(seq, "content_hash"))
    keys = changes.withColumn("_key", key_of(F.col("url"), True)).groupBy("_key") if fold else changes.groupBy("url")
    spelling = [F.min(F.struct(seq, "url"))["url"].alias("url")] if fold else []
    return (
        keys.agg(
            F.min(seq).alias("first_seq"),
            F.max(changed).alias("_changed"),
            F.max(F.when(F.col("status") == "NEW", F.col("site_id"))).alias("new_site_id"),
            F.bool_or(F.col("status") == "NEW").alias("is_new"),
            *spelling,
        )
        .withColumn("changed_seq", F.col("_changed.ingest_seq"))
        .withColumn("changed_hash", F.col("_changed.content_hash"))
        .drop("_changed", "_key")
    )


def number_new(
    outcomes: DataFrame,
    last_id: Column,
    run_rows: int = RUN_ROWS,
    ranged: Ranged | None = None,
) -> DataFrame:
    """Give new URLs the ids after ``last_id`` in order of their first appearance.

    ``ranged`` is a table with ``ingest_seq`` that is cheaper to read than the outcomes, or the bounds of runs over it.
    """
    bounds = ranged.select(F.col("ingest_seq").alias("first_seq")) if isinstance(ranged, DataFrame) else ranged
    return number_rows(outcomes, "first_seq", last_id, "new_id", run_rows, F.col("is_new"), bounds)


def changed_contents(outcomes: DataFrame, batch: DataFrame, fold: bool = False) -> DataFrame:
    """``url, title, body, image_url`` of the row that holds each new or changed URL's content.

    (URL, sequence number) is unique but for rows that were delivered twice, so no key is hot;
    of those rows one is taken. With ``fold``, ``url`` is the folded URL.
    """
    key = key_of(F.col("url"), fold).alias("url")
    wanted = outcomes.where("changed_seq is not null").select(key, F.col("changed_seq").alias("ingest_seq"), F.col("changed_hash").alias("content_hash"))
    keys = ["url", "ingest_seq", "content_hash"]
    rows = batch.select(key, *keys[1:], F.struct("title", "body", "image_url").alias("content"))
    found = rows.join(wanted, keys, "left_semi").groupBy(*keys).agg(F.min("content").alias("content"))
    return found.select("url", "content.*")


def upsert_keys(
    keys: DataFrame, outcomes: DataFrame, run_ts: datetime.datetime, version: int, fold: bool = False
) -> DataFrame:
    """The keys after a batch; texts take no part.

    New URLs are inserted; changed ones take hash and content version of the batch; every URL seen
    gets a new ``last_cited_date``. ``site_id``, ``scraped_at`` and the spelling of the URL stay.
    """
    old, new = keys.alias("old"), outcomes.withColumn("_seen", F.lit(True)).alias("new")
    same = key_of(F.col("old.url"), fold) == key_of(F.col("new.url"), fold)
    exists = F.col("old.article_id").isNotNull()
    changed = F.col("new.changed_seq").isNotNull()
    now = F.lit(run_ts).cast("timestamp")
    return old.join(new, same, "full_outer").select(
        F.coalesce("old.article_id", "new.new_id").alias("article_id"),
        F.when(exists, F.col("old.site_id")).otherwise(F.col("new.new_site_id")).alias("site_id"),
        F.coalesce("old.url", "new.url").alias("url"),
        F.when(changed, F.col("new.changed_hash")).otherwise(F.col("old.content_hash")).alias("content_hash"),
        F.when(exists, F.col("old.scraped_at")).otherwise(now).alias("scraped_at"),
        F.when(F.col("new._seen"), now).otherwise(F.col("old.last_cited_date")).alias(
            "last_cited_date"
        ),
        F.when(changed, F.lit(version)).otherwise(F.col("old.content_version")).cast("bigint").alias("content_version"),
    )


def with_contents(keys: DataFrame, contents: DataFrame, fold: bool = False) -> DataFrame:
    """Articles from keys and the contents that they point at, which are keyed as ``changed_contents`` gives them."""
    if not fold:
        return conform(keys.join(contents, ["url", "content_version"]), ARTICLES)
    keyed = keys.withColumn("_key", key_of(F.col("url"), fold))
    return conform(keyed.join(contents.withColumnRenamed("url", "_key"), ["_key", "content_version"]), ARTICLES)


def upsert(
    state: DataFrame,
    batch: DataFrame,
    changes: DataFrame,
    run_ts: datetime.datetime,
    last_id: Column,
    run_rows: int = RUN_ROWS,
    fold: bool = False,
) -> DataFrame:
    """The article state after the batch, as one table.

    Keys and texts are merged apart: only texts of new and changed URLs move with the batch, and
    stored texts are joined once, to the keys that still point at them.
    """
    outcomes = number_new(url_outcomes(changes, fold), last_id, run_rows, batch)
    keys = upsert_keys(state.withColumn("content_version", F.lit(0)), outcomes, run_ts, 1, fold)
    texts = ["title", "body", "image_url"]
    old = state.select(key_of(F.col("url"), fold).alias("url"), *texts, F.lit(0).cast("bigint").alias("content_version"))
    new = changed_contents(outcomes, batch, fold).withColumn("content_version", F.lit(1).cast("bigint"))
    return with_contents(keys, old.unionByName(new), fold)


def last_article_id(state: DataFrame) -> Column:
    """The highest id in use, as a scalar subquery."""
    return state.agg(F.coalesce(F.max("article_id"), F.lit(0)).alias("last_id")).scalar()
