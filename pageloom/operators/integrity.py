"""Constraint checks before a write: accepted and rejected rows, each with its reason."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.functions.urls import key_of

# Fixed value: URLs are unique on this many leading characters.
URL_KEY_CHARS = 255


def url_key(url: str = "url", fold: bool = False):
    return F.substring(key_of(F.col(url), fold), 1, URL_KEY_CHARS)


def check_articles(batch: DataFrame, state: DataFrame, sites: DataFrame, fold: bool = False) -> DataFrame:
    """Add ``reject_reason``: no URL, unknown site, or a different URL with an equal key.

    The URL that came first holds the key, stored URLs before all others. A clash needs URLs of
    full key length, so only those are compared; the holder is a minimum, which combines on the
    map side and stands any number of URLs with one key. With ``fold``, keys and URLs are compared without case and accents.
    """
    known = sites.select("site_id").distinct().withColumn("_known", F.lit(True))
    checked = batch.join(known, "site_id", "left").withColumn(
        "reject_reason",
        F.when(F.col("url").isNull(), "missing_url").when(F.col("_known").isNull(), "unknown_site"),
    ).drop("_known")
    is_long = F.coalesce(F.length(key_of(F.col("url"), fold)) >= URL_KEY_CHARS, F.lit(False))
    long_rows = checked.where(is_long)
    claims = long_rows.where("reject_reason is null").select(
        url_key(fold=fold).alias("_key"), F.struct(F.col("ingest_seq").alias("seq"), "url").alias("claim")
    ).unionByName(
        state.where(is_long).select(
            url_key(fold=fold).alias("_key"),
            F.struct(F.lit(None).cast("bigint").alias("seq"), "url").alias("claim"),
        )
    )
    holders = claims.groupBy("_key").agg(F.min("claim").alias("holder"))
    compared = (
        long_rows.withColumn("_key", url_key(fold=fold))
        .join(holders, "_key", "left")
        .withColumn(
            "reject_reason",
            F.coalesce(
                "reject_reason",
                F.when(key_of(F.col("holder.url"), fold) != key_of(F.col("url"), fold), "duplicate_url_key"),
            ),
        )
        .select(*checked.columns)
    )
    return checked.where(~is_long).unionByName(compared)


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where("reject_reason is null").drop("reject_reason")


def rejected(checked: DataFrame) -> DataFrame:
    return checked.where("reject_reason is not null")


def check_registry(sites: DataFrame) -> DataFrame:
    """Add ``reject_reason`` to registry rows; the first id of a domain is kept."""
    first = sites.groupBy(F.col("domain").alias("_domain")).agg(F.min("site_id").alias("_first"))
    joined = sites.join(first, F.col("domain") == F.col("_domain"), "left")
    reason = F.when(F.col("domain").isNull(), "missing_domain").when(
        F.col("site_id") != F.col("_first"), "duplicate_domain"
    )
    return joined.select(*sites.columns, reason.alias("reject_reason"))
