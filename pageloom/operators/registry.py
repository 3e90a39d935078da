"""Site registry operators."""

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.functions.urls import registry_domain
from pageloom.operators.numbering import number_rows


def with_defaults(sites: DataFrame) -> DataFrame:
    """A site without state is active and has priority 10."""
    return sites.withColumns(
        {
            "active": F.coalesce("active", F.lit(True)),
            "priority": F.coalesce("priority", F.lit(10)),
        }
    )


def active_sites(sites: DataFrame) -> DataFrame:
    """Active sites by falling priority."""
    return (
        sites.where(F.col("active"))
        .orderBy(F.desc("priority"), "domain")
        .select("site_id", "domain", "start_url")
    )


def insert_ignore(sites: DataFrame, seed: DataFrame) -> DataFrame:
    """Add seed rows of unknown domains; present rows and the first of equal seeds win.

    ``seed_seq`` is the order of the seed; new sites get the next ids in that order.
    """
    columns = [c for c in seed.columns if c not in ("domain", "seed_seq")]
    first = (
        seed.groupBy("domain")
        .agg(F.min(F.struct("seed_seq", *columns)).alias("first"))
        .select("domain", "first.*")
    )
    new = first.join(sites.select("domain"), "domain", "left_anti")
    last_id = sites.agg(F.coalesce(F.max("site_id"), F.lit(0)).alias("last_id")).scalar()
    numbered = number_rows(new, "seed_seq", last_id, "site_id", ranged=seed).drop("seed_seq")
    return sites.unionByName(with_defaults(numbered), allowMissingColumns=True)


def touch_visited(sites: DataFrame, visited: DataFrame, run_ts: datetime.datetime) -> DataFrame:
    """Set the visit time of the domains in ``visited``."""
    marks = visited.select("domain").distinct().withColumn("_hit", F.lit(True))
    return (
        sites.join(marks, "domain", "left")
        .withColumn(
            "last_visited",
            F.when(F.col("_hit"), F.lit(run_ts).cast("timestamp")).otherwise(
                F.col("last_visited")
            ),
        )
        .select(*sites.columns)
    )


def site_lookup(sites: DataFrame) -> DataFrame:
    """Active sites by normalised domain; the last one in priority order wins a shared name."""
    keyed = sites.where(F.col("active")).select(
        registry_domain(F.col("domain")).alias("domain"),
        "site_id",
        F.struct(-F.col("priority"), F.col("domain")).alias("_order"),
    )
    return keyed.groupBy("domain").agg(F.max_by("site_id", "_order").alias("site_id"))
