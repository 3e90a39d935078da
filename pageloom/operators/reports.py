"""Run reports. Counts are summed before any ratio is taken."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pageloom.fixed_values import STATUS_IMPACT, TOTAL
from pageloom.schemas import RUN_STATS, conform



def pages_per_site(sites: DataFrame, items: DataFrame) -> DataFrame:
    """Page count of every site; 0 for a site without pages."""
    counts = items.groupBy(F.col("site_domain").alias("domain")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return sites.select("domain").join(counts, "domain", "left").select(
        "domain", F.coalesce("n", F.lit(0)).alias("total_pages")
    )


def status_counts(changes: DataFrame) -> DataFrame:
    """Counts of each storage status per site; ``changes`` carries the site's ``domain``."""
    return changes.groupBy("domain").agg(
        *[
            F.count_if(F.col("status") == status).alias(f"{status.lower()}_count")
            for status in STATUS_IMPACT
        ]
    )


def filtering_pct(pages: Column, articles: Column) -> Column:
    return F.when(pages > 0, (pages - articles) / pages * 100).otherwise(F.lit(0.0))


def run_stats(page_counts: DataFrame, statuses: DataFrame) -> DataFrame:
    """One row per site: pages, operations, noise share and whether the site was read."""
    joined = page_counts.join(statuses, "domain", "left")
    counts = [f"{status.lower()}_count" for status in STATUS_IMPACT]
    filled = joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})
    stats = filled.withColumn("predicted_articles", sum(F.col(c) for c in counts))
    return conform(
        stats.withColumns(
            {
                "filtering_pct": filtering_pct(F.col("total_pages"), F.col("predicted_articles")),
                "status": F.when(F.col("total_pages") > 0, "SUCCESS").otherwise("FAILED"),
            }
        ),
        RUN_STATS,
    )


def run_summary(stats: DataFrame) -> DataFrame:
    """The per-site rows and a total row, whose percentage comes from the summed counts."""
    sums = stats.rollup("domain").agg(
        F.sum("total_pages").alias("total_pages"),
        F.sum("predicted_articles").alias("predicted_articles"),
        F.grouping("domain").cast("boolean").alias("is_total"),
    )
    return sums.select(
        F.when(F.col("is_total"), TOTAL).otherwise(F.col("domain")).alias("domain"),
        F.coalesce("total_pages", F.lit(0)).alias("total_pages"),
        F.coalesce("predicted_articles", F.lit(0)).alias("predicted_articles"),
        filtering_pct(F.col("total_pages"), F.col("predicted_articles")).alias("filtering_pct"),
        "is_total",
    )


def storage_efficiency(stats: DataFrame) -> DataFrame:
    """Share of each storage status in all operations; always three rows."""
    totals = stats.agg(
        *[
            F.coalesce(F.sum(f"{s.lower()}_count"), F.lit(0)).alias(s.lower())
            for s in STATUS_IMPACT
        ]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(s).alias("status"),
                F.col(s.lower()).alias("operations"),
                F.lit(impact).alias("impact"),
            )
            for s, impact in STATUS_IMPACT.items()
        ]
    )
    everything = F.sum("operations").over(W.partitionBy())
    return totals.select(F.inline(rows)).withColumn(
        "pct",
        F.when(everything > 0, F.col("operations") / everything * 100).otherwise(F.lit(0.0)),
    )
