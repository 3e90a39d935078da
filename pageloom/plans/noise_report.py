"""Noise share per site by the rule label: no model, no state."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.operators.reports import filtering_pct, run_summary


def rule_stats(items: DataFrame) -> DataFrame:
    """Pages and rule-labelled articles of each site."""
    counts = items.groupBy(F.col("site_domain").alias("domain")).agg(
        F.count(F.lit(1)).alias("total_pages"),
        F.count_if("is_article_in_category").alias("predicted_articles"),
    )
    return counts.withColumn(
        "filtering_pct", filtering_pct(F.col("total_pages"), F.col("predicted_articles"))
    )


def noise_summary(items: DataFrame) -> DataFrame:
    return run_summary(rule_stats(items))
