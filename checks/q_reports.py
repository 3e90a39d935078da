"""Queries of the reports."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.base import fixture, query
from checks.q_state import src_sites
from pageloom.operators import reports
from pageloom.operators.reports import TOTAL
from pageloom.session import scratch_path
from pageloom.sinks.items import append_run

_SITES = "SELECT DISTINCT source || '.example.com' AS domain FROM documents"
_PAGES = f"""
    SELECT s.domain, count(i.url) AS total_pages
    FROM ({_SITES}) AS s LEFT JOIN fx_items AS i ON s.domain = i.site_domain GROUP BY s.domain
"""
_STATUS = """
    SELECT domain, count_if(status = 'NEW')::BIGINT AS new_count,
           count_if(status = 'UNCHANGED')::BIGINT AS unchanged_count,
           count_if(status = 'UPDATED')::BIGINT AS updated_count
    FROM fx_changes GROUP BY domain
"""
_STATS = f"""
    SELECT domain, total_pages, new_count, unchanged_count, updated_count, predicted_articles,
           CASE WHEN total_pages > 0
                THEN (total_pages - predicted_articles) / total_pages * 100 ELSE 0.0::DOUBLE END
               AS filtering_pct,
           CASE WHEN total_pages > 0 THEN 'SUCCESS' ELSE 'FAILED' END AS status
    FROM (SELECT p.domain, p.total_pages, coalesce(c.new_count, 0) AS new_count,
                 coalesce(c.unchanged_count, 0) AS unchanged_count,
                 coalesce(c.updated_count, 0) AS updated_count,
                 coalesce(c.new_count + c.unchanged_count + c.updated_count, 0)
                     AS predicted_articles
          FROM ({_PAGES}) AS p LEFT JOIN ({_STATUS}) AS c ON p.domain = c.domain) AS j
"""


def registry(spark: SparkSession, sf: str) -> DataFrame:
    return src_sites(spark, sf).withColumn(
        "domain", F.regexp_replace("domain", r"^www\.", "")
    )


def page_counts(spark: SparkSession, sf: str) -> DataFrame:
    return reports.pages_per_site(registry(spark, sf), fixture(spark, sf, "fx_items"))


def stats(spark: SparkSession, sf: str) -> DataFrame:
    statuses = reports.status_counts(fixture(spark, sf, "fx_changes"))
    return reports.run_stats(page_counts(spark, sf), statuses)


@query("r1_pages_per_site", _PAGES)
def r1(spark, sf):
    return page_counts(spark, sf)


@query("r2_status_counts", _STATUS)
def r2(spark, sf):
    return reports.status_counts(fixture(spark, sf, "fx_changes"))


@query("r3_noise_share", _STATS)
def r3(spark, sf):
    return stats(spark, sf)


@query(
    "r4_run_summary",
    f"""SELECT coalesce(domain, '{TOTAL}') AS domain, total_pages::BIGINT AS total_pages,
               predicted_articles::BIGINT AS predicted_articles,
               CASE WHEN total_pages > 0
                    THEN (total_pages - predicted_articles) / total_pages * 100
                    ELSE 0.0::DOUBLE END AS filtering_pct, is_total
        FROM (SELECT domain, sum(total_pages) AS total_pages,
                     sum(predicted_articles) AS predicted_articles, grouping(domain) = 1 AS is_total
              FROM ({_STATS}) AS s GROUP BY ROLLUP (domain)) AS t""",
)
def r4(spark, sf):
    return reports.run_summary(stats(spark, sf))


@query(
    "r5_storage_efficiency",
    f"""WITH ops AS (
            SELECT status, count(*) AS n FROM fx_changes GROUP BY status),
        spine AS (
            SELECT 'NEW' AS status, 'Dataset Expansion.' AS impact UNION ALL
            SELECT 'UNCHANGED', 'Storage & I/O Optimization.' UNION ALL
            SELECT 'UPDATED', 'Content Freshness Maintenance.')
        SELECT s.status, coalesce(n, 0)::BIGINT AS operations, s.impact,
               coalesce(n, 0) / (SELECT sum(n) FROM ops) * 100 AS pct
        FROM spine AS s LEFT JOIN ops AS o ON s.status = o.status""",
)
def r5(spark, sf):
    return reports.storage_efficiency(stats(spark, sf))


@query("k7_persist_run", f"SELECT 'run-2' AS run_id, * FROM ({_STATS}) AS s UNION ALL SELECT 'run-1', * FROM ({_STATS}) AS s WHERE total_pages > 0")
def k7(spark, sf):
    """Two runs kept side by side; the second is written twice and stays single."""
    path = scratch_path(spark, "run-stats")
    rows = stats(spark, sf)
    append_run(rows.where("total_pages > 0"), path, "run-1")
    append_run(rows.where("status = 'FAILED'"), path, "run-2")
    append_run(rows, path, "run-2")
    return spark.read.parquet(path)
