"""A full run: registry, frontier, extraction, prediction, storage, reports."""

import dataclasses
import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from pageloom.operators import registry, reports
from pageloom.plans.page_flow import parse_for_run, run_items, run_links
from pageloom.plans.scoring import Labeller, store_articles
from pageloom.sinks import items as item_sinks
from pageloom.sinks.article_store import ArticleStore
from pageloom.sinks.registry import write_sites
from pageloom.sinks.visited import VisitedSet
from pageloom.sources.keywords import KeywordLists
from pageloom.sources.registry import read_sites


@dataclasses.dataclass(frozen=True)
class RunResult:
    sites: DataFrame
    frontier: DataFrame
    items: DataFrame
    changes: DataFrame
    stats: DataFrame
    summary: DataFrame
    efficiency: DataFrame


def run(
    spark: SparkSession,
    pages: DataFrame,
    sites: DataFrame,
    keywords: KeywordLists,
    rules: DataFrame | None,
    labeller: Labeller,
    store: ArticleStore,
    out: str,
    run_id: str,
    run_ts: datetime.datetime,
    visited: VisitedSet | None = None,
) -> RunResult:
    """Run all active sites at once; pages are split by rows, not by site.

    Each page's html is read once: hrefs and texts are written, and frontier and items are made from
    them. The frontier is written too, and predictions before they are stored. The registry with the
    new visit times is written below ``out``. With ``visited``, URLs of earlier runs are left out of the frontier, and
    its URLs are added.
    """
    active = sites.where(F.col("active"))

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{out}/{name}")
        return spark.read.schema(df.schema).parquet(f"{out}/{name}")

    parsed = written(parse_for_run(pages, rules is not None), "parsed")
    links = written(run_links(parsed, active, keywords, visited and visited.unseen), "frontier")
    if visited:
        visited.add(run_id, links)
    items = run_items(parsed, active, rules, links)
    predicted = labeller(items.withColumn("ingest_seq", F.col("page_id")))
    path = f"{out}/predictions"
    item_sinks.write_predictions(predicted, path, "parquet")
    stored = spark.read.schema(predicted.schema).parquet(path)
    changes = store_articles(store, stored, active, run_ts, run_id, stage=False)

    write_sites(registry.touch_visited(sites, active, run_ts), f"{out}/sites")

    domains = active.select("site_id", "domain")
    statuses = reports.status_counts(changes.join(domains, "site_id"))
    stats = reports.run_stats(reports.pages_per_site(active, stored), statuses)
    item_sinks.append_run(stats, f"{out}/run_stats", run_id)
    known = StructType([*stats.schema.fields, StructField("run_id", StringType())])
    reports_read = spark.read.schema(known).parquet(f"{out}/run_stats")
    stats = reports_read.where(F.col("run_id") == run_id).drop("run_id")
    return RunResult(
        sites=read_sites(spark, f"{out}/sites"),
        frontier=links,
        items=stored,
        changes=changes,
        stats=stats,
        summary=reports.run_summary(stats),
        efficiency=reports.storage_efficiency(stats),
    )
