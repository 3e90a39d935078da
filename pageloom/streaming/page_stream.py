"""Pages as they arrive: extraction, prediction, raw output and upsert per micro-batch."""

import datetime
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pageloom.operators.extract import parse_pages
from pageloom.plans.page_flow import items_of
from pageloom.plans.scoring import Labeller, store_articles
from pageloom.sinks.article_store import ArticleStore
from pageloom.sinks.items import write_predictions
from pageloom.sources.pages import ARRIVED


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps with its checkpoint, however often it is started again."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]


def without_repeats(pages: DataFrame, within: str) -> DataFrame:
    """Pages with ``arrived_at``, without those whose id and content came before within some time, such as ``1 day``.

    State holds the key of each page for that time, and no text. Pages meet it by key, so their html moves once.
    """
    keyed = pages.withColumn("_content", F.md5(F.coalesce("html", F.lit("")).cast("binary")))
    known = keyed.withWatermark(ARRIVED, within).dropDuplicatesWithinWatermark(["page_id", "_content"])
    return known.drop("_content")


def start_page_stream(
    pages: DataFrame,
    sites: DataFrame,
    rules: DataFrame | None,
    labeller: Labeller,
    store: ArticleStore,
    raw_path: str,
    checkpoint: str,
    run_ts: datetime.datetime,
    links: DataFrame | None = None,
    repeats_within: str | None = None,
) -> StreamingQuery:
    """Process all pages that are there, then stop.

    ``links`` is the frontier that the pages were fetched from; each page takes flag and source of
    its link from it. Output is written by site below the batch's folder. A micro-batch replayed
    after a failure writes to the same folder and finds its batch in the store's log; the log names
    batches by the stream's id, so another stream into the same store is not taken for a replay.
    A micro-batch is read once: its parsed pages are written below the checkpoint, over those of the batch before. What is
    made from them runs in the session of ``sites``, adaptively, which the stream's own session does not do beside state.
    A batch without pages, such as one of repeats only, ends there.
    With ``repeats_within``, a page that is delivered again within that time is not parsed again; ``pages`` then come
    with their arrival times.
    """
    active, spark = sites.where(F.col("active")), sites.sparkSession

    def handle(batch: DataFrame, batch_id: int) -> None:
        stream = stream_id(spark, checkpoint)
        batch.write.mode("overwrite").parquet(f"{checkpoint}/parsed")
        parsed = spark.read.schema(batch.schema).parquet(f"{checkpoint}/parsed")
        if parsed.isEmpty():
            return
        items = items_of(parsed, rules, links, active)
        predicted = labeller(items.withColumn("ingest_seq", F.col("page_id")))
        folder = f"{raw_path}/stream={stream}/batch={batch_id}"
        write_predictions(predicted, folder, "parquet")
        stored = spark.read.schema(predicted.schema).parquet(folder)
        store_articles(store, stored, active, run_ts, f"{stream}-{batch_id}", stage=False)

    fresh = without_repeats(pages, repeats_within) if repeats_within else pages
    # The expressions of the parse are built here, once for all micro-batches: that takes seconds.
    return (
        parse_pages(fresh.drop(ARRIVED), rules is not None)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
