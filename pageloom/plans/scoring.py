"""Scoring of page items and storage of the articles among them."""

import datetime
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.operators import classify
from pageloom.operators.changes import article_batch
from pageloom.operators.features import add_path_features
from pageloom.sinks.article_store import ArticleStore
from pageloom.sinks.items import write_predictions
from pageloom.sinks.models import load_model
from pageloom.sources.items import read_items

Labeller = Callable[[DataFrame], DataFrame]


def model_labeller(model: PipelineModel) -> Labeller:
    return lambda items: classify.predict(model, add_path_features(items))


def rule_labeller(items: DataFrame) -> DataFrame:
    """Labels by the rule feature, for runs without a trained model."""
    return add_path_features(items).withColumn(
        "predicted_label", F.when(F.col("is_article_in_category"), "article").otherwise("other")
    )


def store_articles(
    store: ArticleStore,
    predictions: DataFrame,
    sites: DataFrame,
    run_ts: datetime.datetime,
    batch_id: str | None = None,
    stage: bool = True,
) -> DataFrame:
    """Upsert the predicted articles; ``predictions`` carries ``ingest_seq``.

    Predictions that are read from files need no staging.
    """
    return store.apply(article_batch(predictions, sites), sites, run_ts, batch_id, stage)


def score_files(
    spark: SparkSession,
    items_path: str,
    model_path: str,
    out: str,
    store: ArticleStore,
    sites: DataFrame,
    run_ts: datetime.datetime,
    batch_id: str | None = None,
) -> DataFrame:
    """Read item files, label them by a saved model, write predictions by site, store the articles.

    Items carry ``ingest_seq``, or are numbered by the hash of URL and text. Returns the changes.
    """
    found = read_items(spark, items_path)
    if "ingest_seq" not in found.columns:
        found = found.withColumn("ingest_seq", F.xxhash64("url", "article_body"))
    predicted = model_labeller(load_model(spark, model_path))(found)
    write_predictions(predicted, out, "parquet")
    stored = spark.read.schema(predicted.schema).parquet(out)
    return store_articles(store, stored, sites, run_ts, batch_id, stage=False)
