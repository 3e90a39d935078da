"""Training of the page classifier from labelled items."""

import dataclasses

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from pageloom.operators import classify as C
from pageloom.sinks.models import save_model
from pageloom.sources.items import read_labelled


@dataclasses.dataclass(frozen=True)
class Training:
    model: PipelineModel
    report: DataFrame
    confusion: DataFrame


def train(labelled: DataFrame, settings: C.ForestSettings = C.ForestSettings()) -> Training:
    """Fit on three quarters of the URLs, evaluate on the rest."""
    rows = C.fill_missing_features(C.check_training_rows(labelled))
    train_rows, test_rows = C.split_rows(rows)
    model = C.fit_forest(train_rows, settings)
    scored = C.predict(model, test_rows.select("label", *C.FEATURES))
    counts = C.prediction_counts(scored).persist()  # one row per pair of classes; rows are scored once
    return Training(model, C.counted_report(counts), C.counted_matrix(counts))


def train_from_files(
    spark: SparkSession, path: str, model_path: str, settings: C.ForestSettings = C.ForestSettings()
) -> Training:
    """Read labelled item files, fit and evaluate, and save the model with its feature list."""
    labelled, _ = read_labelled(spark, path)
    result = train(labelled, settings)
    save_model(spark, result.model, model_path)
    return result
