"""Saving and loading of the classifier with its feature list."""

import json

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from pageloom.fixed_values import FEATURES


def save_model(spark: SparkSession, model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(f"{path}/pipeline")
    spark.createDataFrame([(FEATURES,)], "features array<string>").coalesce(1).write.mode(
        "overwrite"
    ).json(f"{path}/features")


def load_model(spark: SparkSession, path: str) -> PipelineModel:
    """The saved model; its feature list must be the one this version computes."""
    stored = spark.read.schema("features array<string>").json(f"{path}/features").first()
    if stored is None or list(stored["features"]) != FEATURES:
        raise ValueError(f"model at {path} was fitted on other features: {json.dumps(stored)}")
    return PipelineModel.load(f"{path}/pipeline")
