"""Readers of the site registry."""

from pyspark.sql import DataFrame, SparkSession

from pageloom.fixed_values import SEED_SITES
from pageloom.operators.registry import with_defaults
from pageloom.schemas import SITES


def read_sites(spark: SparkSession, path: str) -> DataFrame:
    return with_defaults(spark.read.schema(SITES).parquet(path))


def seed_rows(spark: SparkSession) -> DataFrame:
    """The initial registry in its order, as input of ``insert_ignore``."""
    rows = [(seq, *site) for seq, site in enumerate(SEED_SITES)]
    return spark.createDataFrame(
        rows, "seed_seq bigint, domain string, start_url string, active boolean, priority int"
    )
