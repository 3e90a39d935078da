"""Readers of fetched pages, at rest or as they arrive."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.schemas import PAGES

#: Column with the time at which a streamed page arrived.
ARRIVED = "arrived_at"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGES).parquet(path)


def stream_pages(
    spark: SparkSession, folder: str, glob: str = "*.parquet", files_per_batch: int = 1000, arrivals: bool = False
) -> DataFrame:
    """Pages of new files; with ``arrivals`` also when their file came, as ``arrived_at``."""
    pages = (
        spark.readStream.schema(PAGES)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )
    if not arrivals:
        return pages
    return pages.select("*", F.col("_metadata.file_modification_time").alias(ARRIVED))
