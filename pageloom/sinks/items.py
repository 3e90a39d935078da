"""Writers of page items, predictions and run reports."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _by_site(df: DataFrame) -> DataFrame:
    """Rows of a site together, large sites over several tasks, and few small files."""
    routed = df.where(F.col("site_domain").isNotNull())
    folder = F.replace("site_domain", F.lit("."), F.lit("_"))
    return routed.withColumn("site_folder", folder).hint("rebalance", "site_folder")


def _write_by_site(df: DataFrame, path: str, fmt: str, partial: bool) -> None:
    writer = _by_site(df).write.mode("overwrite").partitionBy("site_folder")
    if partial:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.format(fmt).save(path)


def write_items(items: DataFrame, path: str, fmt: str = "json", partial: bool = False) -> None:
    """Write page items by site; items without a site are skipped.

    The folder is emptied first; with ``partial`` only the folders of the sites written are.
    """
    _write_by_site(items, path, fmt, partial)


def write_predictions(
    predictions: DataFrame, path: str, fmt: str = "json", partial: bool = False
) -> None:
    """Write all columns with the predicted label, by site, in UTF-8."""
    _write_by_site(predictions, path, fmt, partial)


def append_run(report: DataFrame, path: str, run_id: str) -> None:
    """Keep a report under its run; writing the same run again replaces it."""
    report.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("run_id").parquet(path)
