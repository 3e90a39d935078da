"""Readers of page-item files: JSON arrays, one per file, or JSON lines."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from pageloom.operators.binding import bind
from pageloom.schemas import LABELLED_ITEMS, PAGE_ITEMS


def _files(spark: SparkSession, glob: str):
    return spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True)


def read_items(
    spark: SparkSession,
    path: str,
    schema: StructType = PAGE_ITEMS,
    multi_line: bool = False,
    glob: str = "*.json",
) -> DataFrame:
    """Items of JSON lines, as our sinks write them, or with ``multi_line`` of one array per file."""
    return _files(spark, glob).schema(schema).option("multiLine", multi_line).json(path)


def read_labelled(
    spark: SparkSession,
    path: str,
    schema: StructType = LABELLED_ITEMS,
    glob: str = "*.json",
    multi_line: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Rows of all readable documents, and those that were left out (``file, content``).

    A document is a file with a JSON array, which a mistake spoils as a whole; without
    ``multi_line`` each line is a document of its own.
    """
    line = StructType([*schema.fields, StructField("_corrupt_record", StringType())])
    kind = ArrayType(schema) if multi_line else line
    texts = (
        _files(spark, glob)
        .text(path, wholetext=multi_line)
        .select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("content"))
    )
    read = bind(texts, items=F.from_json("content", kind))
    failed = F.col("items").isNull()
    if not multi_line:
        failed = failed | F.col("items._corrupt_record").isNotNull()
    rows = F.inline(F.col("items") if multi_line else F.array("items"))
    good = read.where(~failed).select(rows).select(*schema.names)
    return good, read.where(failed).select("file", "content")
