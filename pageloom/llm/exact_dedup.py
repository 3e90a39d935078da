"""Op 6: exact deduplication by Grace hashing.

Texts are equal when they are identical after each run of ASCII white space became one space. Records are
partitioned by hash into buckets, and buckets that are too large for a table in memory are partitioned again by
another hash, until each fits. The sizes are measured on hashes and lengths first, so that every record moves
once, through Spark's shuffle files. A bucket is then read into an open-addressing table, which compares complete
texts. Before the shuffle each task puts equal texts of its input together, so a text that fills a third of the
table arrives as one record per task.

Null texts count as empty. Of equal texts the smallest id stays; null ids come after all others, and a group of
null ids only has a null ``keep_id``. Rows that repeat both id and text are one group member each, and are all
marked as kept if their id stays; ``drop_duplicates`` then keeps one of them. An empty table gives an empty result.
``mark_duplicates`` leaves other columns out; ``drop_duplicates`` passes them on as they are, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pageloom.llm.shared import stored, text_of, unused

#: Bytes of distinct texts that the table of a bucket may hold, and of those a task puts together before the shuffle.
TABLE_BYTES = 32 << 20
#: Bytes that a text costs besides its own: a row of the table, its numbers and its slot.
ROW_BYTES = 400
#: Buckets for each shuffle partition, so that partitions are even.
BUCKETS_PER_PARTITION = 8

_GROUPS = "sha binary, keep_id long, group_size long"


class OpenTable:
    """Distinct texts with their smallest id and count, in an open-addressing table with linear probing."""

    def __init__(self) -> None:
        self.slots = [-1] * 1024
        self.rows: list[list] = []  # hash, text, smallest id, count, bucket
        self.bytes = 0

    def add(self, key: int, text: bytes, doc_id: int | None, count: int, bucket: int) -> None:
        mask = len(self.slots) - 1
        at = (key ^ key >> 32) & mask
        while (i := self.slots[at]) >= 0:
            row = self.rows[i]
            if row[0] == key and row[1] == text:
                if row[2] is None or doc_id is not None and doc_id < row[2]:
                    row[2] = doc_id
                row[3] += count
                return
            at = (at + 1) & mask
        self.slots[at] = len(self.rows)
        self.rows.append([key, text, doc_id, count, bucket])
        self.bytes += len(text) + ROW_BYTES
        if 2 * len(self.rows) > len(self.slots):
            self._grow()

    def _grow(self) -> None:
        self.slots = [-1] * (4 * len(self.slots))
        mask = len(self.slots) - 1
        for i, row in enumerate(self.rows):
            at = (row[0] ^ row[0] >> 32) & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = i


def normalised(text_col: str) -> Column:
    return F.regexp_replace(text_of(text_col), r"[\x20\x09-\x0D]+", " ")


def bucket_of(keys: DataFrame, table_bytes: int = TABLE_BYTES) -> Column:
    """An expression over ``key`` that gives each record's bucket, such that each bucket fits a table.

    ``keys`` has ``key`` (hash of the text) and ``size`` (bytes). Only the buckets that are too large, and their
    number of parts, come to the driver. A bucket of a single text is not split further.
    """
    spark = keys.sparkSession
    texts = keys.groupBy("key").agg((F.max("size") + ROW_BYTES).alias("size"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = texts.agg(F.sum("size")).first()[0] or 0
    count = max(BUCKETS_PER_PARTITION * partitions, -(-2 * total // table_bytes))
    bucket, level = F.pmod("key", F.lit(count)), 0
    while True:
        sized = texts.groupBy(bucket.alias("bucket")).agg(F.sum("size").alias("size"), F.count("*").alias("n"))
        large = sized.where((F.col("size") > table_bytes) & (F.col("n") > 1)).collect()
        if not large:
            return bucket
        level += 1
        first, parts = {}, {}
        for row in large:
            first[row["bucket"]], parts[row["bucket"]] = count, -(-2 * row["size"] // table_bytes)
            count += parts[row["bucket"]]
        split = F.pmod(F.xxhash64("key", F.lit(level)), _of(parts, bucket)) + _of(first, bucket)
        bucket = F.when(bucket.isin(list(first)), split).otherwise(bucket)


def _of(values: dict[int, int], key: Column) -> Column:
    return F.create_map(*[F.lit(x).cast("long") for pair in values.items() for x in pair])[key]


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, sha, key, size`` of every row, as a stored table without texts."""
    text = normalised(text_col)
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    digest = rows.select("doc_id", F.unhex(F.sha2("text", 256)).alias("sha"), F.xxhash64("text").alias("key"), F.octet_length("text").alias("size"))
    return stored(digest, "dedup-keys")


def groups(df: DataFrame, keys: DataFrame, id_col: str = "doc_id", text_col: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """``sha, keep_id, group_size`` of each distinct text; ``sha`` is the SHA-256 of the normalised text."""

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = OpenTable()
        for batch in batches:
            for key, text, doc_id, bucket in zip(*(batch.column(c).to_pylist() for c in ("key", "text", "doc_id", "bucket"))):
                table.add(key, text, doc_id, 1, bucket)
                if table.bytes > table_bytes:
                    yield _records(table)
                    table = OpenTable()
        if table.rows:
            yield _records(table)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, current = OpenTable(), None
        for batch in batches:
            for key, text, doc_id, count, bucket in zip(*batch.to_pydict().values()):
                if bucket != current:
                    if table.rows:
                        yield _found(table)
                    table, current = OpenTable(), bucket
                table.add(key, text, doc_id, count, bucket)
        if table.rows:
            yield _found(table)

    text = F.encode(normalised(text_col), "UTF-8")
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(normalised(text_col)).alias("key"), text.alias("text"))
    rows = rows.withColumn("bucket", bucket_of(keys, table_bytes))
    records = rows.mapInArrow(put_together, "key long, text binary, doc_id long, count long, bucket long")
    return records.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(compare, _GROUPS)


def _records(table: OpenTable) -> pa.RecordBatch:
    columns = zip(*table.rows)
    kinds = pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds)], names=["key", "text", "doc_id", "count", "bucket"])


def _found(table: OpenTable) -> pa.RecordBatch:
    digests = [hashlib.sha256(row[1]).digest() for row in table.rows]
    keep, count = [row[2] for row in table.rows], [row[3] for row in table.rows]
    return pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(keep, pa.int64()), pa.array(count, pa.int64())], names=["sha", "keep_id", "group_size"])


def mark_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    keys = keyed(df, id_col, text_col)
    joined = keys.select("doc_id", "sha").join(groups(df, keys, id_col, text_col), "sha")
    return joined.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, one for each distinct text, with all their columns."""
    keys, row, repeat = keyed(df, id_col, text_col), unused(df, "_row"), unused(df, "_repeat")
    kept = groups(df, keys, id_col, text_col).select(F.struct(F.col("keep_id"), "sha").alias(row))
    named = df.withColumn(row, F.struct(F.col(id_col).cast("long").alias("keep_id"), F.unhex(F.sha2(normalised(text_col), 256)).alias("sha")))
    repeats = Window.partitionBy(row).orderBy(F.col(text_col).asc_nulls_last())
    left = named.join(kept, row, "left_semi").withColumn(repeat, F.row_number().over(repeats))
    return left.where(F.col(repeat) == 1).select(*[F.col(f"`{c}`") for c in df.columns])
