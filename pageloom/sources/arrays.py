"""JSON arrays of objects, one per file, read by several tasks.

A file is cut at every closing brace, so that Spark splits it by byte ranges as it does with lines. Whether a brace closes
an object depends on all quotes and braces before it: a first pass gives, for each range, what it does to both, for both
cases of its beginning (inside a string or not); summed up over the ranges of a file, these tell how each range begins. A
second pass then finds the objects. Those that reach over ranges are put together from their parts.
"""

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import StringType, StructField, StructType

_ESCAPE = re.compile(r"\\.", re.DOTALL)
#: What may stand before the first object, between objects, after the last one, and in an array without any.
_FIRST, _BETWEEN, _LAST, _EMPTY = (re.compile(p) for p in (r"﻿?\s*\[\s*", r"\s*,\s*", r"\s*\]\s*", r"﻿?\s*\[\s*\]\s*"))
#: Characters of what spoils a file that are kept.
_SHOWN = 200


def _outside(piece: str, in_string: bool) -> tuple[str, bool]:
    """What of a piece is outside of strings, and whether it ends inside of one."""
    parts = _ESCAPE.sub("", piece).split('"')
    return "".join(parts[in_string::2]), in_string ^ (len(parts) % 2 == 0)


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each stretch of one range: whether it turns outside into inside, and its net depth for both beginnings."""
    names = ["file", "block", "turns", "depth_out", "depth_in"]
    for batch in batches:
        rows: list[list] = []
        for file, block, piece in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "value"))):
            if not rows or rows[-1][:2] != [file, block]:
                rows.append([file, block, False, 0, 0])
            now = rows[-1]
            for start in (False, True):
                outside, end = _outside(piece, start ^ now[2])
                now[3 + start] += outside.count("{") - (not end)
            now[2] ^= _outside(piece, False)[1]
        kinds = pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()
        columns = list(zip(*rows)) if rows else [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Objects and parts of objects of each range, what stands after the last object, and what spoils a file.

    Ranges come one after the other, each in its order.
    """
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("kind", pa.string()), ("begins", pa.bool_()), ("text", pa.string())])
    rows: list[tuple] = []
    now, in_string, depth, begins, parts, first = None, False, 0, False, [], False

    def ended() -> None:
        if parts:
            rows.append((*now, "part", begins, "".join(parts)))
            parts.clear()

    for batch in batches:
        for file, block, piece, starts_in, starts_at in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "value", "in_string", "depth"))):
            if now != (file, block):
                ended()
                now, in_string, depth, begins, first = (file, block), starts_in, starts_at, False, block == 0
            outside, end = _outside(piece, in_string)
            if depth <= 0 and not in_string:
                at = piece.find("{")
                gap = piece if at < 0 else piece[:at]
                if at < 0:
                    fits = (_EMPTY if first else _LAST).fullmatch(gap)
                    rows.append((*now, "end" if fits else "bad", False, gap[:_SHOWN]))
                    first, in_string = False, end
                    continue
                if not (_FIRST if first else _BETWEEN).fullmatch(gap):
                    rows.append((*now, "bad", False, piece[:_SHOWN]))
                piece, begins, depth = piece[at:], True, 0
            first = False
            parts.append(piece + "}")
            depth += outside.count("{") - (not end)
            in_string = end
            if depth <= 0 and not in_string:
                rows.append((*now, "object" if begins else "part", begins, "".join(parts)))
                parts.clear()
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 5, schema.types)], schema=schema)
        rows = []
    ended()
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def _starts(pieces: DataFrame) -> DataFrame:
    """How each range of a file begins: ``file, block, in_string, depth``. One row for each range."""
    parts = pieces.mapInArrow(_summary, "file string, block long, turns boolean, depth_out long, depth_in long")
    # A range may come in several batches: fold them in their order
    ordered = parts.withColumn("seq", F.monotonically_increasing_id())
    steps = ordered.groupBy("file", "block").agg(F.array_sort(F.collect_list(F.struct("seq", "turns", "depth_out", "depth_in"))).alias("steps"))

    def depth_from(start: bool):
        zero = F.struct(F.lit(start).alias("inside"), F.lit(0).cast("long").alias("depth"))
        step = lambda s, x: F.struct((s["inside"] != x["turns"]).alias("inside"), (s["depth"] + F.when(s["inside"], x["depth_in"]).otherwise(x["depth_out"])).alias("depth"))
        return F.aggregate("steps", zero, step)

    ranges = steps.select("file", "block", depth_from(False).alias("out"), depth_from(True).alias("in"))
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    turned = F.coalesce(F.sum(F.col("out.inside").cast("int")).over(before), F.lit(0)) % 2 == 1
    known = ranges.withColumn("in_string", turned)
    moved = F.when(F.col("in_string"), F.col("in.depth")).otherwise(F.col("out.depth"))
    return known.withColumn("moved", moved).select("file", "block", "in_string", F.coalesce(F.sum("moved").over(before), F.lit(0)).alias("depth"))


def array_objects(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """``file, kind, text``: objects of all files, what ends an array, and what spoils a file (``bad``)."""
    files = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).option("lineSep", "}")
    pieces = files.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    placed = pieces.withColumn("pos", F.monotonically_increasing_id()).join(_starts(pieces), ["file", "block"])
    ordered = placed.sortWithinPartitions("file", "block", "pos").select("file", "block", "value", "in_string", "depth")
    found = ordered.mapInArrow(_found, "file string, block long, kind string, begins boolean, text string")
    place = W.partitionBy("file").orderBy("block", "begins")
    parts = found.where("kind = 'part'").withColumn("object", F.sum(F.col("begins").cast("int")).over(place))
    part = F.struct("block", "begins", "text")
    whole = parts.groupBy("file", "object").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    joined = whole.select("file", F.lit("object").alias("kind"), F.array_join("parts.text", "").alias("text"))
    return found.where("kind <> 'part'").select("file", "kind", "text").unionByName(joined)


def read_arrays(spark: SparkSession, path: str, schema: StructType, glob: str = "*.json") -> tuple[DataFrame, DataFrame]:
    """Rows of all files that are an array of objects, and the others (``file, content``: what spoils it).

    A mistake spoils a file as a whole. Files without content give neither.
    """
    found = array_objects(spark, path, glob)
    line = StructType([*schema.fields, StructField("_corrupt_record", StringType())])
    is_object = F.col("kind") == "object"
    broken = (F.col("kind") == "bad") | (is_object & F.json_object_keys("text").isNull())
    ends = found.groupBy("file").agg(F.count_if(F.col("kind") == "end").alias("ends"), F.min(F.when(broken, F.substring("text", 1, _SHOWN))).alias("content"))
    bad = ends.where("ends <> 1 OR content IS NOT NULL").select("file", F.coalesce("content", F.lit("no end")).alias("content"))
    rows = found.where(is_object).join(bad.select("file"), "file", "left_anti").select(F.from_json("text", line).alias("item"))
    return rows.select("item.*").select(*schema.names), bad
