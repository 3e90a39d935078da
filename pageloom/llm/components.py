"""Connected components of a set of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm.shared import shared_root


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for each node of ``links`` (``a, b``) that is not the smallest of its component.

    Each round connects the larger neighbours of a node, and then the smaller ones, to the smallest of them.
    Rounds end when nothing changes; their number grows with the logarithm of the longest path. Between rounds
    the links are checkpointed in the shared folder. Nothing but a count and a sum comes to the driver.
    """
    shared_root(links.sparkSession)
    pairs = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct().checkpoint()
    state = _state(pairs)
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        larger = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = larger.groupBy("u").agg(F.min("v").alias("m"))
        smaller = larger.join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = smaller.unionByName(smallest.withColumnRenamed("m", "v")).distinct().checkpoint()
        before, state = state, _state(pairs)
        if state == before:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _state(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
