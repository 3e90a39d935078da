"""Readers of the per-site cleanup rules."""

import warnings

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.fixed_values import SITE_RULES
from pageloom.operators.cleanup import PATTERN_FLAGS
from pageloom.schemas import RULES


def usable_rules(raw: DataFrame) -> DataFrame:
    """Rules with a domain and patterns; of repeated domains the last one stays.

    ``raw`` has ``rule_seq, domain, patterns``.
    """
    kept = raw.where((F.col("domain") != "") & (F.size("patterns") > 0))
    strings = kept.withColumn("patterns", F.filter("patterns", lambda p: p.isNotNull()))
    return strings.groupBy("domain").agg(F.max_by("patterns", "rule_seq").alias("patterns"))


def checked_rules(rules: DataFrame) -> DataFrame:
    """The rules, or no rules at all when a pattern is invalid for the JVM, which applies them.

    One aggregate over all patterns decides; none of them comes to the driver.
    """
    pattern = F.concat(F.lit(PATTERN_FLAGS), F.col("p"))
    tried = rules.select(F.explode("patterns").alias("p")).select(F.regexp_count(F.lit("x"), pattern).alias("n"))
    try:
        tried.agg(F.sum("n")).collect()
        return rules
    except PySparkException as error:
        warnings.warn(f"cleanup rules ignored: {error}")
        return rules.limit(0)


def string_elements(json: Column) -> Column:
    """Strings of a JSON array in order, null in place of anything else; null if it is no array."""
    values = F.from_json(json, "array<variant>")
    return F.transform(
        values, lambda v: F.when(F.schema_of_variant(v) == "STRING", v.cast("string"))
    )


def read_rules(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Rules of a JSON array (or of JSON lines); a malformed array gives no rules.

    Only strings are patterns.
    """
    raw = (
        spark.read.schema("domain string, patterns string, rule_seq bigint")
        .option("multiLine", multi_line)
        .json(path)
        .withColumn("patterns", string_elements(F.col("patterns")))
    )
    # Rows of one array come from one task, so the generated ids follow their order.
    placed = raw.withColumn("rule_seq", F.coalesce("rule_seq", F.monotonically_increasing_id()))
    return checked_rules(usable_rules(placed))


def default_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(r["domain"], r["patterns"]) for r in SITE_RULES], RULES)
