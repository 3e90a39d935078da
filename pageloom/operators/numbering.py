"""Order-dependent values without one task per key: work in runs of the sequence number first.

Runs are cut at quantiles of the sequence numbers, so each holds about ``run_rows`` rows, and never twice as many,
whatever the numbers are: dense positions, hashes, snowflakes, or clusters far apart. That bounds the rows of any window
group, however hot its key is. The quantiles come from one sketch that combines on the map side; the driver holds one
number for each run. Both uses of a table's runs share these numbers, so they agree.
"""

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

RUN_ROWS = 1 << 20
#: A table with the sequence numbers, or the bounds of runs over them.
Ranged = DataFrame | list[float]
#: Quantiles that the first look takes; enough for half as many runs.
QUANTILES = 1024
#: Rank error of the sketch, as a part of the distance of two quantiles.
SHARPNESS = 16


def run_bounds(ranged: DataFrame, order: str, run_rows: int) -> list[float]:
    """Where runs begin, but for the first: quantiles of the column, in order.

    Numbers are compared as doubles. That keeps their order; numbers that are equal as doubles stay together.
    """
    seq = F.col(order).cast("double")

    def quantiles(parts: int) -> Column:
        at = F.array(*[F.lit(i / parts) for i in range(1, parts)])
        return F.percentile_approx(seq, at, F.lit(SHARPNESS * parts)).alias("found")

    known = ranged.agg(F.count(order).alias("n"), quantiles(QUANTILES)).first()
    runs, parts, found = -(-known["n"] // run_rows), QUANTILES, known["found"]
    if runs <= 1:
        return []
    if 2 * runs > QUANTILES:
        parts, found = runs, ranged.agg(quantiles(runs)).first()["found"]
    return sorted({found[i * parts // runs - 1] for i in range(1, runs)})


def with_run(df: DataFrame, order: str, run_rows: int, ranged: Ranged) -> DataFrame:
    """Add ``_run``, which never falls as ``order`` rises, nulls first; ``ranged`` gives the numbers' distribution."""
    bounds = run_bounds(ranged, order, run_rows) if isinstance(ranged, DataFrame) else ranged
    if not bounds:
        return df.withColumn("_run", F.lit(0))
    infinite = float("inf")
    numbered = df.withColumn("_seq", F.coalesce(F.col(order).cast("double"), F.lit(-infinite)))
    runs = Bucketizer(splits=[-infinite, *bounds, infinite], inputCol="_seq", outputCol="_bucket").transform(numbered)
    return runs.withColumn("_run", F.col("_bucket").cast("int")).drop("_seq", "_bucket")


def number_rows(
    df: DataFrame,
    order: str,
    start: Column,
    name: str,
    run_rows: int = RUN_ROWS,
    only: Column | None = None,
    ranged: Ranged | None = None,
) -> DataFrame:
    """Consecutive numbers after ``start`` in the order of a unique sequence column.

    Rows are numbered inside each run; the runs' counts, one row per run, give the offsets.
    With ``only``, rows that fail it stay without a number. ``ranged`` is a table with the same
    column that is cheaper to read than ``df``, or the bounds of runs over it.
    """
    counted = F.when(F.lit(True) if only is None else only, 1).otherwise(0)
    runs = with_run(df, order, run_rows, df if ranged is None else ranged)
    runs = runs.withColumn("_counted", counted)
    counts = runs.groupBy("_run").agg(F.sum("_counted").alias("_rows"))
    before = W.orderBy("_run").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        "_run", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    in_run = W.partitionBy("_run").orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    number = start + F.col("_offset") + F.col("_local")
    return (
        runs.withColumn("_local", F.sum("_counted").over(in_run))
        .join(offsets, "_run")
        .withColumn(name, F.when(F.col("_counted") == 1, number))
        .drop("_run", "_offset", "_local", "_counted")
    )


def previous_value(
    batch: DataFrame,
    key: str,
    order: str,
    value: str,
    initial: DataFrame,
    run_rows: int = RUN_ROWS,
    ranged: Ranged | None = None,
) -> DataFrame:
    """Add ``previous``, a struct with the preceding row's value for the same key.

    The first row of a key takes the value from ``initial`` (columns key and value); without
    such a row ``previous`` is null. Rows inside a run look back inside the run. Only the first
    and last row of a key in each run are shuffled again: they meet in a second window, together
    with the initial rows, so a hot key is never gathered in one task. ``ranged`` is as in ``number_rows``.
    """
    run = W.partitionBy(key, "_run").orderBy(order)
    inside = with_run(batch, order, run_rows, batch if ranged is None else ranged).withColumns(
        {
            "_inside": F.lag(F.struct(F.col(value))).over(run),
            "_last": F.lead(order).over(run).isNull(),
        }
    )
    is_edge = F.col("_inside").isNull() | F.col("_last")
    edges = inside.where(is_edge).withColumn("_given", F.lit(False))
    given = initial.select(key, value).withColumn("_given", F.lit(True))
    across = W.partitionBy(key).orderBy(F.desc("_given"), order)
    looked = (
        edges.unionByName(given, allowMissingColumns=True)
        .withColumn("_across", F.lag(F.struct(F.col(value))).over(across))
        .where(~F.col("_given"))
        .withColumn("previous", F.coalesce("_inside", "_across"))
    )
    columns = [*batch.columns, "previous"]
    return looked.select(*columns).unionByName(
        inside.where(~is_edge).withColumnRenamed("_inside", "previous").select(*columns)
    )
