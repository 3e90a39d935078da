"""Compute costly columns once."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bind(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters and generators may name without running them again.

    Catalyst copies a filter below the projection it depends on, expression and all; a one-row
    generator keeps the value where it was computed.
    """
    named = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline_outer(F.array(named)))
