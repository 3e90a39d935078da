"""Small helpers shared by the tests."""


def values(df, *columns):
    """Rows as sorted tuples."""
    names = columns or df.columns
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)


def evaluate(spark, rows, schema, column):
    """Values of a column expression over inline rows, in row order."""
    keyed = [(i, *row) for i, row in enumerate(rows)]
    df = spark.createDataFrame(keyed, f"i int, {schema}").select("i", column.alias("out"))
    return [r["out"] for r in sorted(df.collect(), key=lambda r: r["i"])]
