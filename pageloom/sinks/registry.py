"""Writer of the site registry."""

from pyspark.sql import DataFrame

from pageloom.schemas import SITES, conform


def write_sites(sites: DataFrame, path: str) -> None:
    """Write the registry as a new table; it must not be the one that ``sites`` is read from."""
    conform(sites, SITES).write.mode("overwrite").parquet(path)
