"""URLs visited in earlier runs, with a bitmap that tells most new ones without a look at them."""

import dataclasses
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.functions.urls import key_of

#: Bits of one cell, the unit of Spark's bitmap functions.
CELL_BITS = 8 * 4096


@dataclasses.dataclass(frozen=True)
class Candidates:
    """Links told apart by the bitmap: certainly new ones, and possible hits, which must be compared."""

    new: DataFrame
    possible: DataFrame


class VisitedSet:
    """Visited URLs under ``path``, one folder for each run, and of each run the bits of their hashes.

    A URL sets one of ``cells`` times 32,768 bits. A link whose bit is not set is new; only others are compared with the
    URLs themselves, so a false hit costs work and never a link. Sixteen bits for each URL that is expected leave about one
    new link in seventeen to compare. A run written again replaces itself. Bits and URLs grow by what a run adds; cells are
    joined by number, and a cell is 4 KB whatever the number of URLs.

    Rows without a URL are not kept and never count as visited. With ``per_site``, a URL is visited per ``site_domain``;
    ``fold`` is as in ``first_visits``. Both and ``cells`` must stay the same for one path.
    """

    def __init__(self, spark: SparkSession, path: str, cells: int = 1024, per_site: bool = True, fold: bool = False):
        self.spark, self.path, self.cells, self.fold = spark, path.rstrip("/"), cells, fold
        self.site = ["site_domain"] if per_site else []

    def _keyed(self, links: DataFrame) -> DataFrame:
        """Links with their key, and the place of their bit; a site and a URL are hashed apart."""
        keyed = links.withColumn("_visit", key_of(F.col("full_url"), self.fold))
        bit = F.pmod(F.xxhash64(*self.site, "_visit"), F.lit(self.cells * CELL_BITS)) + 1
        return keyed.withColumns({"_cell": F.bitmap_bucket_number(bit), "_bit": F.bitmap_bit_position(bit)})

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException:  # no run yet
            return self.spark.createDataFrame([], schema)

    def urls(self) -> DataFrame:
        """Keys of all runs."""
        return self._read("urls", ", ".join([*[f"{c} string" for c in self.site], "_visit string", "_cell bigint"]))

    def bits(self) -> DataFrame:
        """The bitmap of all runs: ``_cell, _bits``."""
        return self._read("bits", "_cell bigint, _bits binary").groupBy("_cell").agg(F.bitmap_or_agg("_bits").alias("_bits"))

    def add(self, run_id: str, links: DataFrame) -> None:
        """Keep the URLs of a run. The bits are written last and made from the URLs as written."""
        keyed = self._keyed(links.where("full_url IS NOT NULL")).select(*self.site, "_visit", "_cell", "_bit").distinct()
        urls = f"{self.path}/urls/run={run_id}"
        keyed.write.mode("overwrite").parquet(urls)
        written = self.spark.read.schema(keyed.schema).parquet(urls)
        cells = written.groupBy("_cell").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
        cells.write.mode("overwrite").parquet(f"{self.path}/bits/run={run_id}")

    @staticmethod
    def _is_set(bits: Column, position: Column) -> Column:
        byte = F.conv(F.hex(F.substring(bits, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return F.coalesce(F.call_function("getbit", byte, (position % 8).cast("int")) == 1, F.lit(False))

    def told_apart(self, links: DataFrame) -> Candidates:
        """Links by their bit; one join by cell, in which a link meets one row at most."""
        seen = self._keyed(links).join(self.bits(), "_cell", "left")
        tested = seen.withColumn("_hit", self._is_set(F.col("_bits"), F.col("_bit"))).drop("_bits", "_bit")
        return Candidates(tested.where(~F.col("_hit")).drop("_hit"), tested.where("_hit").drop("_hit"))

    def unseen(self, links: DataFrame) -> DataFrame:
        """The links that no earlier run has visited.

        Visited URLs are first cut down to the keys of possible hits, which moves no URL where those are few; the
        anti join then meets only these.
        """
        found, keys = self.told_apart(links), [*self.site, "_visit"]
        columns = links.columns
        hits = self.urls().select(*keys).join(found.possible.select(*keys), keys, "left_semi").distinct()
        missed = found.possible.join(hits, keys, "left_anti")
        return reduce(DataFrame.unionByName, [df.select(*columns) for df in (found.new, missed)])
