"""The article state at rest: levels of narrow keys, contents that only grow, a log of commits."""

import dataclasses
import datetime
import json
import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from pageloom.functions.urls import key_of
from pageloom.operators.changes import (
    change_log,
    changed_contents,
    named_by,
    number_new,
    upsert_keys,
    url_outcomes,
    with_contents,
)
from pageloom.operators.integrity import accepted, check_articles, rejected, url_key
from pageloom.operators.numbering import RUN_ROWS, run_bounds
from pageloom.schemas import ARTICLES, CHANGES, conform

_COMMITS = (
    "version bigint, batch_id string, last_id bigint, bucket_count int, "
    "buckets array<struct<bucket int, version bigint>>, levels array<struct<version bigint, n bigint>>, "
    "fold boolean, block bigint"
)
#: Commits are kept in blocks of so many; only the newest block is read.
_BLOCK = 64
#: A level is merged into the next one written if it has at most so many times its rows.
_GROWTH = 2
KEYS = StructType(
    [
        *[f for f in ARTICLES.fields if f.name not in ("title", "body", "image_url")],
        StructField("content_version", LongType()),
    ]
)
_PLACED = StructType([*KEYS.fields, StructField("v", LongType()), StructField("url_bucket", IntegerType())])
CONTENTS = StructType([f for f in ARTICLES.fields if f.name in ("url", "title", "body", "image_url")])


@dataclasses.dataclass(frozen=True)
class Commit:
    """``buckets``: the newest version that wrote a bucket; ``levels``: versions that hold keys, with their rows."""

    version: int
    batch_id: str | None
    last_id: int
    bucket_count: int
    buckets: dict[int, int]
    levels: tuple[tuple[int, int], ...] = ()
    fold: bool = False


class ArticleStore:
    """Articles under ``path``: narrow keys by a hash of the URL key, and contents, which only grow.

    A batch writes the keys of the URLs that it names, as a new level, and the contents of new and changed articles; a
    small commit row then makes them current. The newest level that holds a URL counts. A level that is not much larger
    than what is written next is merged into it, so that levels grow geometrically: there are few of them, and a key is
    written again only a few times in all. Readers see the last commit, and nothing that is read is overwritten. The text
    of an article that did not change is neither read nor written.

    The number of buckets is fixed by the first commit, and so is ``fold``: whether URLs that differ in case and accents
    only name one article, which keeps the spelling that came first.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, fold: bool = False):
        self.spark = spark
        self.path = path.rstrip("/")
        # A new store starts with an empty commit; an existing log is left alone.
        self._commit(Commit(0, None, 0, buckets, {}, fold=fold), mode="ignore")
        first = self.current()
        self.buckets, self.fold = first.bucket_count, first.fold

    def _bucket(self) -> Column:
        # URLs with equal keys share a bucket, so key clashes show up inside one.
        return F.pmod(F.xxhash64(url_key(fold=self.fold)), F.lit(self.buckets)).cast("int")

    def _newest(self) -> DataFrame:
        """The commits of the newest block; older ones are listed, but not read."""
        commits = self.spark.read.schema(_COMMITS).json(f"{self.path}/commits")
        newest = max(int(re.search(r"/block=(\d+)/", name).group(1)) for name in commits.inputFiles())
        return commits.where(F.col("block") == newest)

    def _recent(self) -> tuple[Commit, set[str]]:
        """The last commit, and the batches of the newest block."""
        newest = self._newest().withColumn("whole", F.struct(*_columns(_COMMITS)))
        found = newest.agg(F.max_by("whole", "version").alias("last"), F.collect_set("batch_id").alias("batches")).first()
        last = found["last"]
        return Commit(
            last["version"],
            last["batch_id"],
            last["last_id"],
            last["bucket_count"],
            {b["bucket"]: b["version"] for b in last["buckets"]},
            tuple((x["version"], x["n"]) for x in last["levels"]),
            last["fold"],
        ), set(found["batches"])

    def current(self) -> Commit:
        return self._recent()[0]

    def has_batch(self, batch_id: str) -> bool:
        """Whether a batch was committed: its mark, or its commit if the mark was not written."""
        return batch_id in self._recent()[1] or self._is_marked(batch_id)

    def _is_marked(self, batch_id: str) -> bool:
        try:
            return not self.spark.read.text(f"{self._folder(batch_id)}/committed").isEmpty()
        except AnalysisException:
            return False

    def _folder(self, batch_id: str) -> str:
        return f"{self.path}/batches/id={batch_id}"

    def _rows(self, levels: list[int], buckets: list[int] | None = None) -> DataFrame:
        """All rows of some levels, with their version ``v``."""
        if not levels:
            return self.spark.createDataFrame([], _PLACED)
        paths = [f"{self.path}/keys/v={v}" for v in levels]
        rows = self.spark.read.schema(_PLACED).option("basePath", f"{self.path}/keys").parquet(*paths)
        return rows if buckets is None or len(buckets) == self.buckets else rows.where(F.col("url_bucket").isin(buckets))

    def _latest(self, rows: DataFrame, levels: int) -> DataFrame:
        """The newest row of each URL."""
        columns = [f.name for f in KEYS.fields]
        if levels < 2:
            return rows.select(*columns)
        whole = F.struct("v", *columns)
        return rows.groupBy(key_of(F.col("url"), self.fold).alias("_key")).agg(F.max(whole).alias("_row")).select(*[f"_row.{c}" for c in columns])

    def _keys(self, commit: Commit) -> DataFrame:
        levels = [v for v, _ in commit.levels]
        return self._latest(self._rows(levels), len(levels))

    def read(self) -> DataFrame:
        """All articles with their texts."""
        versioned = StructType([*CONTENTS.fields, StructField("content_version", LongType())])
        try:
            contents = self.spark.read.schema(versioned).parquet(f"{self.path}/contents")
        except AnalysisException:
            contents = self.spark.createDataFrame([], versioned)
        return with_contents(self._keys(self.current()), contents, self.fold)

    def _commit(self, commit: Commit, mode: str = "append") -> None:
        row = dataclasses.asdict(commit)
        row["buckets"] = [{"bucket": b, "version": v} for b, v in sorted(commit.buckets.items())]
        row["levels"] = [{"version": v, "n": n} for v, n in commit.levels]
        line = self.spark.range(1).select(
            F.lit(json.dumps(row)).alias("value"), F.lit(commit.version // _BLOCK).alias("block")
        )
        line.coalesce(1).write.mode(mode).partitionBy("block").text(f"{self.path}/commits")

    def _write_keys(self, keys: DataFrame, version: int) -> None:
        keys.withColumn("url_bucket", self._bucket()).hint(
            "rebalance", "url_bucket"
        ).write.mode("overwrite").partitionBy("url_bucket").parquet(f"{self.path}/keys/v={version}")

    def _write_contents(self, contents: DataFrame, version: int) -> None:
        path = f"{self.path}/contents/content_version={version}"
        conform(contents, CONTENTS).write.mode("overwrite").parquet(path)

    def _staged(self, df: DataFrame, path: str) -> DataFrame:
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def apply(
        self,
        batch: DataFrame,
        sites: DataFrame,
        run_ts: datetime.datetime,
        batch_id: str | None = None,
        stage: bool = True,
    ) -> DataFrame:
        """Store a batch of article rows; returns the change log of the accepted ones.

        A ``batch_id`` that was stored before is not applied again. The batch is staged as files,
        unless it is read from files anyway (``stage=False``), and known keys, log and outcomes are written
        before the merge: a lost executor costs no new extraction, and the log stays as the
        batch's record.
        """
        now, recent = self._recent()
        version = now.version + 1
        folder = self._folder(batch_id or str(version))
        if batch_id is not None and (batch_id in recent or self._is_marked(batch_id)):
            return self._changes(folder)

        rows = batch.withColumn("url_bucket", self._bucket())
        if stage:
            rows = self._staged(rows, f"{folder}/rows")
        touched = [r["url_bucket"] for r in rows.select("url_bucket").distinct().collect()]
        levels = [v for v, _ in now.levels]
        stored = self._rows(levels, touched)
        bounds = run_bounds(rows, "ingest_seq", RUN_ROWS)

        checked = check_articles(rows, stored, sites, self.fold)
        known = self._staged(self._latest(named_by(stored, rows, self.fold), len(levels)), f"{folder}/known")
        log = change_log(accepted(checked), known, ranged=bounds, fold=self.fold).unionByName(
            rejected(checked).select("url", "site_id", "ingest_seq", "reject_reason"),
            allowMissingColumns=True,
        )
        log.write.mode("overwrite").parquet(f"{folder}/log")
        changes = self._changes(folder)
        outcomes = number_new(url_outcomes(changes, self.fold), F.lit(now.last_id), ranged=bounds)
        outcomes = self._staged(outcomes, f"{folder}/outcomes")
        self._write_contents(changed_contents(outcomes, rows, self.fold), version)
        seen = named_by(known, outcomes, self.fold)
        self._commit(self._with_level(now, batch_id, upsert_keys(seen, outcomes, run_ts, version, self.fold), outcomes))
        if batch_id is not None:
            mark = self.spark.range(1).select(F.lit(str(version)).alias("value"))
            mark.coalesce(1).write.mode("overwrite").text(f"{folder}/committed")
        return changes

    def _with_level(self, now: Commit, batch_id: str | None, keys: DataFrame, outcomes: DataFrame) -> Commit:
        """Write the keys that a batch changed, with the levels that are merged into them; the commit that holds them."""
        version, levels, buckets = now.version + 1, list(now.levels), dict(now.buckets)
        n, new, written = outcomes.agg(F.count(F.lit(1)), F.count_if("is_new"), F.collect_set(self._bucket())).first()
        if n:
            merged = []
            while levels and levels[-1][1] <= _GROWTH * n:
                merged.append(levels[-1][0])
                n += levels.pop()[1]
            if merged:
                older = self._rows(merged).withColumn("_key", key_of(F.col("url"), self.fold))
                changed = outcomes.select(key_of(F.col("url"), self.fold).alias("_key"))
                kept = self._latest(older.join(changed, "_key", "left_anti"), len(merged))
                keys = keys.unionByName(kept)
            self._write_keys(keys, version)
            levels.append((version, self._rows([version]).count() if merged else n))
            buckets |= dict.fromkeys(written, version) | {b: version for b, v in buckets.items() if v in merged}
        return Commit(version, batch_id, now.last_id + new, self.buckets, buckets, tuple(levels), self.fold)

    def _log_of(self, folder: str) -> DataFrame:
        schema = StructType([*CHANGES.fields, StructField("reject_reason", StringType())])
        return self.spark.read.schema(schema).parquet(f"{folder}/log")

    def _changes(self, folder: str) -> DataFrame:
        return self._log_of(folder).where("reject_reason is null").drop("reject_reason")

    def rejects(self, batch_id: str) -> DataFrame:
        """Rows of a stored batch that broke a constraint, with the reason."""
        log = self._log_of(self._folder(batch_id))
        return log.where("reject_reason is not null").drop("content_hash", "status")

    def load(self, articles: DataFrame) -> None:
        """Fill an empty store from a table of articles, one for each URL key."""
        if self.current().version:
            raise ValueError(f"{self.path} holds articles already")
        self._write_contents(articles.withColumn("url", key_of(F.col("url"), self.fold)), 1)
        self._write_keys(conform(articles.withColumn("content_version", F.lit(1)), KEYS), 1)
        # Read back from the files' key columns; an Observation would tie the session to models.
        n, last_id, buckets = self._rows([1]).agg(F.count(F.lit(1)), F.coalesce(F.max("article_id"), F.lit(0)), F.collect_set("url_bucket")).first()
        levels = ((1, n),) if n else ()
        self._commit(Commit(1, None, last_id, self.buckets, dict.fromkeys(buckets, 1), levels, self.fold))


def _columns(ddl: str) -> list[str]:
    return [f.name for f in StructType.fromDDL(ddl).fields if f.name != "block"]
