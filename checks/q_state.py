"""Queries of change detection, upsert and integrity."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import sqlgen as S
from checks.base import fixture, query
from checks.fixtures import RUN_TS
from pageloom.operators import changes as D
from pageloom.operators import integrity
from pageloom.session import scratch_path
from pageloom.sinks.article_store import ArticleStore

_TIME = "yyyy-MM-dd HH:mm:ss"


def run_ts(spark: SparkSession):
    return spark.sql(f"SELECT TIMESTAMP '{RUN_TS}' AS t").first()["t"]


def src_sites(spark: SparkSession, sf: str) -> DataFrame:
    return fixture(spark, sf, "fx_src_sites")


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """The batch as predictions: labels in several spellings, images as lists."""
    seq = F.col("ingest_seq")
    return fixture(spark, sf, "fx_batch").select(
        "url",
        "ingest_seq",
        "title",
        F.col("body").alias("article_body"),
        F.when(F.col("image").isNotNull(), F.array("image")).otherwise(
            F.array().cast("array<string>")
        ).alias("image_urls"),
        F.when(seq % 4 == 0, "Article")
        .when(seq % 4 == 1, "article")
        .when(seq % 4 == 2, "ARTICLE")
        .when(seq % 8 == 3, "other")
        .alias("predicted_label"),
    )


_PREDICTIONS = """
    SELECT *, CASE WHEN ingest_seq % 4 < 3 THEN 'article' WHEN ingest_seq % 8 = 3 THEN 'other' END
           AS predicted_label FROM fx_batch
"""
_LOOKUP = f"""
    SELECT {S.registry_domain('domain')} AS domain, site_id FROM fx_src_sites WHERE active
"""
_RESOLVED = f"""
    SELECT b.url, b.ingest_seq, b.title, b.body, b.image, s.site_id
    FROM (SELECT * FROM ({_PREDICTIONS}) AS p WHERE predicted_label = 'article') AS b
    JOIN ({_LOOKUP}) AS s ON {S.registry_domain(S.netloc('b.url'))} = s.domain
"""
_STORABLE = f"""
    SELECT url, site_id, ingest_seq, coalesce(nullif(title, ''), 'No Title') AS title,
           coalesce(body, '') AS body, coalesce(image, '') AS image_url,
           md5(coalesce(body, '')) AS content_hash
    FROM ({_RESOLVED}) AS r
"""


@query(
    "d2_article_filter",
    f"SELECT url, ingest_seq FROM ({_PREDICTIONS}) AS p WHERE predicted_label = 'article'",
)
def d2(spark, sf):
    return D.only_articles(predictions(spark, sf)).select("url", "ingest_seq")


@query("d3_resolve_site", f"SELECT url, ingest_seq, site_id FROM ({_RESOLVED}) AS r")
def d3(spark, sf):
    articles = D.only_articles(predictions(spark, sf))
    return D.resolve_sites(articles, src_sites(spark, sf)).select("url", "ingest_seq", "site_id")


@query(
    "d3_unresolved_rows",
    f"""SELECT url, ingest_seq FROM ({_PREDICTIONS}) AS p
        WHERE predicted_label = 'article' AND {S.registry_domain(S.netloc('url'))}
              NOT IN (SELECT domain FROM ({_LOOKUP}) AS k)""",
)
def d3_unresolved(spark, sf):
    articles = D.only_articles(predictions(spark, sf))
    return D.unresolved_sites(articles, src_sites(spark, sf)).select("url", "ingest_seq")


@query("d4_first_image", "SELECT url, ingest_seq, image FROM fx_batch")
def d4(spark, sf):
    return predictions(spark, sf).select(
        "url", "ingest_seq", D.first_image(F.col("image_urls")).alias("image")
    )


def batch(spark: SparkSession, sf: str) -> DataFrame:
    return D.article_batch(predictions(spark, sf), src_sites(spark, sf))


@query(
    "d5_row_defaults",
    f"SELECT url, ingest_seq, title, body, image_url FROM ({_STORABLE}) AS s",
)
def d5(spark, sf):
    return batch(spark, sf).select("url", "ingest_seq", "title", "body", "image_url")


@query("d6_content_hash", "SELECT doc_id, md5(text) AS content_hash FROM documents")
def d6(spark, sf):
    from checks.base import table

    return table(spark, sf, "documents").select(
        "doc_id", D.content_hash(F.col("text")).alias("content_hash")
    )


_PREVIOUS = f"""
    SELECT b.*, s.url IS NOT NULL AS stored, s.content_hash AS stored_hash,
           row_number() OVER w AS rn, lag(b.content_hash) OVER w AS lag_hash
    FROM ({_STORABLE}) AS b LEFT JOIN fx_state AS s ON b.url = s.url
    WINDOW w AS (PARTITION BY b.url ORDER BY b.ingest_seq)
"""
CHANGES = f"""
    SELECT *, CASE WHEN rn = 1 AND NOT stored THEN 'NEW'
                   WHEN content_hash IS DISTINCT FROM
                        (CASE WHEN rn = 1 THEN stored_hash ELSE lag_hash END) THEN 'UPDATED'
                   ELSE 'UNCHANGED' END AS status
    FROM ({_PREVIOUS}) AS p
"""


@query(
    "d7_change_status",
    f"SELECT url, ingest_seq, content_hash, status FROM ({CHANGES}) AS c WHERE rn = 1",
)
def d7(spark, sf):
    """Statuses of each URL's first row, which meets the stored state."""
    log = change_log(spark, sf)
    first = log.groupBy("url").agg(F.min("ingest_seq").alias("ingest_seq"))
    return log.join(first, ["url", "ingest_seq"]).select(
        "url", "ingest_seq", "content_hash", "status"
    )


def change_log(spark: SparkSession, sf: str) -> DataFrame:
    # Short runs, so that repeats of a URL fall into one run and into several.
    return D.change_log(batch(spark, sf), fixture(spark, sf, "fx_state"), run_rows=16)


@query(
    "d9_in_batch_repeats",
    f"SELECT url, site_id, ingest_seq, content_hash, status FROM ({CHANGES}) AS c",
)
def d9(spark, sf):
    return change_log(spark, sf)


UPSERTED = f"""
    WITH c AS ({CHANGES}),
    per_url AS (
        SELECT url, min(ingest_seq) AS first_seq, bool_or(status = 'NEW') AS is_new,
               max(ingest_seq) FILTER (WHERE status <> 'UNCHANGED') AS changed_seq
        FROM c GROUP BY url),
    ids AS (
        SELECT url, (SELECT max(article_id) FROM fx_state) + row_number() OVER (ORDER BY first_seq)
               AS new_id
        FROM per_url WHERE is_new)
    SELECT coalesce(s.article_id, i.new_id) AS article_id,
           coalesce(s.site_id, r.site_id) AS site_id, coalesce(s.url, p.url) AS url,
           coalesce(r.title, s.title) AS title, coalesce(r.body, s.body) AS body,
           coalesce(r.image_url, s.image_url) AS image_url,
           coalesce(r.content_hash, s.content_hash) AS content_hash,
           CASE WHEN s.url IS NULL THEN '{RUN_TS}' ELSE '2024-01-15 00:00:00' END AS scraped_at,
           CASE WHEN p.url IS NOT NULL THEN '{RUN_TS}' ELSE '2024-01-15 00:00:00' END
               AS last_cited_date
    FROM fx_state AS s
    FULL OUTER JOIN per_url AS p ON s.url = p.url
    LEFT JOIN c AS r ON r.url = p.url AND r.ingest_seq = p.changed_seq
    LEFT JOIN ids AS i ON i.url = p.url
"""
_FLAT_UPSERT = f"SELECT * FROM ({UPSERTED}) AS u"


def _show_times(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {c: F.date_format(c, _TIME) for c in ("scraped_at", "last_cited_date")}
    )


@query("d8_upsert", _FLAT_UPSERT)
def d8(spark, sf):
    state, rows = fixture(spark, sf, "fx_state"), batch(spark, sf)
    log = D.change_log(rows, state)
    return _show_times(
        D.upsert(state, rows, log, run_ts(spark), D.last_article_id(state), run_rows=64)
    )


_FOLD = "replace(lower(strip_accents({})), 'ς', 'σ')"
_FOLD_ROWS = f"""
    SELECT {_FOLD.format("url")} AS k, url, site_id, ingest_seq,
           coalesce(nullif(title, ''), 'No Title') AS title, coalesce(body, '') AS body,
           coalesce(image, '') AS image_url, md5(coalesce(body, '')) AS content_hash
    FROM fx_fold_batch WHERE site_id IN (SELECT site_id FROM fx_src_sites)
"""
_FOLDED = f"""
    WITH s AS (SELECT *, {_FOLD.format("url")} AS k FROM fx_fold_state),
    b AS (SELECT b.*, s.k IS NOT NULL AS stored, row_number() OVER w AS rn,
                 CASE WHEN row_number() OVER w = 1 THEN s.content_hash ELSE lag(b.content_hash) OVER w END AS before
          FROM ({_FOLD_ROWS}) AS b LEFT JOIN s ON b.k = s.k
          WINDOW w AS (PARTITION BY b.k ORDER BY b.ingest_seq)),
    c AS (SELECT *, CASE WHEN rn = 1 AND NOT stored THEN 'NEW' WHEN content_hash IS DISTINCT FROM before THEN 'UPDATED'
                         ELSE 'UNCHANGED' END AS status FROM b),
    per_key AS (
        SELECT k, min(ingest_seq) AS first_seq, arg_min(url, ingest_seq) AS first_url, bool_or(status = 'NEW') AS is_new,
               max(ingest_seq) FILTER (WHERE status <> 'UNCHANGED') AS changed_seq
        FROM c GROUP BY k),
    ids AS (
        SELECT k, (SELECT max(article_id) FROM fx_fold_state) + row_number() OVER (ORDER BY first_seq) AS new_id
        FROM per_key WHERE is_new)
    SELECT coalesce(s.article_id, i.new_id) AS article_id, coalesce(s.site_id, r.site_id) AS site_id,
           coalesce(s.url, p.first_url) AS url, coalesce(r.title, s.title) AS title, coalesce(r.body, s.body) AS body,
           coalesce(r.content_hash, s.content_hash) AS content_hash,
           CASE WHEN p.k IS NOT NULL THEN '{RUN_TS}' ELSE '2024-01-15 00:00:00' END AS last_cited_date
    FROM s FULL OUTER JOIN per_key AS p ON s.k = p.k
    LEFT JOIN c AS r ON r.k = p.k AND r.ingest_seq = p.changed_seq
    LEFT JOIN ids AS i ON i.k = p.k
"""


def _fold_rows(spark: SparkSession, sf: str) -> DataFrame:
    known = src_sites(spark, sf).select("site_id")
    rows = fixture(spark, sf, "fx_fold_batch").join(known, "site_id", "left_semi")
    images = F.when(F.col("image").isNotNull(), F.array("image"))
    return D.storable(rows.withColumnsRenamed({"body": "article_body"}).withColumn("image_urls", images))


def _without_scrape(df: DataFrame) -> DataFrame:
    return _show_times(df).drop("image_url", "scraped_at")


@query("d8_folded_upsert", f"SELECT * FROM ({_FOLDED}) AS u")
def d8_folded(spark, sf):
    """URLs that differ in case and accents only name one article, which keeps its first spelling."""
    state, rows = fixture(spark, sf, "fx_fold_state"), _fold_rows(spark, sf)
    log = D.change_log(rows, state, run_rows=64, fold=True)
    return _without_scrape(D.upsert(state, rows, log, run_ts(spark), D.last_article_id(state), run_rows=64, fold=True))


@query("k5_folded_store", f"SELECT * FROM ({_FOLDED}) AS u")
def k5_folded(spark, sf):
    """The same through a store whose keys are folded, in several batches: levels of different sizes."""
    store = ArticleStore(spark, scratch_path(spark, "articles"), buckets=8, fold=True)
    store.load(fixture(spark, sf, "fx_fold_state"))
    rows, known, ts = _fold_rows(spark, sf), src_sites(spark, sf), run_ts(spark)
    last = rows.agg(F.max("ingest_seq")).first()[0]
    for i, (low, high) in enumerate([(-1, 0.6), (0.6, 0.7), (0.7, 0.72), (0.72, 1)]):
        seq = F.col("ingest_seq") / last
        store.apply(rows.where((seq > low) & (seq <= high)), known, ts, f"part-{i}")
    return _without_scrape(store.read())


_CLASH = f"""
    WITH known AS (SELECT DISTINCT site_id FROM fx_src_sites),
    stored AS (SELECT url, NULL::BIGINT AS seq FROM fx_long WHERE ingest_seq % 5 = 0),
    claims AS (
        SELECT url, ingest_seq AS seq FROM fx_long
        WHERE site_id IN (SELECT site_id FROM known)
        UNION ALL SELECT url, seq FROM stored),
    holders AS (
        SELECT substr(url, 1, 255) AS k, url AS holder,
               row_number() OVER (PARTITION BY substr(url, 1, 255)
                                  ORDER BY seq NULLS FIRST, url) AS rn
        FROM claims)
    SELECT b.url, b.ingest_seq,
           CASE WHEN b.site_id NOT IN (SELECT site_id FROM known) THEN 'unknown_site'
                WHEN h.holder <> b.url THEN 'duplicate_url_key' ELSE '' END AS reject_reason
    FROM fx_long AS b
    LEFT JOIN holders AS h ON h.k = substr(b.url, 1, 255) AND h.rn = 1
"""


@query("d10_integrity", f"SELECT * FROM ({_CLASH}) AS x")
def d10(spark, sf):
    rows = fixture(spark, sf, "fx_long")
    state = rows.where("ingest_seq % 5 = 0").select("url")
    checked = integrity.check_articles(rows, state, src_sites(spark, sf))
    return checked.select(
        "url", "ingest_seq", F.coalesce("reject_reason", F.lit("")).alias("reject_reason")
    )


@query(
    "d10_registry_integrity",
    f"""SELECT page_id, CASE WHEN row_number() OVER (PARTITION BY domain ORDER BY page_id) > 1
                             THEN 'duplicate_domain' ELSE '' END AS reject_reason
        FROM (SELECT page_id, {S.frontier_host('url')} AS domain FROM pages) AS d""",
)
def d10_registry(spark, sf):
    from checks.base import table
    from pageloom.functions.urls import frontier_host

    rows = table(spark, sf, "pages").select(
        F.col("page_id").alias("site_id"), frontier_host(F.col("url")).alias("domain")
    )
    return integrity.check_registry(rows).select(
        F.col("site_id").alias("page_id"),
        F.coalesce("reject_reason", F.lit("")).alias("reject_reason"),
    )


@query(
    "d11_surrogate_keys",
    f"""SELECT url, (SELECT max(article_id) FROM fx_state) + row_number() OVER (ORDER BY ingest_seq)
               AS article_id
        FROM ({CHANGES}) AS c WHERE status = 'NEW'""",
)
def d11(spark, sf):
    last = D.last_article_id(fixture(spark, sf, "fx_state"))
    outcomes = D.url_outcomes(change_log(spark, sf))
    return (
        D.number_new(outcomes, last, run_rows=100)
        .where("is_new")
        .select("url", F.col("new_id").alias("article_id"))
    )


@query("k5_article_store", _FLAT_UPSERT)
def k5(spark, sf):
    """The same upsert through the stored state: load, apply, and apply once more."""
    store = ArticleStore(spark, scratch_path(spark, "articles"), buckets=8)
    store.load(fixture(spark, sf, "fx_state"))
    rows, known, ts = batch(spark, sf), src_sites(spark, sf), run_ts(spark)
    store.apply(rows, known, ts, "first")
    store.apply(rows, known, ts, "first")
    return _show_times(store.read())
