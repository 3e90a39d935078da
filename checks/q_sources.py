"""Queries of sources and sinks: written by Spark below the shared folder, then read back."""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from checks import sqlgen as S
from checks.base import fixture, query, sites, table
from checks.fixtures import (
    CATEGORY_WORDS,
    GENERAL_WORDS,
    IRRELEVANT_WORDS,
    RULE_PATTERNS,
    RUN_TS,
)
from checks.q_pages import ITEMS, RULE_LABEL, items
from pageloom.operators import registry
from pageloom.operators.changes import stored_articles
from pageloom.schemas import LABELLED_ITEMS, PAGE_ITEMS, SITES, conform
from pageloom.session import scratch_path
from pageloom.sinks import items as item_sinks
from pageloom.sinks.registry import write_sites
from pageloom.sources import arrays
from pageloom.sources import items as item_sources
from pageloom.sources.keywords import read_keywords_yaml
from pageloom.sources.registry import read_sites
from pageloom.sources.rules import read_rules

_TIME = "yyyy-MM-dd HH:mm:ss"


@query(
    "s1_scan_sites",
    """SELECT site_id, domain, start_url,
              CASE WHEN site_id % 3 = 0 THEN true ELSE active END AS active,
              CASE WHEN site_id % 4 = 0 THEN 10 ELSE priority END AS priority FROM fx_sites""",
)
def s1(spark, sf):
    sid = F.col("site_id")
    gaps = fixture(spark, sf, "fx_sites").withColumns(
        {
            "active": F.when(sid % 3 != 0, F.col("active")),
            "priority": F.when(sid % 4 != 0, F.col("priority")),
        }
    )
    path = scratch_path(spark, "sites")
    conform(gaps, SITES).write.parquet(path)
    return read_sites(spark, path).select("site_id", "domain", "start_url", "active", "priority")


@query(
    "s2_active_sites",
    """SELECT site_id, domain, start_url FROM fx_sites WHERE active
       ORDER BY priority DESC, domain""",
)
def s2(spark, sf):
    return registry.active_sites(fixture(spark, sf, "fx_sites"))


@query(
    "s3_seed_insert_ignore",
    f"""WITH seeds AS (
            SELECT {S.frontier_host('url')} AS domain, page_id, url,
                   row_number() OVER (PARTITION BY {S.frontier_host('url')} ORDER BY page_id) AS rn
            FROM pages),
        known AS (SELECT * FROM fx_sites WHERE site_id % 3 <> 0)
        SELECT site_id, domain, start_url, active, priority FROM known
        UNION ALL
        SELECT (SELECT max(site_id) FROM known) + row_number() OVER (ORDER BY page_id),
               domain, url, page_id % 2 = 0, 10
        FROM seeds WHERE rn = 1 AND domain NOT IN (SELECT domain FROM known)""",
)
def s3(spark, sf):
    from pageloom.functions.urls import frontier_host

    seeds = table(spark, sf, "pages").select(
        F.col("page_id").alias("seed_seq"),
        frontier_host(F.col("url")).alias("domain"),
        F.col("url").alias("start_url"),
        (F.col("page_id") % 2 == 0).alias("active"),
        F.lit(None).cast("int").alias("priority"),
    )
    known = sites(spark, sf).where("site_id % 3 <> 0")
    return registry.insert_ignore(known, seeds).drop("last_visited")


_WORDS = " UNION ALL ".join(
    [
        f"SELECT 'category' AS kind, {S.text(name)} AS category, {S.text(w.lower())} AS keyword"
        for name, ws in CATEGORY_WORDS.items()
        for w in ws
    ]
    + [f"SELECT 'general', '', {S.text(w)}" for w in GENERAL_WORDS]
    + [f"SELECT 'irrelevant', '', {S.text(w)}" for w in IRRELEVANT_WORDS]
)


@query(
    "s4_load_keywords",
    f"""SELECT k.kind, k.category, k.keyword, count(p.url) AS urls
        FROM ({_WORDS}) AS k LEFT JOIN fx_pages AS p ON contains(lower(p.url), k.keyword)
        GROUP BY ALL""",
)
def s4(spark, sf):
    """The loaded keywords, each with the number of page URLs that hold it."""
    config = {
        "categories": {name: {"keywords": ws} for name, ws in CATEGORY_WORDS.items()},
        "general_category_keywords": GENERAL_WORDS,
        "irrelevant_keywords": IRRELEVANT_WORDS,
    }
    path = scratch_path(spark, "keywords")
    # JSON is YAML as well.
    spark.createDataFrame([(json.dumps(config),)], "value string").coalesce(1).write.text(path)
    keywords = read_keywords_yaml(spark, path)
    distinct = sorted({r["keyword"] for r in keywords.select("keyword").collect()})
    url = F.lower("url")
    hits = (
        fixture(spark, sf, "fx_pages")
        .select(
            F.explode(
                F.filter(
                    F.array(*[F.lit(k) for k in distinct]), lambda k: F.contains(url, k)
                )
            ).alias("keyword")
        )
        .groupBy("keyword")
        .agg(F.count(F.lit(1)).alias("urls"))
    )
    return keywords.join(hits, "keyword", "left").select(
        "kind",
        F.coalesce("category", F.lit("")).alias("category"),
        "keyword",
        F.coalesce("urls", F.lit(0)).alias("urls"),
    )


@query(
    "s5_load_rules",
    f"""SELECT domain, {S.text(RULE_PATTERNS[0])} AS first_pattern,
               CASE WHEN site_id % 3 = 0 THEN 1 ELSE {len(RULE_PATTERNS)} END AS patterns
        FROM fx_sites WHERE site_id % 2 = 1""",
)
def s5(spark, sf):
    """Rule files derived from the hosts: with repeats, empty lists and missing domains."""
    hosts = fixture(spark, sf, "fx_sites")
    sid = F.col("site_id")
    texts = F.array(*[F.lit(p) for p in RULE_PATTERNS])
    early = hosts.where(sid % 2 == 1).select(
        "domain", F.array(F.lit("unused")).alias("patterns"), sid.alias("rule_seq")
    )
    late = hosts.select(
        F.when(sid % 4 != 2, F.col("domain")).alias("domain"),
        F.when(sid % 2 == 0, F.array().cast("array<string>"))
        .when(sid % 3 == 0, F.array(F.lit(RULE_PATTERNS[0]), F.lit(None).cast("string")))
        .otherwise(texts)
        .alias("patterns"),
        (sid + 1_000_000_000).alias("rule_seq"),
    )
    path = scratch_path(spark, "rules")
    early.unionByName(late).write.json(path)
    loaded = read_rules(spark, path, multi_line=False)
    return loaded.select(
        "domain",
        F.col("patterns")[0].alias("first_pattern"),
        F.size("patterns").alias("patterns"),
    )


_ARRAY_ROWS = 50


def write_json_arrays(df: DataFrame, path: str, seq: str, spoil_every: int = 0) -> None:
    """One file per run of rows, holding a JSON array; every n-th file is cut short."""
    chunk = F.floor(F.col(seq) / _ARRAY_ROWS).alias("chunk")
    rows = F.to_json(F.collect_list(F.struct(*[c for c in df.columns if c != seq])))
    arrays = df.groupBy(chunk).agg(rows.alias("value"))
    if spoil_every:
        cut = F.substring("value", F.lit(1), F.length("value") - 40)
        arrays = arrays.withColumn(
            "value",
            F.when(F.col("chunk") % spoil_every == spoil_every - 1, cut).otherwise(
                F.col("value")
            ),
        )
    arrays.repartition("chunk").write.partitionBy("chunk").option("lineSep", "\n").text(path)


@query(
    "s6_scan_items",
    f"""SELECT url, coalesce(title, '') AS title, length(article_body)::BIGINT AS text_length,
               {S.density('article_body')} AS text_density,
               {RULE_LABEL} AS is_article_in_category
        FROM ({ITEMS}) AS i""",
)
def s6(spark, sf):
    path = scratch_path(spark, "items")
    kept = [f.name for f in PAGE_ITEMS.fields]
    write_json_arrays(items(spark, sf).select("page_id", *kept), path, "page_id")
    return item_sources.read_items(spark, path, multi_line=True, glob="*.txt").select(
        "url",
        F.coalesce("title", F.lit("")).alias("title"),
        F.col("text_length").cast("bigint"),
        "text_density",
        "is_article_in_category",
    )


def labelled_corpus(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    path = scratch_path(spark, "labelled")
    rows = conform(fixture(spark, sf, "fx_labelled"), LABELLED_ITEMS).select(
        F.regexp_extract("url", "([0-9]+)$", 1).cast("bigint").alias("doc_id"), "*"
    )
    write_json_arrays(rows, path, "doc_id", spoil_every=3)
    return item_sources.read_labelled(spark, path, glob="*.txt")


_LABELLED = f"""
    SELECT url, coalesce(title, '') AS title, md5(article_body) AS body_md5, coalesce(label, '') AS label
    FROM fx_labelled WHERE (doc_id // {_ARRAY_ROWS}) % 3 <> 2
"""
_REJECTED = f"""
    SELECT count(DISTINCT doc_id // {_ARRAY_ROWS}) AS files FROM fx_labelled WHERE (doc_id // {_ARRAY_ROWS}) % 3 = 2
"""


@query(
    "s7_scan_labelled",
    _LABELLED,
)
def s7(spark, sf):
    good, _ = labelled_corpus(spark, sf)
    return good.select(
        "url",
        F.coalesce("title", F.lit("")).alias("title"),
        F.md5("article_body").alias("body_md5"),
        F.coalesce("label", F.lit("")).alias("label"),
    )


@query(
    "s7_rejected_files",
    _REJECTED,
)
def s7_rejected(spark, sf):
    _, bad = labelled_corpus(spark, sf)
    return bad.agg(F.count(F.lit(1)).alias("files"))


def split_corpus(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    path = scratch_path(spark, "labelled")
    rows = conform(fixture(spark, sf, "fx_labelled"), LABELLED_ITEMS).select(
        F.regexp_extract("url", "([0-9]+)$", 1).cast("bigint").alias("doc_id"), "*"
    )
    write_json_arrays(rows, path, "doc_id", spoil_every=3)
    return arrays.read_arrays(spark, path, LABELLED_ITEMS, glob="*.txt")


@query("s7_split_arrays", _LABELLED)
def s7_split(spark, sf):
    """The labelled rows by the reader that splits files into ranges."""
    good, _ = split_corpus(spark, sf)
    return good.select(
        "url",
        F.coalesce("title", F.lit("")).alias("title"),
        F.md5("article_body").alias("body_md5"),
        F.coalesce("label", F.lit("")).alias("label"),
    )


@query("s7_split_rejects", _REJECTED)
def s7_split_rejects(spark, sf):
    _, bad = split_corpus(spark, sf)
    return bad.agg(F.count(F.lit(1)).alias("files"))


@query(
    "s9_state_lookup",
    """SELECT article_id, url, content_hash FROM fx_state
       WHERE url IN (SELECT b.url FROM fx_batch AS b JOIN fx_src_sites AS s ON b.site_id = s.site_id WHERE s.active)""",
)
def s9(spark, sf):
    """Articles known for all batch rows of active sites; the state holds those of other sites as well."""
    active = fixture(spark, sf, "fx_src_sites").where("active").select("site_id")
    batch = fixture(spark, sf, "fx_batch").join(active, "site_id", "left_semi")
    return stored_articles(fixture(spark, sf, "fx_state"), batch)


# Pages without an owning site have no route; the folder name has no dots.
_ROUTE = "CASE WHEN page_id % 9 = 0 THEN NULL ELSE " + S.frontier_host("url") + " END"


def routed_items(spark: SparkSession, sf: str) -> DataFrame:
    from pageloom.functions.urls import frontier_host

    df = items(spark, sf)
    return df.withColumn(
        "site_domain", F.when(F.col("page_id") % 9 != 0, frontier_host(F.col("url")))
    )


@query(
    "k1_write_items",
    f"""SELECT route AS site_domain, url, title,
               length(article_body)::BIGINT AS text_length
        FROM (SELECT *, {_ROUTE} AS route FROM ({ITEMS}) AS i) AS r WHERE route IS NOT NULL""",
)
def k1(spark, sf):
    path = scratch_path(spark, "raw")
    item_sinks.write_items(routed_items(spark, sf), path)
    back = item_sources.read_items(spark, path)
    return back.select("site_domain", "url", "title", F.col("text_length").cast("bigint"))


@query(
    "k2_write_predictions",
    f"""SELECT route AS site_domain, url, title, md5(article_body) AS body_md5,
               CASE WHEN {RULE_LABEL} THEN 'article' ELSE 'Άλλο' END AS predicted_label
        FROM (SELECT *, {_ROUTE} AS route FROM ({ITEMS}) AS i) AS r WHERE route IS NOT NULL""",
)
def k2(spark, sf):
    path = scratch_path(spark, "predictions")
    label = F.when(F.col("is_article_in_category"), "article").otherwise("Άλλο")
    item_sinks.write_predictions(
        routed_items(spark, sf).withColumn("predicted_label", label), path
    )
    schema = StructType([*PAGE_ITEMS.fields, StructField("predicted_label", StringType())])
    back, _ = item_sources.read_labelled(spark, path, schema, multi_line=False)
    return back.select(
        "site_domain", "url", "title", F.md5("article_body").alias("body_md5"), "predicted_label"
    )


@query(
    "k3_overwrite_outputs",
    f"""SELECT url, 'second' AS title FROM fx_pages WHERE page_id % 9 <> 0 AND page_id % 2 = 0
        UNION ALL
        SELECT url, 'third' FROM fx_pages WHERE page_id % 9 <> 0 AND page_id % 2 = 0
        AND {S.frontier_host('url')} IN (SELECT domain FROM fx_sites WHERE site_id % 3 = 0)
        """.replace("UNION ALL", "AND " + S.frontier_host("url") + " NOT IN (SELECT domain FROM fx_sites WHERE site_id % 3 = 0) UNION ALL", 1),
)
def k3(spark, sf):
    """A full write, a second one that replaces it, and a partial one for a third of the sites."""
    from pageloom.functions.urls import frontier_host

    path = scratch_path(spark, "outputs")
    rows = fixture(spark, sf, "fx_pages").where("page_id % 9 <> 0").select(
        "page_id", "url", frontier_host(F.col("url")).alias("site_domain")
    )
    item_sinks.write_items(rows.withColumn("title", F.lit("first")), path, "parquet")
    even = rows.where("page_id % 2 = 0")
    item_sinks.write_items(even.withColumn("title", F.lit("second")), path, "parquet")
    thirds = sites(spark, sf).where("site_id % 3 = 0").select(F.col("domain").alias("site_domain"))
    item_sinks.write_items(
        even.join(thirds, "site_domain", "left_semi").withColumn("title", F.lit("third")),
        path,
        "parquet",
        partial=True,
    )
    return spark.read.parquet(path).select("url", "title")


@query(
    "k4_touch_visited",
    f"""SELECT domain, CASE WHEN active THEN '{RUN_TS}' ELSE '' END AS last_visited
        FROM fx_sites""",
)
def k4(spark, sf):
    known = sites(spark, sf)
    run_ts = spark.sql(f"SELECT TIMESTAMP '{RUN_TS}' AS t").first()["t"]
    path = scratch_path(spark, "visited")
    write_sites(registry.touch_visited(known, registry.active_sites(known), run_ts), path)
    return read_sites(spark, path).select(
        "domain", F.coalesce(F.date_format("last_visited", _TIME), F.lit("")).alias("last_visited")
    )
