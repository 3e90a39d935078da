"""Queries of the link frontier."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import sqlgen as S
from checks.base import fixture, query, sites, table
from checks.fixtures import CATEGORY_WORDS, GENERAL_WORDS, IRRELEVANT_WORDS
from checks.q_pages import pages
from pageloom.operators import frontier as L
from pageloom.session import scratch_path
from pageloom.sinks.visited import VisitedSet
from pageloom.sources.keywords import keyword_lists, keyword_table

CATEGORY = [w.lower() for ws in CATEGORY_WORDS.values() for w in ws] + GENERAL_WORDS


def lists(spark: SparkSession):
    return keyword_lists(keyword_table(spark, CATEGORY_WORDS, GENERAL_WORDS, IRRELEVANT_WORDS))


_HREF = S.extract("tag", r"""(?is)\shref=("[^"]*"|'[^']*')""", 1)
PIECES = f"""
    SELECT page_id, url, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS piece_pos
    FROM (SELECT page_id, url, regexp_extract_all({S.visible('html')},
              '(?is)<article[^>]*>.*?</article\\s*>|<a\\s[^>]*>') AS pieces FROM fx_pages) AS p
"""
TAGS = f"""
    SELECT page_id, url, piece_pos, lower(piece) LIKE '<article%' AS inside,
           unnest(tags) AS tag, generate_subscripts(tags, 1) AS tag_pos
    FROM (SELECT *, regexp_extract_all(piece, '(?is)<a\\s[^>]*>') AS tags
          FROM ({PIECES}) AS p1) AS p2
"""
RAW = f"""
    SELECT page_id, url, inside, piece_pos, tag_pos, {_HREF} AS raw FROM ({TAGS}) AS t
"""
MARKED = f"""
    SELECT *, raw <> '' AND (inside OR raw LIKE '%/article%' OR raw LIKE '%/story%'
                             OR raw LIKE '%/news%') AS targeted
    FROM ({RAW}) AS r
"""
CHOSEN = f"""
    SELECT page_id, url, replace(substr(raw, 2, length(raw) - 2), '&amp;', '&') AS href,
           row_number() OVER (PARTITION BY page_id ORDER BY piece_pos, tag_pos) AS pos
    FROM (SELECT *, bool_or(targeted) OVER (PARTITION BY page_id) AS any_targeted
          FROM ({MARKED}) AS m) AS c
    WHERE targeted OR NOT any_targeted
"""
VALID = f"""
    SELECT page_id, url, href, pos FROM ({CHOSEN}) AS c
    WHERE href <> '' AND NOT regexp_matches(href, '^(javascript|mailto|#)')
"""
DISTINCT = f"""
    SELECT page_id, url, href,
           row_number() OVER (PARTITION BY page_id ORDER BY min(pos)) - 1 AS link_pos
    FROM ({VALID}) AS v GROUP BY page_id, url, href
"""
# Base of a join: the page URL without query and fragment.
_BASE = "split_part(split_part(url, '#', 1), '?', 1)"
RESOLVED = f"""
    SELECT page_id, url, href, link_pos, {S.canonical(S.join_url(_BASE, 'href'))} AS full_url
    FROM ({DISTINCT}) AS d
"""
ON_SITE = f"""
    SELECT r.*, s.domain AS site_domain
    FROM ({RESOLVED}) AS r JOIN fx_sites AS s ON {S.frontier_host('r.url')} = s.domain
    WHERE {S.frontier_host('r.full_url')} = s.domain
"""
RELEVANT = f"""
    SELECT * FROM ({ON_SITE}) AS o
    WHERE NOT {S.contains_any('lower(full_url)', IRRELEVANT_WORDS)}
"""
FRONTIER = f"""
    SELECT page_id AS src_page_id, url AS src_url, link_pos, href, full_url, site_domain,
           1 AS depth, {S.contains_any('lower(full_url)', CATEGORY)} AS is_category_link,
           href AS source_xpath
    FROM (SELECT *, row_number() OVER (PARTITION BY site_domain, full_url
                                       ORDER BY page_id, link_pos) AS rn
          FROM ({RELEVANT}) AS k) AS f
    WHERE rn = 1
"""


@query(
    "l1_seed_selection",
    """SELECT domain, 'all' AS choice FROM fx_sites
       UNION ALL
       SELECT s.domain, 'one' AS choice FROM fx_sites AS s
       WHERE s.start_url = (SELECT min(start_url) FROM fx_sites)""",
)
def l1(spark, sf):
    known = sites(spark, sf)
    wanted = known.agg(F.min("start_url")).first()[0]
    everything = L.seed_sites(known).select("domain", F.lit("all").alias("choice"))
    one = L.seed_sites(known, f" {wanted}\n").select("domain", F.lit("one").alias("choice"))
    return everything.unionByName(one)


@query(
    "l2_allowed_hosts",
    """SELECT domain AS host FROM fx_sites UNION ALL SELECT 'www.' || domain FROM fx_sites""",
)
def l2(spark, sf):
    return L.allowed_hosts(fixture(spark, sf, "fx_sites"))


@query(
    "l3_depth_guard",
    "SELECT page_id FROM pages WHERE page_id % 4 = 0 OR page_id % 4 = 3",
)
def l3(spark, sf):
    pid = F.col("page_id")
    leveled = table(spark, sf, "pages").select("page_id", "url").withColumn(
        "depth", F.when(pid % 4 != 3, pid % 4)
    )
    return L.link_source_pages(leveled).select("page_id")


@query(
    "l4_extract_links",
    f"SELECT page_id, href, pos - 1 AS pos FROM ({CHOSEN}) AS c",
)
def l4(spark, sf):
    return L.extract_hrefs(pages(spark, sf)).select(
        F.col("src_page_id").alias("page_id"), F.posexplode("hrefs").alias("pos", "href")
    ).withColumn("pos", F.col("pos").cast("bigint"))


@query("l5_valid_hrefs", f"SELECT page_id, href FROM ({VALID}) AS v")
def l5(spark, sf):
    hrefs = L.extract_hrefs(pages(spark, sf))
    kept = hrefs.select("src_page_id", F.filter("hrefs", L.is_followable).alias("hrefs"))
    return kept.select(
        F.col("src_page_id").alias("page_id"), F.explode("hrefs").alias("href")
    )


def links(spark: SparkSession, sf: str) -> DataFrame:
    return L.explode_links(L.followable_hrefs(pages(spark, sf)))


@query("l6_distinct_hrefs", f"SELECT page_id, href, link_pos FROM ({DISTINCT}) AS d")
def l6(spark, sf):
    return links(spark, sf).select(
        F.col("src_page_id").alias("page_id"), "href", F.col("link_pos").cast("bigint")
    )


_JOINED = S.join_url(_BASE, "href")


@query(
    "l7_resolve_urls",
    f"SELECT page_id, href, {_JOINED} AS joined FROM ({DISTINCT}) AS d",
)
def l7(spark, sf):
    from pageloom.functions.urls import url_join

    return links(spark, sf).select(
        F.col("src_page_id").alias("page_id"),
        "href",
        url_join(F.col("src_url"), F.col("href")).alias("joined"),
    )


def site_links(spark: SparkSession, sf: str) -> DataFrame:
    hrefs = L.attach_site(L.followable_hrefs(pages(spark, sf)), sites(spark, sf), "src_url")
    return L.on_site(L.resolve_links(L.explode_links(hrefs)))


@query("l9_on_site_links", f"SELECT page_id, full_url, site_domain FROM ({ON_SITE}) AS o")
def l9(spark, sf):
    return site_links(spark, sf).select(
        F.col("src_page_id").alias("page_id"), "full_url", "site_domain"
    )


@query(
    "l9_on_any_site_links",
    f"""SELECT page_id, full_url FROM ({RESOLVED}) AS r
        WHERE {S.frontier_host('full_url')} IN (SELECT domain FROM fx_sites WHERE active)""",
)
def l9_any(spark, sf):
    active = sites(spark, sf).where("active")
    return L.on_site(L.resolve_links(links(spark, sf)), active).select(
        F.col("src_page_id").alias("page_id"), "full_url"
    )


@query(
    "l10_first_visits",
    f"""SELECT site_domain, full_url, page_id AS src_page_id, link_pos
        FROM (SELECT *, row_number() OVER (PARTITION BY site_domain, full_url
                                           ORDER BY page_id, link_pos) AS rn
              FROM ({ON_SITE}) AS o) AS f
        WHERE rn = 1 AND full_url NOT IN (SELECT {S.canonical('url')} FROM fx_pages
                                          WHERE page_id % 2 = 0)""",
)
def l10(spark, sf):
    from pageloom.functions.urls import canonical_url

    seen = pages(spark, sf).where("page_id % 2 = 0")
    history = L.attach_site(seen, sites(spark, sf), "url").select(
        "site_domain", canonical_url(F.col("url")).alias("full_url")
    )
    return L.first_visits(site_links(spark, sf), history).select(
        "site_domain", "full_url", "src_page_id", F.col("link_pos").cast("bigint")
    )


@query(
    "l10_visited_set",
    f"""SELECT site_domain, full_url, page_id AS src_page_id, link_pos
        FROM (SELECT *, row_number() OVER (PARTITION BY site_domain, full_url
                                           ORDER BY page_id, link_pos) AS rn,
                     bool_or(page_id % 5 = 0 OR page_id % 7 = 0) OVER (PARTITION BY site_domain, full_url) AS seen
              FROM ({ON_SITE}) AS o) AS f
        WHERE rn = 1 AND NOT seen""",
)
def l10_visited(spark, sf):
    """First visits against a kept set of two earlier runs, whose bits leave most links without a comparison."""
    visited, found = VisitedSet(spark, scratch_path(spark, "visited"), cells=16), site_links(spark, sf)
    for run, part in enumerate(["src_page_id % 5 = 0", "src_page_id % 7 = 0"]):
        visited.add(f"run-{run}", found.where(part).select("site_domain", "full_url"))
    return L.first_visits(found, visited.unseen).select(
        "site_domain", "full_url", "src_page_id", F.col("link_pos").cast("bigint")
    )


_FOLDED_URL = "lower(strip_accents(full_url))"


@query(
    "l10_folded_visits",
    f"""SELECT site_domain, full_url, page_id AS src_page_id, link_pos
        FROM (SELECT *, row_number() OVER (PARTITION BY site_domain, {_FOLDED_URL}
                                           ORDER BY page_id, link_pos) AS rn
              FROM (SELECT * REPLACE (CASE WHEN page_id % 2 = 0 THEN upper(full_url) ELSE full_url END AS full_url)
                    FROM ({ON_SITE}) AS o) AS u) AS f
        WHERE rn = 1 AND {_FOLDED_URL} NOT IN (SELECT lower(strip_accents({S.canonical('url')})) FROM fx_pages
                                               WHERE page_id % 2 = 0)""",
)
def l10_folded(spark, sf):
    """Links spelled in two ways are visited once."""
    from pageloom.functions.urls import canonical_url

    spelled = F.when(F.col("src_page_id") % 2 == 0, F.upper("full_url")).otherwise(F.col("full_url"))
    seen = pages(spark, sf).where("page_id % 2 = 0")
    history = L.attach_site(seen, sites(spark, sf), "url").select(
        "site_domain", canonical_url(F.col("url")).alias("full_url")
    )
    return L.first_visits(site_links(spark, sf).withColumn("full_url", spelled), history, fold=True).select(
        "site_domain", "full_url", "src_page_id", F.col("link_pos").cast("bigint")
    )


@query(
    "l11_drop_irrelevant",
    f"""SELECT page_id, url FROM fx_pages
        WHERE NOT {S.contains_any('lower(url)', IRRELEVANT_WORDS)}""",
)
def l11(spark, sf):
    words = lists(spark).irrelevant
    df = pages(spark, sf).select("page_id", "url")
    return df.where(~L.is_irrelevant(F.col("url"), words))


@query(
    "l12_category_flag",
    f"""SELECT page_id, {S.contains_any('lower(url)', CATEGORY)} AS is_category_link
        FROM fx_pages""",
)
def l12(spark, sf):
    words = lists(spark).category
    return pages(spark, sf).select(
        "page_id", L.is_category_link(F.col("url"), words).alias("is_category_link")
    )


def frontier(spark: SparkSession, sf: str) -> DataFrame:
    words = lists(spark)
    return L.build_frontier(
        pages(spark, sf), sites(spark, sf), words.category, words.irrelevant
    )


@query("l13_link_provenance", f"{FRONTIER}")
def l13(spark, sf):
    return frontier(spark, sf).withColumn("link_pos", F.col("link_pos").cast("bigint"))


# Every second page is linked from the first page of its host, so that pages meet their links.
_LINKED = f"""
    SELECT page_id, url, {S.canonical('url')} AS canon, {S.frontier_host('url')} AS host
    FROM fx_pages WHERE page_id % 2 = 0
"""


@query(
    "l14_page_provenance",
    f"""SELECT p.page_id, coalesce(l.flag, false) AS is_category_link, l.canon AS source_xpath
        FROM fx_pages AS p
        LEFT JOIN (SELECT canon, host, bool_or({S.contains_any('lower(canon)', CATEGORY)}) AS flag
                   FROM ({_LINKED}) AS k GROUP BY canon, host) AS l
        ON {S.canonical('p.url')} = l.canon""",
)
def l14(spark, sf):
    from pageloom.functions.urls import canonical_url

    page_urls = pages(spark, sf).select("page_id", "url")
    linked = page_urls.where("page_id % 2 = 0").select(
        F.col("page_id").alias("src_page_id"),
        F.col("url").alias("src_url"),
        F.lit(0).alias("link_pos"),
        canonical_url(F.col("url")).alias("href"),
        canonical_url(F.col("url")).alias("full_url"),
        F.lit("").alias("site_domain"),
    )
    first = L.with_provenance(L.first_visits(linked), lists(spark).category)
    return L.attach_provenance(page_urls, first).select(
        "page_id", "is_category_link", "source_xpath"
    )
