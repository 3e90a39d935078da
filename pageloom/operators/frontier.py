"""Link frontier: which pages to visit next, and where each of them was found."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.fixed_values import ARTICLE_HREF_PARTS, SKIPPED_HREF_PREFIXES
from pageloom.functions import html as H
from pageloom.functions import tags as T
from pageloom.functions import urls as U
from pageloom.functions.text import contains_any, decode_entities, let, starts_with_any, strip
from pageloom.operators.binding import bind


def seed_sites(sites: DataFrame, start_url: str | None = None) -> DataFrame:
    """All sites, or only those whose start URL is the one asked for."""
    if not start_url:
        return sites
    return sites.where(strip(F.col("start_url")) == strip(F.lit(start_url)))


def allowed_hosts(sites: DataFrame) -> DataFrame:
    """Hosts a run may visit, each with its ``www.`` variant."""
    hosts = sites.select(U.frontier_host(F.col("start_url")).alias("host"))
    return hosts.where(F.col("host") != "").distinct().select(
        F.explode(F.array("host", F.concat(F.lit("www."), "host"))).alias("host")
    )


def link_source_pages(pages: DataFrame) -> DataFrame:
    """Only pages of depth 0 give links; a page without depth counts as one."""
    if "depth" not in pages.columns:
        return pages
    return pages.where(F.coalesce(F.col("depth"), F.lit(0)) < 1)


def is_followable(href: Column) -> Column:
    return (href != "") & ~starts_with_any(href, SKIPPED_HREF_PREFIXES)


def _anchor(tag: Column, inside: Column) -> Column:
    return F.struct(H.raw_attribute(tag, "href").alias("raw"), inside.alias("inside"))


def page_anchors(html: Column) -> Column:
    """Anchors in document order as ``array<struct<raw, inside>>``."""
    return markup_anchors(H.visible_markup(html))


def markup_anchors(markup: Column) -> Column:
    """The same from the visible markup.

    ``raw`` is the quoted href, empty without one; ``inside`` marks those in a main or article element.
    """

    def anchors(piece: Column) -> Column:
        tags = F.regexp_extract_all(piece["text"], F.lit(H.ANCHOR), F.lit(0))
        return F.transform(tags, lambda tag: _anchor(tag, T.is_inside(piece)))

    return F.flatten(F.transform(T.nested(markup, "main|article"), anchors))


def _is_article_anchor(anchor: Column) -> Column:
    return (anchor["raw"] != "") & (
        anchor["inside"] | contains_any(anchor["raw"], ARTICLE_HREF_PARTS)
    )


def chosen_hrefs(anchors: Column) -> Column:
    """Hrefs of the article anchors; of all anchors when the page has no article anchor."""
    raw = F.when(
        F.exists(anchors, _is_article_anchor), F.filter(anchors, _is_article_anchor)
    ).otherwise(anchors)
    return F.transform(raw, lambda a: decode_entities(H.unquote(a["raw"]), attribute=True))


def extract_hrefs(pages: DataFrame) -> DataFrame:
    """One row per page with its chosen hrefs; the page's html ends here."""
    anchored = link_source_pages(pages).select(
        F.col("page_id").alias("src_page_id"),
        F.col("url").alias("src_url"),
        page_anchors(F.col("html")).alias("anchors"),
    )
    return bind(anchored, hrefs=chosen_hrefs(F.col("anchors"))).drop("anchors")


def followable_hrefs(pages: DataFrame) -> DataFrame:
    """Hrefs of each page without invalid ones and without repeats.

    ``array_distinct`` keeps the first occurrence, so no shuffle is needed.
    """
    return extract_hrefs(pages).withColumn(
        "hrefs", F.array_distinct(F.filter("hrefs", is_followable))
    )


def explode_links(hrefs: DataFrame) -> DataFrame:
    """One row per link with its position among the page's links."""
    links = hrefs.select(
        *[c for c in hrefs.columns if c != "hrefs"],
        F.posexplode_outer("hrefs").alias("link_pos", "href"),
    )
    return links.where(F.col("link_pos").isNotNull())


def attach_site(df: DataFrame, sites: DataFrame, url: str) -> DataFrame:
    """Add ``site_domain`` and ``site_host`` of the site whose start URL shares the host.

    Of sites with one host, the last in priority order owns it, as in ``site_lookup``.
    """
    order = [-F.col("priority")] if "priority" in sites.columns else []
    named = sites.select(
        "domain",
        U.frontier_host(F.col("start_url")).alias("site_host"),
        F.struct(*[c.alias(f"_{i}") for i, c in enumerate([*order, F.col("domain")])]).alias("_order"),
    )
    hosts = named.where(F.col("site_host") != "").groupBy("site_host").agg(
        F.max_by("domain", "_order").alias("site_domain")
    )
    return df.join(hosts, U.frontier_host(F.col(url)) == F.col("site_host"))


def resolve_links(links: DataFrame) -> DataFrame:
    """Add the canonical absolute URL of each link."""
    cut = links.withColumns(
        {
            "_base": U.before_query(F.col("src_url")),
            "_ref": U.before_query(U.clean_ref(F.col("href"))),
        }
    )
    full_url = U.strip_slashes(U.join_paths(F.col("_base"), F.col("_ref")))
    return bind(cut, full_url=full_url).drop("_base", "_ref")


def on_site(links: DataFrame, sites: DataFrame | None = None) -> DataFrame:
    """Keep links to the page's own site, or to any of the given sites."""
    host = U.frontier_host(F.col("full_url"))
    if sites is None:
        return links.where(host == F.col("site_host"))
    allowed = sites.select(U.frontier_host(F.col("start_url")).alias("allowed")).where(
        F.col("allowed") != ""
    )
    return links.join(allowed, host == F.col("allowed"), "left_semi")


def is_irrelevant(url: Column, keywords: list[str]) -> Column:
    return let(F.lower(url), lambda lowered: contains_any(lowered, keywords))


def is_category_link(url: Column, keywords: list[str]) -> Column:
    return let(F.lower(url), lambda lowered: contains_any(lowered, keywords))


#: Links of earlier runs as a table, or what leaves them out of a table of links.
History = DataFrame | Callable[[DataFrame], DataFrame]


def first_visits(
    links: DataFrame, history: History | None = None, per_site: bool = True, fold: bool = False
) -> DataFrame:
    """The first link to each URL, in page and link order; URLs of earlier runs are left out.

    A minimum combines on the map side, so a URL that every page links to costs one row per task. With ``fold``, URLs
    that differ in case and accents only are one.
    """
    site = ["site_domain"] if per_site else []
    keys = [*site, "_visit"] if fold else [*site, "full_url"]

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumn("_visit", U.folded(F.col("full_url"))) if fold else df

    rest = [c for c in links.columns if c not in keys and c not in ("src_page_id", "link_pos")]
    first = F.min(F.struct("src_page_id", "link_pos", *rest)).alias("first")
    firsts = keyed(links).groupBy(*keys).agg(first).select(*keys, "first.*")
    if callable(history):
        firsts = history(firsts.drop("_visit"))
    elif history is not None:
        firsts = firsts.join(keyed(history).select(*keys).distinct(), keys, "left_anti")
    return firsts.drop("_visit")


def build_frontier(
    pages: DataFrame,
    sites: DataFrame,
    category_keywords: list[str],
    irrelevant_keywords: list[str],
    history: History | None = None,
    per_site: bool = True,
    fold: bool = False,
) -> DataFrame:
    """Frontier of depth 1 with the provenance of each link."""
    return frontier_of(
        followable_hrefs(pages), sites, category_keywords, irrelevant_keywords, history, per_site, fold
    )


def frontier_of(
    hrefs: DataFrame,
    sites: DataFrame,
    category_keywords: list[str],
    irrelevant_keywords: list[str],
    history: History | None = None,
    per_site: bool = True,
    fold: bool = False,
) -> DataFrame:
    """The same from the hrefs of pages (``src_page_id, src_url, hrefs``)."""
    hrefs = attach_site(hrefs, sites, "src_url")
    links = on_site(resolve_links(explode_links(hrefs)), None if per_site else sites)
    relevant = links.drop("site_host").where(
        ~is_irrelevant(F.col("full_url"), irrelevant_keywords)
    )
    return with_provenance(first_visits(relevant, history, per_site, fold), category_keywords)


def with_provenance(links: DataFrame, category_keywords: list[str]) -> DataFrame:
    """The frontier's columns; ``source_xpath`` holds the href as written on the page."""
    return links.select(
        "src_page_id",
        "src_url",
        "link_pos",
        "href",
        "full_url",
        "site_domain",
        F.lit(1).alias("depth"),
        is_category_link(F.col("full_url"), category_keywords).alias("is_category_link"),
        F.col("href").alias("source_xpath"),
    )


def attach_provenance(pages: DataFrame, frontier: DataFrame, fold: bool = False) -> DataFrame:
    """Carry flag and source of the link to the fetched page; no link means no category link.

    ``frontier`` holds a URL once (per site: once per page and site). Pages that were redirected
    may name the URL asked for in ``request_url``. ``fold`` is as in ``first_visits``.
    """
    asked = (
        F.coalesce(F.col("request_url"), F.col("url"))
        if "request_url" in pages.columns
        else F.col("url")
    )
    keys = ["link_url"] + (["site_domain"] if "site_domain" in pages.columns else [])
    links = frontier.select(
        U.key_of(F.col("full_url"), fold).alias("link_url"), *keys[1:], "is_category_link", "source_xpath"
    )
    joined = pages.withColumn("link_url", U.key_of(U.canonical_url(asked), fold)).join(links, keys, "left")
    return joined.withColumn(
        "is_category_link", F.coalesce("is_category_link", F.lit(False))
    ).drop("link_url")
