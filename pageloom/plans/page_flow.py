"""From fetched pages to page items."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions.text import let
from pageloom.operators import cleanup, extract, frontier
from pageloom.operators.features import page_items
from pageloom.sources.keywords import KeywordLists


def fetched_items(
    pages: DataFrame,
    rules: DataFrame | None = None,
    links: DataFrame | None = None,
    sites: DataFrame | None = None,
) -> DataFrame:
    """Items of fetched pages: extraction, owning site, provenance, features.

    With ``sites``, only pages that one of them owns are kept. Extraction is narrow and drops the
    html; only its results travel to the joins.
    """
    return items_of(extract.parse_pages(pages, rules is not None), rules, links, sites)


#: Columns by which a page's site, patterns and link are found.
_LOOKED_UP_BY = ("page_id", "url", "request_url", "site_domain")


def items_of(
    parsed: DataFrame,
    rules: DataFrame | None = None,
    links: DataFrame | None = None,
    sites: DataFrame | None = None,
) -> DataFrame:
    """The same from parsed pages.

    With links, all that is looked up for a page is found by its narrow columns first, and joined to the texts once.
    """
    if links is None:
        if sites is not None:
            parsed = frontier.attach_site(parsed, sites, "url").drop("site_host")
        return page_items(extract.clean_pages(parsed, rules))
    keys = [c for c in _LOOKED_UP_BY if c in parsed.columns]
    found = parsed.select(*keys).distinct()
    if sites is not None:
        found = frontier.attach_site(found, sites, "url").drop("site_host")
    if rules is not None:
        found = cleanup.with_patterns(found, rules)
    found = frontier.attach_provenance(found, links).withColumnsRenamed({c: f"_{c}" for c in keys})
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys])
    joined = parsed.join(found, same).drop(*[f"_{c}" for c in keys])
    return page_items(joined if rules is None else extract.clean_by_patterns(joined))


def parse_for_run(pages: DataFrame, any_rules: bool) -> DataFrame:
    """One pass over the html of a run: hrefs of link sources, and the parts of the items.

    With a ``depth`` column, pages of depth 0 give links and the others give items; without it
    every page does both.
    """
    is_source = F.coalesce(F.col("depth"), F.lit(0)) < 1 if "depth" in pages.columns else F.lit(True)

    def hrefs(markup: Column) -> Column:
        chosen = let(frontier.markup_anchors(markup), frontier.chosen_hrefs)
        return F.when(is_source, F.array_distinct(F.filter(chosen, frontier.is_followable)))

    return extract.parse_pages(pages, any_rules, hrefs)


def run_links(
    parsed: DataFrame, sites: DataFrame, keywords: KeywordLists, history: frontier.History | None = None
) -> DataFrame:
    """Frontier of the parsed pages of the given sites, without URLs of earlier runs."""
    sources = parsed.where(F.col("hrefs").isNotNull()).select(
        F.col("page_id").alias("src_page_id"), F.col("url").alias("src_url"), "hrefs"
    )
    return frontier.frontier_of(sources, sites, keywords.category, keywords.irrelevant, history)


def run_items(
    parsed: DataFrame, sites: DataFrame, rules: DataFrame | None, links: DataFrame
) -> DataFrame:
    """Items of the parsed pages of the given sites."""
    content = parsed.where(F.col("depth") >= 1) if "depth" in parsed.columns else parsed
    return items_of(content.drop("hrefs"), rules, links, sites)
