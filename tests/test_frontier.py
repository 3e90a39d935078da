"""Link frontier on literal pages."""

import pytest

from helpers import values
from pageloom import fixed_values
from pageloom.operators import frontier as L
from pageloom.sources.keywords import default_keywords, keyword_lists

SITES = "site_id bigint, domain string, start_url string"


def hrefs(spark, html):
    df = spark.createDataFrame([(1, "https://a.gr/x", html)], "page_id bigint, url string, html string")
    return L.followable_hrefs(df).first()["hrefs"]


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<a href='/1'>1</a><main><a href=/2>2</a></main><a href='/news/3'>3</a>", ["/2", "/news/3"]),
        ("<a href='/1'>1</a><a>no</a><A HREF=\"/2\">2</A><a href='/1'>1</a>", ["/1", "/2"]),
        # The fallback is decided before invalid hrefs are dropped.
        ("<article><a href='#top'>t</a></article><a href='/1'>1</a>", []),
        ("<a href=''>e</a><a href='javascript:x'>j</a><a href='JavaScript:x'>j</a>", ["JavaScript:x"]),
        ("<!-- <a href='/c'>c</a> --><script>'<a href=\"/s\">'</script><a href='/k?a=1&amp;b'>k</a>", ["/k?a=1&b"]),
        ("<a href='/Article/1'>x</a><a href='/y'>y</a>", ["/Article/1", "/y"]),
        ("<abbr href='/no'>x</abbr><a\nclass=c\nhref='/y'>y</a>", ["/y"]),
        ('<article><article>x</article><a href="/p1"></a></article><a href="/p2"></a>', ["/p1"]),
        ("<main><article>x</main><a href='/p1'></a><a href='/p2'></a>", ["/p1", "/p2"]),
        ("<main><section><main></main><a href='/p1'></a></section></main><a href='/p2'></a>", ["/p1"]),
        ("<a title='1 > 0' href='/p1?a>b'>x</a><p data-x=\"<a href='/no'>\">", ["/p1?a>b"]),
        ("<main-menu><a href='/1'>1</a></main-menu><a href='/2'>2</a>", ["/1", "/2"]),
        ("", []),
    ],
)
def test_hrefs(spark, html, expected):
    assert hrefs(spark, html) == expected


def build(spark, pages, sites, **kwargs):
    page_df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    site_df = spark.createDataFrame(sites, SITES)
    return L.build_frontier(page_df, site_df, ["sport"], ["tag"], **kwargs)


def test_frontier(spark):
    pages = [
        (1, "https://www.a.gr/", "<a href='/sport/1/'>1</a><a href='/TAG/2'>2</a><a href='https://b.gr/x'>b</a>"),
        (2, "https://a.gr/p", "<a href='sport/1'>1</a><a href='//www.a.gr/new'>n</a>"),
        (3, "https://b.gr/", "<a href='/x?y'>x</a><a href='https://c.gr/'>c</a>"),
        (4, "https://unknown.gr/", "<a href='/x'>x</a>"),
    ]
    sites = [(1, "a.gr", "https://www.A.gr"), (2, "b.gr", "http://b.gr/home")]
    found = values(
        build(spark, pages, sites), "site_domain", "full_url", "src_page_id", "is_category_link", "depth"
    )
    assert found == [
        ("a.gr", "https://a.gr/sport/1", 2, True, 1),
        ("a.gr", "https://www.a.gr/new", 2, False, 1),
        ("a.gr", "https://www.a.gr/sport/1", 1, True, 1),
        ("b.gr", "https://b.gr/x", 3, False, 1),
    ]
    whole = values(build(spark, pages, sites, per_site=False), "full_url", "src_page_id")
    assert ("https://b.gr/x", 1) in whole and ("https://b.gr/x", 3) not in whole


def test_hot_link_target_keeps_the_first_source(spark):
    """Every page links to one URL; partial minima must agree with a full scan."""
    pages = [
        (i, f"https://a.gr/{i}", "<a href='/hot'>h</a>" + f"<a href='/own{i}'>o</a>") for i in range(300, 0, -1)
    ]
    out = build(spark, pages, [(1, "a.gr", "https://a.gr")])
    rows = {r["full_url"]: r["src_page_id"] for r in out.collect()}
    assert rows["https://a.gr/hot"] == 1 and len(rows) == 301


def test_default_keywords_are_substrings_of_the_whole_url(spark):
    words = keyword_lists(default_keywords(spark))
    assert len(words.irrelevant) == len(fixed_values.IRRELEVANT_KEYWORDS) == 25
    assert len(words.category) == 71 and "κρήτη" in words.category
    urls = [
        ("https://site.example.com/a",), ("https://hotel.gr/a",), ("https://happy.gr/x",),
        ("https://a.gr/ΚΡΉΤΗ/x",), ("https://a.gr/%CE%BA/x",),
    ]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(urls, "u string").select(
        L.is_irrelevant(F.col("u"), words.irrelevant).alias("i"),
        L.is_category_link(F.col("u"), words.category).alias("c"),
    )
    assert [tuple(r) for r in df.collect()] == [
        (True, False), (True, False), (False, True), (False, True), (False, False),
    ]


def test_depth_and_provenance(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, None)], "page_id bigint, depth int")
    assert values(L.link_source_pages(df), "page_id") == [(1,), (3,)]
    pages = spark.createDataFrame(
        [(1, "https://a.gr/x/?q", None), (2, "https://a.gr/moved", "https://a.gr/y"), (3, "https://a.gr/z", None)],
        "page_id bigint, url string, request_url string",
    )
    links = spark.createDataFrame(
        [("https://a.gr/x", True, "/x"), ("https://a.gr/y", True, "y")],
        "full_url string, is_category_link boolean, source_xpath string",
    )
    assert values(L.attach_provenance(pages, links), "page_id", "is_category_link", "source_xpath") == [
        (1, True, "/x"), (2, True, "y"), (3, False, None),
    ]


def test_seed_and_allowed_hosts(spark):
    sites = spark.createDataFrame(
        [(1, "a.gr", "https://WWW.a.gr/"), (2, "b.gr", " https://b.gr "), (3, "c.gr", "no-host")], SITES
    )
    assert values(L.seed_sites(sites, "https://b.gr\n"), "domain") == [("b.gr",)]
    assert L.seed_sites(sites).count() == 3
    assert values(L.allowed_hosts(sites)) == [("a.gr",), ("www.a.gr",)]


LINKS = "src_page_id int, link_pos int, site_domain string, full_url string"


def test_visited_set(spark, folder):
    """New links pass by the bitmap alone; only possible hits are compared, and none is lost."""
    from pageloom.sinks.visited import CELL_BITS, VisitedSet

    def links(numbers, site="a.gr"):
        return spark.createDataFrame([(i, 0, site, f"https://a.gr/{i}") for i in numbers], LINKS).repartition(3)

    visited = VisitedSet(spark, folder, cells=2)
    assert visited.unseen(links(range(5))).count() == 5
    visited.add("r1", links(range(1000)))
    visited.add("r2", links(range(900, 2000)).unionByName(spark.createDataFrame([(1, 0, "a.gr", None)], LINKS)))
    visited.add("r2", links(range(900, 2000)))  # a run written again
    assert visited.urls().count() == 2100
    found = visited.told_apart(links(range(1500, 6000)))
    possible = found.possible.count()
    assert 500 <= possible < 500 + 3 * 4000 * 2000 / (2 * CELL_BITS) and found.new.count() == 4500 - possible
    assert values(visited.unseen(links(range(1500, 6000))), "src_page_id") == [(i,) for i in range(2000, 6000)]
    assert visited.unseen(links(range(10), "b.gr")).count() == 10
    assert VisitedSet(spark, folder, cells=2).unseen(links(range(3000))).count() == 1000
    nulls = spark.createDataFrame([(1, 0, "a.gr", None), (2, 0, None, "https://a.gr/1")], LINKS)
    assert visited.unseen(nulls).count() == 2


def test_crowded_bits_cost_no_link(spark, folder):
    from pageloom.sinks.visited import VisitedSet

    links = spark.range(60_000).selectExpr("int(id) AS src_page_id", "0 AS link_pos", "'a.gr' AS site_domain", "concat('https://A.gr/', id) AS full_url")
    visited = VisitedSet(spark, folder, cells=1, per_site=False, fold=True)
    visited.add("r", links.where("src_page_id % 2 = 0").selectExpr("lower(full_url) AS full_url"))
    assert visited.unseen(links).where("src_page_id % 2 = 1").count() == visited.unseen(links).count() == 30_000


def test_second_run_visits_new_links_only(spark, folder):
    from pageloom.sinks.visited import VisitedSet

    visited = VisitedSet(spark, folder)
    pages = [(1, "https://a.gr/", "<a href='/x'>x</a><a href='/y'>y</a>")]
    first = build(spark, pages, [(1, "a.gr", "https://a.gr")], history=visited.unseen)
    visited.add("r1", first)
    more = [(2, "https://a.gr/z", "<a href='/y'>y</a><a href='/new'>n</a>")]
    assert values(build(spark, more, [(1, "a.gr", "https://a.gr")], history=visited.unseen), "full_url") == [("https://a.gr/new",)]
