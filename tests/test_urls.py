"""URL functions against Python's urllib and on literal cases."""

from urllib.parse import urljoin, urlparse

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import evaluate
from pageloom.functions import urls as U

BASE = "https://www.a.gr/x/y/z"
REFS = [
    "/p", "p", "../p", "./p", "../../../p", "//b.gr/q", "?k=1", "", "#t", "a/../b/", "tel:123",
    "http://c.gr/d?e#f", "https:g", "HTTPS://C.gr/d", "a//b", "/a//b/", "..", ".", "../", "x;v=1",
    "  /lead", "\n/br\teak", "p?q=/../r", "p#f/../g", "/..", "/../a", "a/./b", "...", "/a/...",
    "?", "#", "p?", "p#", "Ελλάδα/νέα", "a b", "mailto:x@y.gr", "//", "a/b/..", "a/b/.",
]
BASES = [
    BASE, "https://a.gr", "https://a.gr/", "http://a.gr:8080/x/", "https://a.gr/x?y=/z/1",
    "https://a.gr/x/y#f/g", "https://a.gr/x//y/z", "https://a.gr?q=1",
]


def joined(spark, pairs):
    return evaluate(
        spark, pairs, "base string, ref string", U.url_join(F.col("base"), F.col("ref"))
    )


def test_join_matches_urllib(spark):
    pairs = [(b, r) for b in BASES for r in REFS if r != "//"]
    assert joined(spark, pairs) == [urljoin(b, r) for b, r in pairs]


_SEGMENT = st.sampled_from(["a", "b.html", ".", "..", "", "ab-c", "ν"])
_PATH = st.lists(_SEGMENT, max_size=6).map("/".join)
_TAIL = st.sampled_from(["", "?q=1", "#f", "?q#f"])
_REF = st.builds(lambda p, t: p + t, _PATH, _TAIL).filter(lambda r: not r.startswith("//"))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(BASES), _REF), min_size=60, max_size=120))
def test_join_matches_urllib_at_random(spark, pairs):
    assert joined(spark, pairs) == [urljoin(b, r) for b, r in pairs]


def test_canonical_join_cuts_first(spark):
    from pageloom.operators.frontier import resolve_links

    pairs = [(b, r) for b in BASES for r in REFS if r not in ("", "//")]
    rows = [(i, b, r) for i, (b, r) in enumerate(pairs)]
    df = resolve_links(spark.createDataFrame(rows, "i int, src_url string, href string"))
    found = {r["i"]: r["full_url"] for r in df.collect()}
    for i, (base, ref) in enumerate(pairs):
        expected = urljoin(base, ref).split("#")[0].split("?")[0].rstrip("/")
        assert found[i] == expected, (base, ref)


def test_hosts(spark):
    urls = [
        "https://www.A.gr:80/p", "http://m.www.b.gr", "//c.gr/x", "no-scheme/x", "https://δοκιμή.gr/",
        "https://d.gr?q", "",
    ]
    rows = [(u,) for u in urls]
    assert evaluate(spark, rows, "u string", U.netloc(F.col("u"))) == [
        urlparse(u).netloc for u in urls
    ]
    assert evaluate(spark, rows, "u string", U.frontier_host(F.col("u"))) == [
        urlparse(u).netloc.lower().replace("www.", "") for u in urls
    ]
    assert evaluate(spark, rows, "u string", U.rule_host(F.col("u"))) == [
        urlparse(u).netloc.replace("www.", "") for u in urls
    ]
    domains = [("www.a.gr",), ("m.www.a.gr",), (None,), ("wwwa.gr",)]
    assert evaluate(spark, domains, "d string", U.registry_domain(F.col("d"))) == [
        "a.gr", "m.www.a.gr", None, "wwwa.gr",
    ]


def test_canonical_is_idempotent(spark):
    urls = [("https://a.gr/x//?q#f",), ("https://a.gr#x?y",), ("///",), ("https://a.gr/x/",)]
    once = U.canonical_url(F.col("u"))
    assert evaluate(spark, urls, "u string", once) == evaluate(
        spark, urls, "u string", U.canonical_url(once)
    )


def test_date_path(spark):
    urls = [("https://a.gr/2024/01/02/x",), ("https://a.gr/2024/1/02/",), ("https://a.gr/٢٠٢٤/٠١/٠٢/",)]
    assert evaluate(spark, urls, "u string", U.has_date_path(F.col("u"))) == [True, False, True]
