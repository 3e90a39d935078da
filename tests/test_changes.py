"""Change detection, numbering and upsert against brute force."""

import datetime
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from helpers import values
from pageloom.operators import changes as D
from pageloom.operators import integrity
from pageloom.operators.numbering import number_rows
from pageloom.schemas import ARTICLES
from pageloom.sinks.article_store import ArticleStore

BATCH = "url string, site_id bigint, ingest_seq bigint, title string, body string, image_url string, content_hash string"
OLD, NOW, LATER = (datetime.datetime(2024, m, 1) for m in (1, 2, 3))


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def batch_of(spark, rows):
    full = [
        (url, 1, seq, f"t{seq}", body, f"i{seq}", md5(body)) for seq, url, body in rows
    ]
    return spark.createDataFrame(full, BATCH)


def state_of(spark, articles):
    """``articles``: (id, url, body, hash or None)."""
    rows = [(i, 7, u, "old", b, "", h, OLD, OLD) for i, u, b, h in articles]
    return spark.createDataFrame(rows, ARTICLES)


def brute_force(articles, rows):
    """Row by row: statuses by sequence number, and the final articles by URL."""
    stored = {u: dict(id=i, title="old", body=b, hash=h, new=False, seen=False) for i, u, b, h in articles}
    last = max([a[0] for a in articles], default=0)
    statuses = {}
    for seq, url, body in sorted(rows):
        row = stored.get(url)
        fresh = dict(title=f"t{seq}", body=body, hash=md5(body))
        if row is None:
            last += 1
            stored[url] = dict(id=last, new=True, seen=True, **fresh)
            statuses[seq] = "NEW"
        elif row["hash"] != md5(body):
            row.update(fresh, seen=True)
            statuses[seq] = "UPDATED"
        else:
            row["seen"] = True
            statuses[seq] = "UNCHANGED"
    return statuses, stored


def check(spark, articles, rows, run_rows):
    statuses, stored = brute_force(articles, rows)
    state, batch = state_of(spark, articles), batch_of(spark, rows)
    log = D.change_log(batch, state, run_rows)
    assert {r["ingest_seq"]: r["status"] for r in log.collect()} == statuses
    after = D.upsert(state, batch, log, NOW, D.last_article_id(state), run_rows)
    found = {
        r["url"]: (r["article_id"], r["title"], r["body"], r["content_hash"], r["site_id"], r["scraped_at"], r["last_cited_date"])
        for r in after.collect()
    }
    assert found == {
        u: (a["id"], a["title"], a["body"], a["hash"], 1 if a["new"] else 7,
            NOW if a["new"] else OLD, NOW if a["seen"] else OLD)
        for u, a in stored.items()
    }


@pytest.mark.parametrize("run_rows", [1, 3, 1 << 20])
def test_return_to_the_old_text(spark, run_rows):
    articles = [(4, "u", "A", md5("A")), (5, "n", "A", None), (9, "idle", "A", md5("A"))]
    rows = [(0, "u", "A"), (1, "u", "B"), (2, "u", "A"), (3, "n", "A"), (4, "n", "A"), (5, "x", "C"), (8, "x", "C")]
    check(spark, articles, rows, run_rows)


@pytest.mark.parametrize("run_rows", [2, 7, 64])
def test_hot_url(spark, run_rows):
    """One URL holds more than a third of the rows, over many runs."""
    rng = random.Random(run_rows)
    urls = ["hot"] * 6 + [f"u{i}" for i in range(10)]
    rows = [(seq, rng.choice(urls), rng.choice("AB")) for seq in range(400)]
    check(spark, [(3, "hot", "A", md5("A")), (8, "u1", "B", md5("B"))], rows, run_rows)


def test_empty_sides(spark):
    check(spark, [], [(5, "a", "A"), (2, "b", "B")], 4)
    check(spark, [(1, "a", "A", md5("A"))], [], 4)


def test_same_batch_twice_changes_nothing(spark):
    rows = [(i, f"u{i % 5}", "AB"[i % 2 if i < 5 else i % 3 == 0]) for i in range(10)]
    state, batch = state_of(spark, []), batch_of(spark, rows)
    last = batch.groupBy("url").agg(F.max("ingest_seq").alias("ingest_seq"))
    final = batch.join(last, ["url", "ingest_seq"])
    after = D.upsert(state, batch, D.change_log(batch, state), NOW, F.lit(0))
    again = D.change_log(final.select(*batch.columns), after)
    assert {r["status"] for r in again.collect()} == {"UNCHANGED"}


def test_numbers_follow_the_sequence(spark):
    seqs = random.Random(1).sample(range(10_000), 500)
    df = spark.createDataFrame([(s,) for s in seqs], "s bigint").repartition(7)
    out = number_rows(df, "s", F.lit(100), "n", run_rows=64)
    assert values(out, "s", "n") == sorted(
        ((s, 101 + i) for i, s in enumerate(sorted(seqs))), key=repr
    )


def test_article_rows(spark):
    sites = spark.createDataFrame(
        [(1, "www.a.gr", True, 5), (2, "b.gr", False, 5), (3, "c.gr", True, 5), (4, "www.c.gr", True, 9)],
        "site_id bigint, domain string, active boolean, priority int",
    )
    rows = [
        ("https://a.gr/1", 1, None, None, None, "ARTICLE"),
        ("https://www.a.gr/2", 2, "", "x", ["i", "j"], "article"),
        ("https://A.gr/3", 3, "t", "x", [], "article"),
        ("https://b.gr/4", 4, "t", "x", [], "article"),
        ("https://c.gr/5", 5, "t", "x", [], "article"),
        ("https://a.gr/6", 6, "t", "x", [], "other"),
        ("https://a.gr/7", 7, "t", "x", [], None),
    ]
    df = spark.createDataFrame(
        rows, "url string, ingest_seq bigint, title string, article_body string, image_urls array<string>, predicted_label string"
    )
    assert values(D.article_batch(df, sites), "ingest_seq", "site_id", "title", "body", "image_url") == [
        (1, 1, "No Title", "", ""), (2, 1, "No Title", "x", "i"), (5, 3, "t", "x", ""),
    ]
    assert values(D.unresolved_sites(D.only_articles(df), sites), "ingest_seq") == [(3,), (4,)]


def test_long_urls_with_one_key(spark):
    """A third of the rows share their first 255 characters; the first URL keeps the key."""
    stem = "https://a.gr/" + "x" * 242
    assert len(stem) == 255
    rows = [(i, f"{stem}{i % 3}", "A") for i in range(2, 40)] + [(50, "https://a.gr/short", "A"), (51, stem, "A")]
    batch = batch_of(spark, rows).withColumn("site_id", F.when(F.col("ingest_seq") == 50, 2).otherwise(1))
    sites = spark.createDataFrame([(1,)], "site_id bigint")
    checked = integrity.check_articles(batch, state_of(spark, []), sites)
    reasons = {r["ingest_seq"]: r["reject_reason"] for r in checked.collect()}
    assert {s: r for s, r in reasons.items() if s < 50} == {
        i: None if i % 3 == 2 else "duplicate_url_key" for i in range(2, 40)
    }
    assert reasons[50] == "unknown_site" and reasons[51] == "duplicate_url_key"
    held = integrity.check_articles(batch, state_of(spark, [(1, stem + "z", "A", "h")]), sites)
    assert integrity.accepted(held).count() == 0 and integrity.rejected(held).count() == 40


def test_store(spark, folder):
    store = ArticleStore(spark, folder, buckets=4)
    sites = spark.createDataFrame([(1,)], "site_id bigint")
    assert store.read().count() == 0
    first = batch_of(spark, [(i, f"u{i}", "A") for i in range(20)])
    assert store.apply(first, sites, NOW, "b1").where("status = 'NEW'").count() == 20
    before = store.current()
    second = batch_of(spark, [(0, "u3", "A"), (1, "u3", "B"), (2, "v", "C")])
    store.apply(second, sites, LATER, "b2")
    after = store.current()
    assert after.last_id == 21 and after.version == before.version + 1
    changed = {b for b in after.buckets if after.buckets[b] != before.buckets.get(b)}
    assert 0 < len(changed) <= 2
    # A replay finds its batch in the log.
    replay = store.apply(second, sites, datetime.datetime(2025, 1, 1), "b2")
    assert values(replay, "ingest_seq", "status") == [(0, "UNCHANGED"), (1, "UPDATED"), (2, "NEW")]
    assert store.current() == after
    rows = {r["url"]: r for r in store.read().collect()}
    assert len(rows) == 21
    assert (rows["u3"]["body"], rows["u3"]["title"], rows["u3"]["article_id"]) == ("B", "t1", 4)
    assert (rows["u3"]["scraped_at"], rows["u3"]["last_cited_date"]) == (NOW, LATER)
    assert rows["v"]["article_id"] == 21 and rows["u5"]["last_cited_date"] == NOW
    stray = batch_of(spark, [(5, "w", "A")]).withColumn("site_id", F.lit(99).cast("bigint"))
    assert store.apply(stray, sites, LATER, "b4").count() == 0
    assert values(store.rejects("b4"), "url", "reject_reason") == [("w", "unknown_site")]
    # An empty batch is a run without operations.
    assert store.apply(batch_of(spark, []), sites, LATER, "b3").count() == 0
    assert store.read().count() == 21


def test_a_batch_writes_its_own_keys(spark, folder):
    """A store of many articles and batches of a few: levels grow geometrically, and the newest row of a URL counts."""
    sites, store = spark.createDataFrame([(1,)], "site_id bigint"), ArticleStore(spark, folder, buckets=4)
    store.apply(batch_of(spark, [(i, f"u{i}", "A") for i in range(500)]), sites, NOW, "b0")
    expected = {f"u{i}": ("A", i + 1) for i in range(500)}
    for n in range(1, 7):
        rows = [(i, f"u{i * n}", f"{n}") for i in range(9)] + [(20, f"new{n}", "N")]
        store.apply(batch_of(spark, rows), sites, LATER, f"b{n}")
        expected |= {u: (b, expected.get(u, (0, 500 + n))[1]) for _, u, b in rows}
        commit = store.current()
        written = spark.read.parquet(f"{folder}/keys/v={commit.version}").count()
        assert commit.levels[0] == (1, 500) and written == (10 if n == 1 else written) <= 10 * n
        assert len(commit.levels) <= 4
    assert {r["url"]: (r["body"], r["article_id"]) for r in store.read().collect()} == expected


def test_levels_merge_into_the_base(spark, folder):
    sites, store = spark.createDataFrame([(1,)], "site_id bigint"), ArticleStore(spark, folder, buckets=2)
    for n in range(4):
        store.apply(batch_of(spark, [(i, f"u{i}", f"{n}") for i in range(30)]), sites, NOW, f"b{n}")
        assert len(store.current().levels) == 1
        assert spark.read.parquet(f"{folder}/keys/v={n + 1}").count() == 30
    assert {r["body"] for r in store.read().collect()} == {"3"} and store.read().count() == 30


SPELLINGS = ["https://a.gr/άρθρος", "https://A.gr/ΆΡΘΡΟΣ", "HTTPS://a.gr/αρθροσ", "https://a.gr/άρθρος"]


def test_folded_urls(spark, folder):
    """Equal keys share a bucket, name one article, and keep its first spelling, in the store and in the frontier."""
    from pageloom.functions.urls import folded
    from pageloom.operators.frontier import first_visits

    urls = spark.createDataFrame([(u,) for u in SPELLINGS], "url string")
    assert values(urls.select(folded(F.col("url"))).distinct()) == [("https://a.gr/αρθροσ",)]
    store = ArticleStore(spark, folder, buckets=64, fold=True)
    assert urls.select(store._bucket()).distinct().count() == 1
    sites = spark.createDataFrame([(1,)], "site_id bigint")
    rows = [(i, u, "AB"[i > 1]) for i, u in enumerate(SPELLINGS)] + [(9, "https://b.gr/x", "X")]
    log = store.apply(batch_of(spark, rows[:3] + rows[4:]), sites, NOW, "one")
    assert values(log, "ingest_seq", "status") == [(0, "NEW"), (1, "UNCHANGED"), (2, "UPDATED"), (9, "NEW")]
    assert ArticleStore(spark, folder).fold
    log = store.apply(batch_of(spark, rows[3:4]), sites, LATER, "two")
    assert values(log, "ingest_seq", "status") == [(3, "UNCHANGED")]
    assert values(store.read(), "article_id", "url", "body") == [(1, SPELLINGS[0], "B"), (2, "https://b.gr/x", "X")]
    exact = D.change_log(batch_of(spark, rows), state_of(spark, []))
    assert exact.where("status = 'NEW'").count() == 5
    long = [(i, u + "/" + "x" * 300, "A") for i, u in enumerate(SPELLINGS)]
    assert integrity.accepted(integrity.check_articles(batch_of(spark, long), state_of(spark, []), sites, fold=True)).count() == 4
    links = spark.createDataFrame([(i, 0, "a.gr", u) for i, u in enumerate(SPELLINGS)], "src_page_id int, link_pos int, site_domain string, full_url string")
    assert values(first_visits(links, fold=True), "src_page_id", "full_url") == [(0, SPELLINGS[0])]
    assert first_visits(links, links.where("src_page_id = 2"), fold=True).count() == 0 and first_visits(links).count() == 4


def test_result_does_not_depend_on_partitions(spark):
    rows = [(i, f"u{i % 9}", "AB"[i % 4 == 0]) for i in range(200)]
    state = state_of(spark, [(1, "u1", "A", md5("A"))])
    logs = [
        values(D.change_log(batch_of(spark, rows).repartition(n), state, 16)) for n in (1, 3, 11)
    ]
    assert logs[0] == logs[1] == logs[2]


def test_rows_delivered_twice_make_one_article(spark, folder):
    rows = [(1, "u", "A"), (1, "u", "A"), (2, "v", "B"), (2, "v", "B")]
    batch, state = batch_of(spark, rows), state_of(spark, [])
    after = D.upsert(state, batch, D.change_log(batch, state), NOW, F.lit(0))
    assert values(after, "url", "article_id", "body") == [("u", 1, "A"), ("v", 2, "B")]
    store = ArticleStore(spark, folder, buckets=4)
    store.apply(batch, spark.createDataFrame([(1,)], "site_id bigint"), NOW, "b")
    assert values(store.read(), "url", "article_id", "body") == [("u", 1, "A"), ("v", 2, "B")]
    # Opened with another number of buckets, the store keeps its own.
    again = ArticleStore(spark, folder, buckets=7)
    assert again.buckets == 4
    log = again.apply(batch, spark.createDataFrame([(1,)], "site_id bigint"), LATER, "c")
    assert {r["status"] for r in log.collect()} == {"UNCHANGED"} and again.read().count() == 2


def test_rows_without_a_url_are_rejected(spark):
    batch = batch_of(spark, [(1, None, "A"), (2, "u", "B")])
    checked = integrity.check_articles(batch, state_of(spark, []), spark.createDataFrame([(1,)], "site_id bigint"))
    assert values(integrity.rejected(checked), "ingest_seq", "reject_reason") == [(1, "missing_url")]
    assert integrity.accepted(checked).count() == 1


NUMBERS = {
    "dense": "id",
    "hashed": "xxhash64(id)",
    "snowflake": "(1700000000000 + id * 37) * 4194304 + id % 4096",
    "clustered": "CASE WHEN id < 4999 THEN id ELSE 1152921504606846976 END",
    "two clusters and outliers": "CASE WHEN id % 2 = 0 THEN id WHEN id % 97 = 0 THEN -id * 1000000000000 ELSE 4000000000000000000 + id * 5000 END",
}


@pytest.mark.parametrize("kind", sorted(NUMBERS))
@pytest.mark.parametrize("run_rows", [3, 500, 6000])
def test_runs_are_bounded(spark, kind, run_rows):
    from pageloom.operators.numbering import with_run

    df = spark.range(5000).select(F.expr(NUMBERS[kind]).cast("bigint").alias("s")).repartition(5)
    runs = with_run(df, "s", run_rows, df)
    sizes = [r["count"] for r in runs.groupBy("_run").count().collect()]
    assert max(sizes) <= 2 * run_rows and len(sizes) <= 5000 // run_rows + 1
    bounds = sorted((r["_run"], r["low"], r["high"]) for r in runs.groupBy("_run").agg(F.min("s").alias("low"), F.max("s").alias("high")).collect())
    assert all(a[2] < b[1] for a, b in zip(bounds, bounds[1:]))
    numbers = [r["n"] for r in number_rows(df, "s", F.lit(0), "n", run_rows=run_rows).orderBy("s").collect()]
    assert numbers == list(range(1, 5001))


def test_previous_values_over_the_whole_range(spark):
    rng = random.Random(9)
    far = [rng.randrange(-(2**63), 2**63) for _ in range(150)]
    for seqs in (far + [rng.randrange(2**63) for _ in range(150)], list(range(290)) + far[:10]):
        rows = [(s, rng.choice(["hot", "hot", "u1", "u2"]), rng.choice("AB")) for s in seqs]
        check(spark, [(3, "hot", "A", md5("A"))], rows, 20)


def test_nothing_to_number(spark):
    df = spark.createDataFrame([], "s bigint")
    assert number_rows(df, "s", F.lit(0), "n", run_rows=2).count() == 0
    nulls = spark.createDataFrame([(None,), (5,), (7,), (9,)], "s bigint")
    assert values(number_rows(nulls, "s", F.lit(0), "n", run_rows=1), "n") == [(1,), (2,), (3,), (4,)]


def test_commits_are_read_by_block(spark, folder):
    from pageloom.sinks import article_store

    store = ArticleStore(spark, folder, buckets=2)
    for version in (63, 64, 65):
        store._commit(article_store.Commit(version, f"b{version}", version, 2, {}))
    assert store.current().version == 65 and store._newest().count() == 2
