"""Reports, streaming against batch, and the shape of the plans."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks.base import table
from helpers import values
from pageloom.operators import reports
from pageloom.operators.changes import change_log
from pageloom.functions import urls as U
from pageloom.operators.frontier import build_frontier
from pageloom.plans.page_flow import fetched_items, parse_for_run
from pageloom.plans.scoring import model_labeller, rule_labeller, store_articles
from pageloom.sinks.article_store import ArticleStore
from pageloom.sources.pages import stream_pages
from pageloom.streaming.page_stream import start_page_stream

SF_DIR = "/root/testdata/sf0.001"
NOW = datetime.datetime(2024, 2, 1)


def test_reports_on_empty_and_silent_sites(spark):
    sites = spark.createDataFrame([("a.gr",), ("b.gr",)], "domain string")
    items = spark.createDataFrame([("a.gr",)] * 4 + [("x.gr",)], "site_domain string")
    changes = spark.createDataFrame([("a.gr", "NEW"), ("a.gr", "UNCHANGED"), ("a.gr", "NEW")], "domain string, status string")
    stats = reports.run_stats(reports.pages_per_site(sites, items), reports.status_counts(changes))
    assert values(stats, "domain", "total_pages", "predicted_articles", "filtering_pct", "status") == [
        ("a.gr", 4, 3, 25.0, "SUCCESS"), ("b.gr", 0, 0, 0.0, "FAILED"),
    ]
    summary = reports.run_summary(stats)
    total = summary.where("is_total").first()
    assert (total["total_pages"], total["predicted_articles"], total["filtering_pct"]) == (4, 3, 25.0)
    efficiency = reports.storage_efficiency(stats)
    assert values(efficiency, "status", "operations", "pct") == [
        ("NEW", 2, 2 / 3 * 100), ("UNCHANGED", 1, 1 / 3 * 100), ("UPDATED", 0, 0.0),
    ]
    none = reports.storage_efficiency(stats.limit(0))
    assert values(none, "status", "operations", "pct") == [
        ("NEW", 0, 0.0), ("UNCHANGED", 0, 0.0), ("UPDATED", 0, 0.0),
    ]


def test_stream_equals_batch(spark, folder):
    """Pages in several files, one micro-batch each; then another stream, with more pages."""
    pages = table(spark, SF_DIR, "pages")
    pages.repartition(3, "page_id").write.parquet(f"{folder}/in")
    from checks.base import fixture

    sites = fixture(spark, SF_DIR, "fx_sites")
    streamed = ArticleStore(spark, f"{folder}/streamed", buckets=4)

    links = build_frontier(fixture(spark, SF_DIR, "fx_pages"), sites, ["/en/"], ["zz"])
    asked = pages.select(F.col("url").alias("u")).withColumn("full_url", U.canonical_url(F.col("u")))
    found = asked.select("full_url", U.frontier_host(F.col("u")).alias("site_domain"), F.lit(True).alias("is_category_link"), F.lit("a").alias("source_xpath"))
    links = links.select(*found.columns).unionByName(found.where("full_url LIKE '%7%'")).dropDuplicates(["full_url", "site_domain"])

    def run(name, source="in"):
        start_page_stream(
            stream_pages(spark, f"{folder}/{source}", files_per_batch=1), sites, None, rule_labeller,
            streamed, f"{folder}/raw", f"{folder}/{name}", NOW, links,
        ).awaitTermination()

    run("checkpoint")
    version = streamed.current().version
    assert version == 3
    batch = ArticleStore(spark, f"{folder}/batch", buckets=4)
    items = fetched_items(pages, None, links, sites.where("active")).withColumnRenamed("page_id", "ingest_seq")
    assert items.where("is_category_link").count() > 0
    store_articles(batch, rule_labeller(items), sites, NOW)
    columns = ["url", "site_id", "title", "body", "image_url", "content_hash"]
    assert values(streamed.read(), *columns) == values(batch.read(), *columns)
    run("checkpoint")
    assert streamed.current().version == version
    raw = spark.read.parquet(f"{folder}/raw")
    assert raw.where("is_category_link").count() == items.where("is_category_link").count()
    assert {"stream", "batch", "site_folder", "site_domain"} <= set(raw.columns)
    one = pages.join(streamed.read().select("url"), "url").limit(1).withColumn("page_id", F.lit(10**6))
    one.select("page_id", F.concat("url", F.lit("x1")).alias("url"), "html").write.parquet(f"{folder}/more")
    before = streamed.read().count()
    run("new-checkpoint", "more")
    assert streamed.current().version == version + 1 and streamed.read().count() == before + 1


def test_repeats_are_parsed_once_and_forgotten(spark, folder):
    """Pages that come again within a day are passed over; after that the state has let them go."""
    import os
    import pathlib

    root = pathlib.Path(folder.removeprefix("file://"), "in")
    pages = table(spark, SF_DIR, "pages").orderBy("page_id").limit(20)
    changed = pages.where("page_id < 3").withColumn("html", F.concat("html", F.lit("<p>more</p>")))
    start = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc).timestamp()
    for n, (days, df) in enumerate([(0, pages), (0.5, pages), (0.6, changed), (9, pages.where("page_id < 2")), (20, pages), (40, pages)]):
        df.coalesce(1).write.parquet(f"{folder}/out{n}")
        (part,) = pathlib.Path(folder.removeprefix("file://"), f"out{n}").glob("*.parquet")
        root.mkdir(exist_ok=True)
        part.rename(root / f"{n}.parquet")
        os.utime(root / f"{n}.parquet", (start + days * 86400,) * 2)
    from checks.base import fixture

    sites = fixture(spark, SF_DIR, "fx_sites").withColumn("active", F.lit(True))
    stream = start_page_stream(
        stream_pages(spark, str(root), files_per_batch=1, arrivals=True), sites, None, rule_labeller,
        ArticleStore(spark, f"{folder}/store", buckets=2), f"{folder}/raw", f"{folder}/checkpoint", NOW, None, "1 day",
    )
    stream.awaitTermination()
    parsed = values(spark.read.parquet(f"{folder}/raw").groupBy("batch").count(), "batch", "count")
    # What is older than the watermark goes at the end of the batch that moves it
    assert parsed == [(0, 20), (2, 3), (5, 20)]
    held = [p["stateOperators"][0]["numRowsTotal"] for p in stream.recentProgress if p["stateOperators"]]
    assert max(held) <= 23 and held[-1] <= 20


def test_model_labels_a_stream(spark, folder):
    """The trained model serves as labeller on streamed pages; a class of all pages stores them."""
    from checks.base import fixture
    from pageloom.operators import classify as C
    from pageloom.operators.features import add_path_features

    pages = table(spark, SF_DIR, "pages")
    items = fetched_items(pages)
    labelled = add_path_features(items).withColumn(
        "label", F.when(F.col("text_length") > 0, "Article").otherwise("other")
    )
    model = C.fit_forest(labelled, C.ForestSettings(num_trees=3, max_depth=3))
    sites = fixture(spark, SF_DIR, "fx_sites").withColumn("active", F.lit(True))
    store = ArticleStore(spark, f"{folder}/store", buckets=2)
    start_page_stream(
        stream_pages(spark, SF_DIR, "pages.parquet"), sites, None, model_labeller(model), store,
        f"{folder}/raw", f"{folder}/checkpoint", NOW,
    ).awaitTermination()
    raw = spark.read.parquet(f"{folder}/raw")
    assert raw.count() == pages.count()
    assert {r[0] for r in raw.select("predicted_label").distinct().collect()} <= {"Article", "other"}
    assert store.read().count() > 0


FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"]


@pytest.mark.parametrize("name", ["f8_align_features", "l13_link_provenance", "d8_upsert", "d10_integrity", "noise_summary", "r4_run_summary"])
def test_plans_stay_in_the_jvm_and_join_by_key(spark, name):
    plan = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in FORBIDDEN if word in plan]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_read_columns_are_scanned(spark):
    plan = plan_of(entry.queries()["l12_category_flag"](spark, SF_DIR))
    assert "html" not in re.search(r"ReadSchema: (.*)", plan).group(1)


def test_extraction_does_not_shuffle(spark):
    pages = table(spark, SF_DIR, "pages")
    plan = plan_of(fetched_items(pages))
    assert "Exchange" not in plan


def exchanged_columns(df, capsys):
    """Input columns of every exchange in the plan."""
    capsys.readouterr()
    df.explain("formatted")
    text = capsys.readouterr().out
    return re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", text)


def test_change_detection_shuffles_no_body(spark, folder, capsys):
    from checks.q_state import batch
    from checks.base import fixture

    batch(spark, SF_DIR).write.parquet(f"{folder}/batch")
    fixture(spark, SF_DIR, "fx_state").write.parquet(f"{folder}/state")
    log = change_log(spark.read.parquet(f"{folder}/batch"), spark.read.parquet(f"{folder}/state"))
    inputs = exchanged_columns(log, capsys)
    assert inputs and not [i for i in inputs if "body" in i or "title" in i]


def test_frontier_shuffles_no_html(spark, folder, capsys):
    from checks.base import fixture

    table(spark, SF_DIR, "pages").write.parquet(f"{folder}/pages")
    fixture(spark, SF_DIR, "fx_sites").write.parquet(f"{folder}/sites")
    sites = spark.read.parquet(f"{folder}/sites")
    links = build_frontier(spark.read.parquet(f"{folder}/pages"), sites, ["x"], ["y"])
    inputs = exchanged_columns(links, capsys)
    assert inputs and not [i for i in inputs if "html" in i]


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_html_is_shuffled_without_broadcasts(spark, folder, capsys, no_broadcast):
    """Rules and registry too large to broadcast: only what was read from the html moves."""
    from checks.base import fixture
    from checks.q_frontier import lists
    from checks.q_pages import rules
    from pageloom.plans.page_flow import parse_for_run, run_items, run_links

    pages, sites = table(spark, SF_DIR, "pages"), fixture(spark, SF_DIR, "fx_sites")
    parsed = parse_for_run(pages, True)
    links = run_links(parsed, sites, lists(spark))
    for df in (links, run_items(parsed, sites, rules(spark, SF_DIR), links), fetched_items(pages, rules(spark, SF_DIR), links, sites)):
        inputs = exchanged_columns(df, capsys)
        assert inputs and not [i for i in inputs if "article_body" in i and "html#" in i]


def test_bodies_move_once_without_broadcasts(spark, folder, capsys, no_broadcast):
    """Site, rules and provenance are found by narrow columns, so texts are in one exchange at most."""
    from checks.base import fixture
    from checks.q_frontier import lists
    from checks.q_pages import rules
    from pageloom.plans.page_flow import items_of, parse_for_run, run_items, run_links

    sites, own_rules = fixture(spark, SF_DIR, "fx_sites"), rules(spark, SF_DIR)
    parse_for_run(fixture(spark, SF_DIR, "fx_linked"), True).write.parquet(f"{folder}/parsed")
    parsed = spark.read.parquet(f"{folder}/parsed")
    run_links(parsed, sites, lists(spark)).write.parquet(f"{folder}/links")
    links = spark.read.parquet(f"{folder}/links")
    items = run_items(parsed, sites, own_rules, links)
    moved = [i for i in exchanged_columns(items, capsys) if "article_body" in i]
    assert len(moved) == 1
    # Pages that come twice, and pages without id and URL, are looked up like others
    odd = parsed.limit(2).withColumns({"page_id": F.lit(None).cast("bigint"), "url": F.lit(None).cast("string")})
    twice = parsed.unionByName(parsed).unionByName(odd)
    assert items_of(twice, own_rules, links, sites).count() == 2 * items.count()
    assert items_of(twice, own_rules, links).count() == 2 * parsed.count() + 2


def test_full_run_without_pages_of_its_sites(spark, folder):
    from checks.q_frontier import lists
    from pageloom.plans import full_run
    from pageloom.schemas import SITES

    sites = spark.createDataFrame([(1, "none.gr", "https://none.gr", None, True, 1)], SITES)
    result = full_run.run(
        spark, table(spark, SF_DIR, "pages"), sites, lists(spark), None, rule_labeller,
        ArticleStore(spark, f"{folder}/store", buckets=2), f"{folder}/out", "r", NOW,
    )
    assert values(result.stats, "domain", "total_pages", "status") == [("none.gr", 0, "FAILED")]
    assert [r["last_visited"] for r in result.sites.collect()] == [NOW] and result.frontier.count() == 0


def test_second_run_finds_no_visited_links(spark, folder):
    from checks.base import fixture
    from checks.q_frontier import lists
    from pageloom.plans import full_run
    from pageloom.sinks.visited import VisitedSet

    pages, sites = fixture(spark, SF_DIR, "fx_linked"), fixture(spark, SF_DIR, "fx_sites")
    store, counts = ArticleStore(spark, f"{folder}/store", buckets=2), []
    for run_id, part in (("one", "page_id % 2 = 0"), ("two", "page_id % 2 = 0"), ("three", "page_id >= 0")):
        visited = VisitedSet(spark, f"{folder}/visited", cells=4)
        result = full_run.run(spark, pages.where(part), sites, lists(spark), None, rule_labeller, store, f"{folder}/{run_id}", run_id, NOW, visited)
        counts.append(result.frontier.count())
    every = full_run.run(spark, pages, sites, lists(spark), None, rule_labeller, store, f"{folder}/four", "four", NOW).frontier.count()
    assert counts[0] > 0 == counts[1] and counts[0] + counts[2] == every


def test_sites_that_share_a_host_own_a_page_once(spark, folder):
    from pageloom.schemas import SITES

    sites = spark.createDataFrame([(1, "a.gr", "https://a.gr", None, True, 5), (2, "www.a.gr", "https://www.a.gr", None, True, 9)], SITES)
    page = "<html><body><article><p>" + "Some words to keep. " * 20 + "</p></article></body></html>"
    pages = spark.createDataFrame([(1, "https://a.gr/x", page)], "page_id bigint, url string, html string")
    assert values(fetched_items(pages, sites=sites), "url", "site_domain") == [("https://a.gr/x", "a.gr")]


def test_unchanged_batch_moves_and_writes_no_text(spark, folder, capsys):
    from checks.q_state import batch, src_sites
    from pageloom.operators.changes import number_new, upsert_keys, url_outcomes

    store, rows, known = ArticleStore(spark, folder, buckets=4), batch(spark, SF_DIR), src_sites(spark, SF_DIR)
    store.apply(rows, known, NOW, "one")
    last = rows.groupBy("url").agg(F.max("ingest_seq").alias("ingest_seq"))
    store.apply(rows.join(last, ["url", "ingest_seq"]).select(*rows.columns), known, NOW, "two")
    version = store.current().version
    assert spark.read.parquet(f"{folder}/contents/content_version={version}").count() == 0
    keys = store._keys(store.current())
    log = change_log(rows, keys)
    merged = upsert_keys(keys, number_new(url_outcomes(log), F.lit(0), ranged=rows), NOW, 9)
    assert not [i for i in exchanged_columns(merged, capsys) if "body" in i]


def test_training_and_scoring_from_files(spark, folder):
    from checks.base import fixture
    from checks.q_classify import labelled
    from checks.q_state import src_sites
    from pageloom.operators import classify as C
    from pageloom.plans.scoring import score_files
    from pageloom.plans.training import train_from_files
    from pageloom.sinks.items import write_items

    rows = labelled(spark, SF_DIR).withColumn("site_domain", U.frontier_host(F.col("url")))
    rows.groupBy().agg(F.to_json(F.collect_list(F.struct(*rows.columns))).alias("value")).coalesce(1).write.text(f"{folder}/labelled")
    import pathlib

    for path in pathlib.Path(folder.removeprefix("file://"), "labelled").glob("*.txt"):
        path.rename(path.with_suffix(".json"))
    result = train_from_files(spark, f"{folder}/labelled", f"{folder}/model", C.ForestSettings(num_trees=3, max_depth=4))
    assert result.report.count() >= 5
    write_items(rows.drop("label"), f"{folder}/items")
    store = ArticleStore(spark, f"{folder}/store", buckets=2)
    changes = score_files(spark, f"{folder}/items", f"{folder}/model", f"{folder}/predictions", store, src_sites(spark, SF_DIR), NOW, "s")
    predicted = spark.read.parquet(f"{folder}/predictions")
    assert predicted.count() == rows.count() and "predicted_label" in predicted.columns
    assert store.read().count() == changes.where("status = 'NEW'").count()


def test_html_of_a_run_is_made_plain_once(spark):
    """Links, texts and metadata share one visible markup; the fallback text has its own."""
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    for any_rules in (True, False):
        plan = parse_for_run(pages, any_rules)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("!--.*?--") == 2


def test_files_of_a_stream_grow_with_its_pages(spark, folder, monkeypatch):
    from checks import q_flows

    rows = [(i, f"https://a{i % 3}.org/{i}", f"<article><p>Text {i}</p></article>") for i in range(300)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    asked = []

    def stream(spark, path, files_per_batch, arrivals):
        asked.append((files_per_batch, len(spark.read.parquet(path).inputFiles())))
        raise InterruptedError

    monkeypatch.setattr(q_flows, "stream_pages", stream)
    monkeypatch.setattr(q_flows, "_FILE_PAGES", 10)
    for repeats in (False, True):
        with pytest.raises(InterruptedError):
            q_flows._streamed(spark, folder, repeats)
    assert asked == [(10, 30), (10, 40)]


def test_a_micro_batch_of_repeats_ends_early(spark, folder):
    """Later pages are still numbered and stored; a batch without new pages makes no version of the store."""
    import os
    import pathlib

    rows = [(i, f"https://a.gr/{i}", f"<article><p>Text {i}</p></article>") for i in range(50)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    for n, last in enumerate((40, 40, 50)):
        pages.where(F.col("page_id") < last).coalesce(1).write.parquet(f"{folder}/in/n={n}")
        (part,) = pathlib.Path(folder.removeprefix("file://"), f"in/n={n}").glob("*.parquet")
        os.utime(part, (1.7e9 + n, 1.7e9 + n))
    sites = spark.createDataFrame([(1, "a.gr", "https://a.gr", None, True, 1)], "site_id bigint, domain string, start_url string, last_visited timestamp, active boolean, priority int")
    links = spark.createDataFrame([], "full_url string, site_domain string, is_category_link boolean, source_xpath string")
    everything = lambda items: rule_labeller(items).withColumn("predicted_label", F.lit("article"))
    store = ArticleStore(spark, f"{folder}/store", buckets=2)
    stream = start_page_stream(
        stream_pages(spark, f"{folder}/in/*", files_per_batch=1, arrivals=True), sites, None, everything, store,
        f"{folder}/raw", f"{folder}/checkpoint", NOW, links, "1 day",
    )
    stream.awaitTermination()
    assert values(spark.read.parquet(f"{folder}/raw").groupBy("batch").count(), "batch", "count") == [(0, 40), (2, 10)]
    assert store.current().version == 2 and store.read().count() == 50
