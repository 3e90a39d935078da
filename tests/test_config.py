"""Registry, keywords, rules and item files."""

import datetime
import json
import pathlib
import random
import warnings

import pytest

from helpers import values
from pageloom import fixed_values
from pageloom.operators import registry
from pageloom.schemas import LABELLED_ITEMS, SITES
from pageloom.sources import arrays
from pageloom.sources.items import read_items, read_labelled
from pageloom.sources.keywords import keyword_lists, read_keywords_yaml
from pageloom.sources.registry import seed_rows
from pageloom.sources.rules import default_rules, read_rules


def put(tmp_path, name, text):
    path = pathlib.Path(tmp_path) / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_seed_registry(spark):
    known = spark.createDataFrame([(40, "in.gr", "https://mine", None, False, 3)], SITES)
    sites = registry.insert_ignore(known, seed_rows(spark))
    rows = {r["domain"]: r for r in sites.collect()}
    assert len(rows) == 21 and rows["in.gr"]["start_url"] == "https://mine"
    assert rows["protothema.gr"]["site_id"] == 41 and rows["gazzetta.gr"]["site_id"] == 60
    again = registry.insert_ignore(sites, seed_rows(spark))
    assert again.count() == 21
    active = [r["domain"] for r in registry.active_sites(sites).collect()]
    assert len(active) == 20 and active[0] == "capital.gr" and active[-1] == "tovima.gr"


def test_visits(spark):
    old, now = datetime.datetime(2023, 1, 1), datetime.datetime(2024, 1, 1)
    sites = spark.createDataFrame(
        [(1, "a.gr", "u", old, True, 1), (2, "b.gr", "u", old, True, 1), (3, "c.gr", "u", None, True, 1)], SITES
    )
    visited = spark.createDataFrame([("a.gr",), ("a.gr",), ("z.gr",)], "domain string")
    assert values(registry.touch_visited(sites, visited, now), "domain", "last_visited") == [
        ("a.gr", now), ("b.gr", old), ("c.gr", None),
    ]


def test_keyword_file(spark, tmp_path):
    text = """
categories:
  sport: {keywords: [Goal, "ΓΚΌΛ"]}
  other: {}
general_category_keywords: [Category]
irrelevant_keywords: [PDF, "404"]
"""
    lists = keyword_lists(read_keywords_yaml(spark, put(tmp_path, "k.yml", text)))
    assert lists.category == ["category", "goal", "γκόλ"] and lists.irrelevant == ["404", "pdf"]
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        broken = "categories:\n  a: {keywords: [x]}\n  b: [1]\nirrelevant_keywords: [y]\n"
        lists = keyword_lists(read_keywords_yaml(spark, put(tmp_path, "b.yml", broken)))
        assert lists.category == [] and lists.irrelevant == [] and seen


def test_rule_file(spark, tmp_path):
    rules = [
        {"domain": "a.gr", "patterns": ["x"]},
        {"domain": "b.gr", "patterns": []},
        {"domain": "", "patterns": ["x"]},
        {"patterns": ["x"]},
        {"domain": "a.gr", "patterns": ["Ω+", None, "z"]},
        {"domain": "c.gr", "patterns": "no list"},
        {"domain": "d.gr", "patterns": [5, "x", {"p": "("}, ["y"], True]},
        {"domain": "e.gr", "patterns": [7]},
    ]
    found = read_rules(spark, put(tmp_path, "r.json", json.dumps(rules, indent=2)))
    assert values(found) == [("a.gr", ["Ω+", "z"]), ("d.gr", ["x"]), ("e.gr", [])]
    assert default_rules(spark).count() == len(fixed_values.SITE_RULES) == 4


def test_one_bad_rule_disables_all(spark, tmp_path):
    text = '[{"domain": "a.gr", "patterns": ["ok"]}, {"domain": "b.gr", "patterns": ["("]}]'
    with pytest.warns(UserWarning):
        assert read_rules(spark, put(tmp_path, "r.json", text)).count() == 0
    torn = '[{"domain": "a.gr", "patterns": ["ok"]}, {"domain": '
    assert read_rules(spark, put(tmp_path, "t.json", torn)).count() == 0


def test_item_files(spark, tmp_path):
    put(tmp_path, "raw_a.json", json.dumps([{"url": "u1", "title": "Ώρα", "image_urls": ["i"]}, {"url": "u2"}], ensure_ascii=False, indent=2))
    put(tmp_path, "raw_b.json", "[]")
    put(tmp_path, "notes.txt", "no json")
    found = read_items(spark, str(tmp_path), multi_line=True)
    assert values(found, "url", "title", "image_urls") == [("u1", "Ώρα", ["i"]), ("u2", None, None)]


def test_malformed_training_file_is_left_out(spark, tmp_path):
    put(tmp_path, "good.json", json.dumps([{"url": "u1", "label": "article"}, {"url": "u2"}]))
    put(tmp_path, "bad.json", '[{"url": "u3", "label": "article"}, {"url": ')
    put(tmp_path, "also.json", json.dumps([{"url": "u4", "label": "other"}]))
    good, bad = read_labelled(spark, str(tmp_path))
    assert values(good, "url", "label") == [("u1", "article"), ("u2", None), ("u4", "other")]
    assert [r["file"].rsplit("/", 1)[1] for r in bad.collect()] == ["bad.json"]
    assert good.schema == LABELLED_ITEMS


ITEM = LABELLED_ITEMS.__class__([f for f in LABELLED_ITEMS.fields if f.name in ("url", "title", "article_body", "text_length")])


def _arrays(tmp_path):
    rnd = random.Random(6)
    bits = ['"', "\\", "{", "}", "[", "]", ",", "\n", "é", "word ", "}{", '\\"', ":"]
    text = lambda: "".join(rnd.choice(bits) for _ in range(rnd.randrange(0, 120)))
    items = [{"url": f"u{i}", "title": text(), "article_body": text(), "text_length": i, "extra": {"a": [text(), {"b": {}}]}} for i in range(90)]
    items[7]["article_body"] = "}{" * 3000  # longer than several ranges
    good = {"line": json.dumps(items), "pretty": json.dumps(items, indent=2, ensure_ascii=False), "empty": " [ ] \n", "one": json.dumps(items[:1])}
    bad = {
        "cut": json.dumps(items)[:9000], "no_end": json.dumps(items)[:-1], "no_comma": "[{\"url\": \"a\"} {\"url\": \"b\"}]",
        "spoiled": json.dumps(items).replace('"text_length": 50,', '"text_length": 50'), "words": "not json",
    }
    for name, content in (good | bad).items():
        put(tmp_path, f"{name}.json", content)
    return len(items), set(bad)


@pytest.mark.parametrize("size", [2000, 10**8])
def test_array_files_are_split(spark, tmp_path, size):
    """Files of many ranges give what the reader of whole files gives, and mistakes leave out whole files."""
    n, bad = _arrays(tmp_path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows, rejects = arrays.read_arrays(spark, str(tmp_path), ITEM)
        whole, left_out = read_labelled(spark, str(tmp_path), ITEM)
        assert values(rows) == values(whole) and rows.count() == 2 * n + 1
        named = {pathlib.Path(r["file"]).stem for r in rejects.collect()}
        assert named == bad == {pathlib.Path(r["file"]).stem for r in left_out.collect()}
        if size < 10**6:
            pieces = spark.read.option("lineSep", "}").text(str(tmp_path / "pretty.json"))
            assert pieces.rdd.getNumPartitions() > 10
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
