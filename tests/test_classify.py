"""Classifier: checks, fit on separable data, reports."""

import random

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helpers import values
from pageloom.fixed_values import FEATURES
from pageloom.operators import classify as C
from pageloom.operators import features, forest
from pageloom.plans.training import train
from pageloom.schemas import EmptyInput, MissingColumns
from pageloom.sinks.models import load_model, save_model

SMALL = C.ForestSettings(num_trees=12, max_depth=6)
TYPES = {"has_date_pattern_in_url": "boolean", "is_article_in_category": "boolean"}
SCHEMA = "url string, label string, " + ", ".join(f"{f} {TYPES.get(f, 'double')}" for f in FEATURES)


def rows(spark, n=240):
    rng = random.Random(5)
    out = []
    for i in range(n):
        label = ["article", "category", "other"][i % 3]
        size = {"article": 3000, "category": 300, "other": 20}[label] * rng.uniform(0.8, 1.2)
        features = {f: rng.random() for f in FEATURES}
        features.update(text_length=size, has_date_pattern_in_url=None, is_article_in_category=label == "article")
        out.append((f"https://a.gr/{i}", label, *[features[f] for f in FEATURES]))
    return spark.createDataFrame(out, SCHEMA)


def test_input_checks(spark):
    df = rows(spark, 9)
    with pytest.raises(MissingColumns):
        C.check_training_rows(df.drop("label"))
    with pytest.raises(MissingColumns, match="url_depth"):
        C.check_training_rows(df.drop("url_depth"))
    with pytest.raises(EmptyInput):
        C.check_training_rows(df.selectExpr("* except (label)", "cast(null as string) as label"))


def test_training_and_round_trip(spark, folder):
    df = rows(spark)
    result = train(df, SMALL)
    lines = {r["class"]: r for r in result.report.collect()}
    assert lines["accuracy"]["f1_score"] > 0.95 and lines["article"]["precision"] > 0.95
    save_model(spark, result.model, folder)
    loaded = load_model(spark, folder)
    first = values(C.predict(result.model, df), "url", "predicted_label")
    assert first == values(C.predict(loaded, df), "url", "predicted_label")
    assert {label for _, label in first} == {"article", "category", "other"}
    # Unlabelled items with absent features can be scored, and keep their columns.
    bare = df.select("url", "text_length")
    scored = C.predict(loaded, bare)
    assert scored.columns == ["url", "text_length", "predicted_label"] and scored.count() == 240


def test_reports(spark):
    pairs = [("a", "a")] * 3 + [("a", "b")] + [("b", "b")] * 2 + [("c", "a")]
    df = spark.createDataFrame(pairs, "label string, predicted_label string")
    report = {r["class"]: r for r in C.classification_report(df).collect()}
    assert report["a"]["precision"] == 0.75 and report["a"]["recall"] == 0.75
    assert report["c"]["precision"] == 0.0 and report["c"]["f1_score"] == 0.0
    assert report["accuracy"]["recall"] == 5 / 7
    assert report["macro avg"]["recall"] == pytest.approx((0.75 + 1 + 0) / 3)
    assert report["weighted avg"]["recall"] == pytest.approx(5 / 7)
    assert [tuple(r) for r in C.confusion_matrix(df).collect()] == [
        ("a", 3, 1, 0), ("b", 0, 2, 0), ("c", 1, 0, 0),
    ]
    assert C.classification_report(df.limit(0)).count() == 0


def test_split_is_stable(spark):
    df = rows(spark)
    parts = [values(C.split_rows(df.repartition(n))[1], "url") for n in (1, 5)]
    assert parts[0] == parts[1] and 30 < len(parts[0]) < 90


def test_missing_labels_and_urls(spark):
    pairs = [("a", "a"), (None, "a"), ("a", None), ("b", "b")]
    df = spark.createDataFrame(pairs, "label string, predicted_label string")
    assert [tuple(r) for r in C.confusion_matrix(df).collect()] == [
        (C.NO_CLASS, 0, 1, 0), ("a", 1, 1, 0), ("b", 0, 0, 1),
    ]
    bare = spark.createDataFrame([(None, "a"), ("u", "a")], "url string, label string")
    assert sum(part.count() for part in C.split_rows(bare)) == 2


def _walk_in_sql(nodes, labels, items):
    """Labels by another engine from the same table of nodes."""
    con = duckdb.connect()
    for name, df in (("nodes", nodes), ("labels", labels), ("items", items)):
        con.register(name, pa.Table.from_batches(df.toArrow().to_batches()))
    return sorted(
        con.execute(
            """
            WITH RECURSIVE walk AS (
                SELECT url, tree, 0 AS node, vals, 0 AS depth FROM items, (SELECT DISTINCT tree FROM nodes) AS t
                UNION ALL
                SELECT w.url, w.tree, CASE WHEN w.vals[n.feature + 1] <= n.threshold THEN n."left" ELSE n."right" END, w.vals, w.depth + 1
                FROM walk AS w JOIN nodes AS n ON w.tree = n.tree AND w.node = n.node WHERE n.feature IS NOT NULL),
            votes AS (
                SELECT w.url, l.label, l.index, list(n.counts[l.index + 1] / list_sum(n.counts) ORDER BY w.tree) AS shares
                FROM walk AS w JOIN nodes AS n ON w.tree = n.tree AND w.node = n.node AND n.feature IS NULL, labels AS l
                GROUP BY ALL),
            summed AS (SELECT url, label, index, list_reduce(shares, lambda a, b: a + b) AS score FROM votes)
            SELECT url, arg_max(label, (score, -index)) FROM summed GROUP BY url"""
        ).fetchall()
    )


def test_forest_as_a_table(spark, folder):
    """A whole forest on labels that tell little: the model, the walk by joins and a walk in SQL agree on every row."""
    rng = random.Random(8)
    noisy = [
        (f"https://a.gr/{i}", rng.choice(["article", "category", "other"]), *[rng.random() < 0.5 if f in TYPES else float(rng.randrange(12)) for f in FEATURES])
        for i in range(300)
    ]
    df = spark.createDataFrame(noisy, SCHEMA).repartition(3)
    model = C.fit_forest(df)
    save_model(spark, model, folder)
    nodes, labels = forest.read_nodes(spark, folder), forest.read_labels(spark, folder)
    assert nodes.select("tree").distinct().count() == C.ForestSettings().num_trees
    assert nodes.count() == model.stages[2].totalNumNodes
    expected = values(C.predict(model, df), "url", "predicted_label")
    assert values(forest.walked_labels(nodes, labels, df, ["url"]), "url", "predicted_label") == expected
    items = df.select("url", F.array(*features.aligned_features(df)).alias("vals"))
    assert _walk_in_sql(nodes, labels, items) == expected
    weights = {r["feature"]: r["weight"] for r in forest.feature_weights(nodes).collect()}
    known = model.stages[2].featureImportances.toArray()
    assert [weights.get(f, 0.0) for f in FEATURES] == pytest.approx(list(known), abs=1e-9)


def test_walk_of_odd_rows(spark, folder):
    df = rows(spark, 60)
    save_model(spark, C.fit_forest(df, SMALL), folder)
    nodes, labels = forest.read_nodes(spark, folder), forest.read_labels(spark, folder)
    bare = spark.createDataFrame([("x", None), (None, 5.0)], "url string, text_length double")
    expected = values(C.predict(load_model(spark, folder), bare), "url", "predicted_label")
    assert values(forest.walked_labels(nodes, labels, bare, ["url"])) == expected
    assert forest.walked_labels(nodes, labels, bare.limit(0), ["url"]).count() == 0
    assert forest.walk(nodes, bare, ["url"]).count() == 2 * SMALL.num_trees
