"""Queries of the classifier."""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import sqlgen as S
from checks.base import fixture, query
from pageloom.operators import classify as C
from pageloom.operators import features, forest
from pageloom.session import scratch_path
from pageloom.sinks.models import load_model, save_model

SETTINGS = C.ForestSettings()


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled items with all features, spread over the cores for the many passes of a fit."""
    df = fixture(spark, sf, "fx_labelled")
    return features.add_path_features(features.page_items(df))


@query("m2_labelled_rows", "SELECT url, label FROM fx_labelled WHERE label IS NOT NULL")
def m2(spark, sf):
    return C.labelled_rows(fixture(spark, sf, "fx_labelled")).select("url", "label")


@query(
    "m3_fill_features",
    f"""SELECT url, CASE WHEN doc_id % 4 = 0 THEN 0 ELSE length(title) END::BIGINT AS title_length,
               CASE WHEN doc_id % 5 = 0 THEN 0 ELSE {S.density('article_body')} END::DOUBLE AS text_density,
               CASE WHEN doc_id % 3 = 0 THEN false
                    ELSE regexp_matches(url, '/[0-9]{{4}}/[0-9]{{2}}/[0-9]{{2}}/') END
                   AS has_date_pattern_in_url
        FROM fx_labelled""",
)
def m3(spark, sf):
    doc = F.col("doc_id")
    gaps = labelled(spark, sf).withColumns(
        {
            "title_length": F.when(doc % 4 != 0, F.col("title_length")),
            "text_density": F.when(doc % 5 != 0, F.col("text_density")),
            "has_date_pattern_in_url": F.when(doc % 3 != 0, F.col("has_date_pattern_in_url")),
        }
    )
    return C.fill_missing_features(gaps).select(
        "url", F.col("title_length").cast("bigint"), "text_density", "has_date_pattern_in_url"
    )


@query(
    "m4_encode_labels",
    """SELECT url, (dense_rank() OVER (ORDER BY label) - 1)::DOUBLE AS label_index
       FROM fx_labelled WHERE label IS NOT NULL""",
)
def m4(spark, sf):
    rows = C.labelled_rows(fixture(spark, sf, "fx_labelled"))
    return C.encode_labels(rows).select("url", "label_index")


@query(
    "m5_split_rows",
    """SELECT url, CASE WHEN substr(md5(url), 1, 1) IN ('0', '1', '2', '3')
                        THEN 'test' ELSE 'train' END AS part
       FROM fx_labelled WHERE label IS NOT NULL""",
)
def m5(spark, sf):
    rows = C.labelled_rows(fixture(spark, sf, "fx_labelled")).select("url")
    train, test = C.split_rows(rows)
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


@query("m6_fit_forest")
def m6(spark, sf):
    """Weight of each feature in a forest fitted on the training part."""
    train, _ = C.split_rows(C.fill_missing_features(C.check_training_rows(labelled(spark, sf))))
    forest = C.fit_forest(train, SETTINGS).stages[2]
    rows = [(f, float(w)) for f, w in zip(C.FEATURES, forest.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double")


_CELLS = "SELECT label, predicted_label, count(*) AS n FROM fx_predicted GROUP BY ALL"
_PER_CLASS = f"""
    SELECT class, CASE WHEN predicted > 0 THEN hits / predicted ELSE 0.0::DOUBLE END AS precision,
           CASE WHEN actual > 0 THEN hits / actual ELSE 0.0::DOUBLE END AS recall, actual, hits
    FROM (SELECT class,
                 (SELECT coalesce(sum(n), 0) FROM cells WHERE label = class) AS actual,
                 (SELECT coalesce(sum(n), 0) FROM cells WHERE predicted_label = class) AS predicted,
                 (SELECT coalesce(sum(n), 0) FROM cells WHERE predicted_label = class
                                                          AND label = class) AS hits
          FROM (SELECT label AS class FROM cells UNION SELECT predicted_label FROM cells) AS k) AS s
"""
_REPORT = f"""
    WITH cells AS ({_CELLS}),
    scored AS (SELECT *, CASE WHEN precision + recall > 0
                              THEN 2 * precision * recall / (precision + recall)
                              ELSE 0.0::DOUBLE END AS f1_score FROM ({_PER_CLASS}) AS p)
    SELECT class, precision, recall, f1_score, actual AS support FROM scored
    UNION ALL
    SELECT 'accuracy', sum(hits) / sum(actual), sum(hits) / sum(actual), sum(hits) / sum(actual),
           sum(actual) FROM scored
    UNION ALL
    SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), sum(actual) FROM scored
    UNION ALL
    SELECT 'weighted avg', sum(precision * actual) / sum(actual),
           sum(recall * actual) / sum(actual), sum(f1_score * actual) / sum(actual), sum(actual)
    FROM scored
"""
_DIGITS = ", ".join(f"round({c}, 9) AS {c}" for c in ("precision", "recall", "f1_score"))


@query(
    "m7_classification_report",
    f"SELECT class, {_DIGITS}, support::BIGINT AS support FROM ({_REPORT}) AS r",
)
def m7(spark, sf):
    report = C.classification_report(fixture(spark, sf, "fx_predicted"))
    return report.select(
        "class",
        *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1_score")],
        F.col("support").cast("bigint"),
    )


@query(
    "m8_confusion_matrix",
    """SELECT label, count_if(predicted_label = 'article')::BIGINT AS article,
              count_if(predicted_label = 'category')::BIGINT AS category,
              count_if(predicted_label = 'other')::BIGINT AS other
       FROM fx_predicted GROUP BY label""",
)
def m8(spark, sf):
    return C.confusion_matrix(fixture(spark, sf, "fx_predicted"))


@query("m9_predict_labels")
def m9(spark, sf):
    """Predicted labels of all items by a forest fitted on the labelled ones."""
    items = labelled(spark, sf)
    train, _ = C.split_rows(C.fill_missing_features(C.check_training_rows(items)))
    return C.predict(C.fit_forest(train, SETTINGS), items).select("url", "predicted_label")


@query("k6_model_round_trip")
def k6(spark, sf):
    """Predictions of a saved and reloaded model."""
    items = labelled(spark, sf)
    train, _ = C.split_rows(C.fill_missing_features(C.check_training_rows(items)))
    path = scratch_path(spark, "model")
    save_model(spark, C.fit_forest(train, SETTINGS), path)
    return C.predict(load_model(spark, path), items).select("url", "predicted_label")


@query(
    "m1_input_checks",
    """SELECT doc_id, CASE WHEN doc_id % 7 = 0 OR label IS NULL THEN 'missing_label'
                           WHEN doc_id % 11 = 0 THEN 'missing_url' ELSE '' END AS reject_reason
       FROM fx_labelled""",
)
def m1(spark, sf):
    """Training rows with the reason why they cannot be used as they are."""
    doc = F.col("doc_id")
    gaps = fixture(spark, sf, "fx_labelled").withColumns(
        {
            "label": F.when(doc % 7 != 0, F.col("label")),
            "url": F.when(doc % 11 != 0, F.col("url")),
        }
    )
    checked = C.check_rows(gaps)
    return checked.select("doc_id", F.coalesce("reject_reason", F.lit("")).alias("reject_reason"))


_FEATURE_ROWS = ", ".join(
    f"('{name}')"
    for name in [
        "url_length", "url_depth", "title_length", "text_length", "text_density", "has_date_pattern_in_url",
        "xpath_depth", "xpath_contains_article", "xpath_contains_main_content", "xpath_contains_story", "is_article_in_category",
    ]
)


def _saved(spark: SparkSession, train: DataFrame) -> tuple[PipelineModel, str]:
    """A forest with the production settings, and where it is saved."""
    model, path = C.fit_forest(train, SETTINGS), scratch_path(spark, "model")
    save_model(spark, model, path)
    return model, path


@query(
    "m6_forest_weights",
    f"SELECT feature, 1.0::DOUBLE AS total, true AS usable, true AS from_nodes FROM (VALUES {_FEATURE_ROWS}) AS f(feature)",
)
def m6_weights(spark, sf):
    """The forest weighs every feature of the list, none below zero, one in total; its table of nodes gives the same."""
    train, _ = C.split_rows(C.fill_missing_features(C.check_training_rows(labelled(spark, sf))))
    model, path = _saved(spark, train)
    weights = model.stages[2].featureImportances.toArray()
    rows = [(f, round(float(weights.sum()), 6), float(w)) for f, w in zip(C.FEATURES, weights)]
    known = spark.createDataFrame(rows, "feature string, total double, known double")
    both = known.join(forest.feature_weights(forest.read_nodes(spark, path)), "feature", "left")
    difference = F.abs(F.col("known") - F.coalesce("weight", F.lit(0.0)))
    return both.select("feature", "total", F.col("known").between(0, 1).alias("usable"), (difference < 1e-9).alias("from_nodes"))


_CLASS = "CASE doc_id % 3 WHEN 0 THEN 'article' WHEN 1 THEN 'category' ELSE 'other' END"


def _separable(spark: SparkSession, sf: str) -> DataFrame:
    """Items whose class can be read off one feature."""
    items = labelled(spark, sf).withColumn("label", F.expr(_CLASS))
    size = F.when(F.col("label") == "article", 3000).when(F.col("label") == "category", 300).otherwise(20)
    return items.withColumn("text_length", size).withColumn("text_density", size.cast("double"))


@query("m9_separable_labels", f"SELECT url, {_CLASS} AS predicted_label FROM fx_labelled")
def m9_separable(spark, sf):
    """Labels of all items by a forest fitted on three quarters of a table that can be told apart."""
    items = _separable(spark, sf)
    train, _ = C.split_rows(items)
    return C.predict(C.fit_forest(train, SETTINGS), items).select("url", "predicted_label")


@query("m9_walked_labels", f"SELECT url, {_CLASS} AS predicted_label FROM fx_labelled")
def m9_walked(spark, sf):
    """The same labels by a walk of all trees as a table of nodes."""
    items = _separable(spark, sf)
    _, path = _saved(spark, C.split_rows(items)[0])
    return forest.walked_labels(forest.read_nodes(spark, path), forest.read_labels(spark, path), items, ["url"])


@query("k6_same_labels", "SELECT url, true AS same, true AS walked FROM fx_labelled")
def k6_same(spark, sf):
    """A saved model gives each item the label that it gave before, when it is loaded and when its nodes are walked."""
    items = labelled(spark, sf)
    model, path = _saved(spark, C.split_rows(C.fill_missing_features(C.check_training_rows(items)))[0])
    first = C.predict(model, items).withColumnRenamed("predicted_label", "first_label")
    both = C.predict(load_model(spark, path), first)
    by_nodes = forest.walked_labels(forest.read_nodes(spark, path), forest.read_labels(spark, path), items, ["url"])
    walked = by_nodes.withColumnRenamed("predicted_label", "walked_label")
    return both.join(walked, "url").select(
        "url",
        (F.col("predicted_label") == F.col("first_label")).alias("same"),
        (F.col("walked_label") == F.col("first_label")).alias("walked"),
    )
