"""Page classifier: checks, encoding, split, forest, evaluation."""

import dataclasses

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pageloom.fixed_values import FEATURES
from pageloom.operators.features import align_features
from pageloom.schemas import EmptyInput, require_columns

NO_CLASS = "(none)"


@dataclasses.dataclass(frozen=True)
class ForestSettings:
    """Settings of the forest; trees and seed are the defaults of the page classifier."""

    num_trees: int = 100
    max_depth: int = 30
    max_bins: int = 64
    seed: int = 42
    memory_mb: int = 1024


def check_training_rows(df: DataFrame) -> DataFrame:
    """Labelled rows of a usable training table; raises when there are none."""
    labelled = labelled_rows(require_columns(df, ["label"]))
    if labelled.isEmpty():
        raise EmptyInput("no labelled row")
    return require_columns(labelled, FEATURES)


def check_rows(df: DataFrame) -> DataFrame:
    """Add ``reject_reason``: no label, or no URL, by which rows are split."""
    reason = F.when(F.col("label").isNull(), "missing_label").when(F.col("url").isNull(), "missing_url")
    return df.withColumn("reject_reason", reason)


def labelled_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col("label").isNotNull())


def fill_missing_features(df: DataFrame) -> DataFrame:
    """Null features become 0 or false."""
    types = dict(df.dtypes)
    return df.fillna({f: False if types[f] == "boolean" else 0 for f in FEATURES if f in types})


def encode_labels(df: DataFrame) -> DataFrame:
    """Add ``label_index``: the position of the label among the sorted labels."""
    return label_encoder().fit(df).transform(df)


def label_encoder() -> StringIndexer:
    return StringIndexer(
        inputCol="label", outputCol="label_index", stringOrderType="alphabetAsc"
    )


def is_test_row(url: Column) -> Column:
    """A stable quarter of the URLs, by the first digit of their hash; no URL counts as empty."""
    url = F.coalesce(url, F.lit(""))
    return F.substring(F.md5(url.cast("binary")), 1, 1).isin("0", "1", "2", "3")


def split_rows(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    test = is_test_row(F.col("url"))
    return df.where(~test), df.where(test)


def fit_forest(train: DataFrame, settings: ForestSettings = ForestSettings()) -> PipelineModel:
    """Fit encoder and forest on ``label`` and the feature columns; one model holds all steps."""
    inputs = align_features(train, ["label"])
    encoder = label_encoder().fit(inputs)
    forest = RandomForestClassifier(
        labelCol="label_index",
        featuresCol="features",
        predictionCol="prediction",
        numTrees=settings.num_trees,
        maxDepth=settings.max_depth,
        maxBins=settings.max_bins,
        seed=settings.seed,
        maxMemoryInMB=settings.memory_mb,
    )
    steps = [VectorAssembler(inputCols=FEATURES, outputCol="features"), forest]
    fitted = Pipeline(stages=steps).fit(encoder.transform(inputs))
    decoder = IndexToString(
        inputCol="prediction", outputCol="predicted_label", labels=encoder.labels
    )
    return PipelineModel(stages=[encoder, *fitted.stages, decoder])


def predict(model: PipelineModel, items: DataFrame) -> DataFrame:
    """Add ``predicted_label``; all other columns stay as they are.

    The features enter as one struct beside the row, so nothing is joined back.
    """
    scoring = PipelineModel(
        stages=[s for s in model.stages if not isinstance(s, StringIndexerModel)]
    )
    row = F.struct(*items.columns).alias("_row")
    scored = scoring.transform(align_features(items.withColumn("_row", row), ["_row"]))
    return scored.select("_row.*", "predicted_label")


def prediction_counts(predictions: DataFrame) -> DataFrame:
    """Rows by label and prediction; a missing one is a class of its own."""
    named = [F.coalesce(c, F.lit(NO_CLASS)).alias(c) for c in ("label", "predicted_label")]
    return predictions.select(*named).groupBy("label", "predicted_label").agg(
        F.count(F.lit(1)).alias("n")
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def counted_report(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy and the two averages.

    Classes are those among labels or predictions; an undefined ratio is 0.
    """
    n, zero = F.col("n"), F.lit(0)
    hit = F.when(F.col("label") == F.col("predicted_label"), n).otherwise(zero)
    sides = F.array(
        F.struct(F.col("label").alias("class"), n.alias("actual"), zero.alias("predicted"), hit.alias("hits")),
        F.struct(F.col("predicted_label").alias("class"), zero.alias("actual"), n.alias("predicted"), zero.alias("hits")),
    )
    per_class = (
        counts.select(F.inline(sides))
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("actual", "predicted", "hits")])
        .withColumn("precision", _ratio(F.col("hits"), F.col("predicted")))
        .withColumn("recall", _ratio(F.col("hits"), F.col("actual")))
        .withColumn(
            "f1_score",
            _ratio(
                2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")
            ),
        )
    )
    scores = ["precision", "recall", "f1_score"]
    support = F.sum("actual")
    totals = per_class.agg(
        support.alias("support"),
        _ratio(F.sum("hits"), support).alias("accuracy"),
        *[F.avg(c).alias(f"macro_{c}") for c in scores],
        *[_ratio(F.sum(F.col(c) * F.col("actual")), support).alias(f"weighted_{c}") for c in scores],
    ).where("support is not null")

    def line(name: str, columns: list[str]) -> Column:
        values = [F.col(c).alias(s) for c, s in zip(columns, scores)]
        return F.struct(F.lit(name).alias("class"), *values, F.col("support"))

    lines = F.array(
        line("accuracy", ["accuracy"] * 3),
        line("macro avg", [f"macro_{c}" for c in scores]),
        line("weighted avg", [f"weighted_{c}" for c in scores]),
    )
    rows = per_class.select("class", *scores, F.col("actual").alias("support"))
    return rows.unionByName(totals.select(F.inline(lines)))


def classification_report(predictions: DataFrame) -> DataFrame:
    """Report over rows with ``label`` and ``predicted_label``."""
    return counted_report(prediction_counts(predictions))


def counted_matrix(counts: DataFrame, classes: list[str] | None = None) -> DataFrame:
    """One row per actual class, one column per predicted class, zeros included.

    The classes come from the counts unless they are given; a classifier has no more of them than
    its encoder has labels, which it holds in memory as well.
    """
    if classes is None:
        names = counts.select(F.explode(F.array("label", "predicted_label")).alias("class"))
        classes = sorted(r["class"] for r in names.distinct().collect())
    spine = counts.sparkSession.createDataFrame([(c,) for c in classes], "label string")
    cells = counts.groupBy("label").pivot("predicted_label", classes).sum("n")
    return spine.join(cells, "label", "left").fillna(0, subset=classes).orderBy("label")


def confusion_matrix(predictions: DataFrame, classes: list[str] | None = None) -> DataFrame:
    """Matrix over rows with ``label`` and ``predicted_label``."""
    return counted_matrix(prediction_counts(predictions), classes)


def dense_label_index(df: DataFrame) -> DataFrame:
    """Distinct labels with their position; the encoder's mapping as a table."""
    labels = df.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    position = F.row_number().over(W.orderBy("label")) - 1
    return labels.select("label", position.alias("label_index"), "n")
