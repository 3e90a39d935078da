"""A fitted forest as a table of nodes, and what follows from that table alone: weights of features, and labels.

``read_nodes`` gives one row per node of a saved model: ``tree, node, feature, threshold, left, right, counts, gain``.
Node 0 is a tree's root. A leaf has no feature and is its own child, so that a walk stays there. Any engine that can join
can walk the table; the results are those of the model itself.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.fixed_values import FEATURES
from pageloom.operators.features import aligned_features

_SPLIT = "struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>"
_NODE = f"struct<id:int,impurityStats:array<double>,gain:double,leftChild:int,rightChild:int,split:{_SPLIT}>"


def read_nodes(spark: SparkSession, model_path: str) -> DataFrame:
    """Nodes of the forest of a saved classifier, all of its trees."""
    saved = spark.read.schema(f"treeID int, nodeData {_NODE}").parquet(f"{model_path}/pipeline/stages/*_RandomForest*/data")
    n = "nodeData"
    inner = F.col(f"{n}.leftChild") >= 0

    def child(name: str) -> Column:
        return F.when(inner, F.col(f"{n}.{name}")).otherwise(F.col(f"{n}.id"))

    return saved.select(
        F.col("treeID").alias("tree"),
        F.col(f"{n}.id").alias("node"),
        F.when(inner, F.col(f"{n}.split.featureIndex")).alias("feature"),
        F.when(inner, F.col(f"{n}.split.leftCategoriesOrThreshold")[0]).alias("threshold"),
        child("leftChild").alias("left"),
        child("rightChild").alias("right"),
        F.col(f"{n}.impurityStats").alias("counts"),
        F.when(inner, F.col(f"{n}.gain")).alias("gain"),
    )


def read_labels(spark: SparkSession, model_path: str) -> DataFrame:
    """Labels of a saved classifier by their index."""
    saved = spark.read.parquet(f"{model_path}/pipeline/stages/0_StringIndexer*/data")
    return saved.select(F.posexplode(F.col("labelsArray")[0]).alias("index", "label"))


def _ordered_sum(values: Column) -> Column:
    """Sum from left to right, so that it does not depend on partitions."""
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def feature_weights(nodes: DataFrame) -> DataFrame:
    """Weight of each feature that splits: gain times rows of its nodes, one in total for a tree, and one in all."""
    gained = nodes.where("feature IS NOT NULL").select("tree", "feature", (F.col("gain") * _ordered_sum(F.col("counts"))).alias("gain"))
    by_tree = gained.groupBy("tree", "feature").agg(F.sum("gain").alias("gain"))
    total = gained.groupBy("tree").agg(F.sum("gain").alias("total")).where("total > 0")
    weights = by_tree.join(total, "tree").groupBy("feature").agg(F.sum(F.col("gain") / F.col("total")).alias("weight"))
    whole = weights.agg(F.sum("weight").alias("weight")).scalar()
    named = F.get(F.array(*[F.lit(f) for f in FEATURES]), F.col("feature"))
    return weights.select(named.alias("feature"), (F.col("weight") / whole).alias("weight"))


def tree_depth(nodes: DataFrame) -> int:
    """Steps from a root to the deepest leaf, by one small join per level of the node table."""
    children = nodes.where("feature IS NOT NULL").select("tree", "node", F.explode(F.array("left", "right")).alias("child"))
    level, depth = children.where("node = 0"), 0
    while not level.isEmpty():
        depth += 1
        parents = level.select("tree", F.col("child").alias("node"))
        level = children.join(parents, ["tree", "node"])
    return depth


def walk(nodes: DataFrame, items: DataFrame, keys: Sequence[str], depth: int | None = None) -> DataFrame:
    """The leaf of each item in each tree: ``keys, tree, counts``.

    All trees are walked at once, one level by each join with the node table, whose keys are unique: no join makes more
    rows. Items are one row per key.
    """
    if depth is None:
        depth = tree_depth(nodes)
    values = items.select(*keys, F.array(*aligned_features(items)).alias("_values"))
    trees = nodes.where("node = 0").select("tree").agg(F.sort_array(F.collect_list("tree")).alias("trees")).scalar()
    at = values.select("*", F.explode(trees).alias("tree"), F.lit(0).alias("node"))
    steps = nodes.select("tree", "node", "feature", "threshold", "left", "right")
    below = F.get("_values", F.col("feature")) <= F.col("threshold")
    for _ in range(depth):
        moved = F.when(below, F.col("left")).otherwise(F.col("right")).alias("node")
        at = at.join(steps, ["tree", "node"]).select(*keys, "_values", "tree", moved)
    return at.join(nodes.select("tree", "node", "counts"), ["tree", "node"]).select(*keys, "tree", "counts")


def walked_labels(nodes: DataFrame, labels: DataFrame, items: DataFrame, keys: Sequence[str], depth: int | None = None) -> DataFrame:
    """``keys`` and ``predicted_label`` of each item: the class with most votes, of equal ones the first.

    A leaf's vote is its share of each class. Votes are added up in the order of the trees.
    """
    total = _ordered_sum(F.col("counts"))
    shares = walk(nodes, items, keys, depth).select(*keys, "tree", F.transform("counts", lambda c: F.when(total > 0, c / total).otherwise(0.0)).alias("shares"))
    votes = shares.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("tree", "shares"))).alias("votes"))

    def sums(index: Column) -> Column:
        return _ordered_sum(F.transform("votes", lambda v: F.get(v["shares"], index)))

    names = labels.agg(F.sort_array(F.collect_list(F.struct("index", "label"))).alias("names")).scalar()
    scored = votes.withColumn("names", names).select(*keys, F.transform("names", lambda n: F.struct(sums(n["index"]).alias("score"), n["label"].alias("label"))).alias("scored"))
    best = F.array_max(F.transform("scored", lambda s: s["score"]))
    return scored.select(*keys, F.filter("scored", lambda s: s["score"] == best)[0]["label"].alias("predicted_label"))
