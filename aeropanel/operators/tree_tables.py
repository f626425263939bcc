"""Fitted trees as a table of nodes, and what can be computed from it with joins: predictions and importances.

A row is a node: tree, node, left and right child, the feature (from 0) and threshold that part its rows, the value it
predicts, its training rows and the gain of its split; a leaf has no children. The table is read from what the model
writes, so nodes do not pass through the driver. Its size is that of the model, not of the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.regression import DecisionTreeRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeropanel.session import scratch_path

GBT, FOREST, TREE = "gbt", "forest", "tree"


def kind_of(model) -> str:
    name = type(model).__name__
    return TREE if isinstance(model, DecisionTreeRegressionModel) else FOREST if "RandomForest" in name else GBT


def node_table(model) -> DataFrame:
    """tree, weight, node, depth, left, right, feature, threshold, value, rows, gain of a fitted regressor of trees.

    The weights are such that a prediction is the sum of weight times value over the leaves that a row comes to.
    """
    session = SparkSession.active()
    path = scratch_path(session, "trees")
    model.write().save(path)
    written = session.read.parquet(f"{path}/data")
    kind = kind_of(model)
    if kind == TREE:
        nodes = written.select(F.lit(0).alias("tree"), F.lit(1.0).alias("weight"), F.struct("*").alias("n"))
    else:
        told = session.read.parquet(f"{path}/treesMetadata")
        tree, _, weight = (F.col(c) for c in told.columns)
        share = F.lit(1.0 / model.getNumTrees) if kind == FOREST else weight
        weights = told.select(tree.alias("treeID"), share.alias("weight"))
        nodes = written.join(weights, "treeID").select(F.col("treeID").alias("tree"), "weight", F.col("nodeData").alias("n"))
    inner = F.col("n.leftChild") >= 0
    only_inner = lambda c: F.when(inner, F.col(c) if isinstance(c, str) else c)
    table = nodes.select(
        "tree", "weight", F.col("n.id").alias("node"), only_inner("n.leftChild").alias("left"), only_inner("n.rightChild").alias("right"),
        only_inner("n.split.featureIndex").alias("feature"), only_inner(F.get("n.split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.col("n.prediction").alias("value"), F.col("n.rawCount").alias("rows"), only_inner("n.gain").alias("gain"))
    out = scratch_path(session, "tree-nodes")
    table.write.parquet(out)
    return session.read.parquet(out)


def depth_of(nodes: DataFrame) -> int:
    """The number of levels below the roots, level by level over the table."""
    level, depth = nodes.filter("node = 0").select("tree", "node"), 0
    children = nodes.filter("left IS NOT NULL").select("tree", "node", F.explode(F.array("left", "right")).alias("child"))
    while True:
        level = level.join(children, ["tree", "node"]).select("tree", F.col("child").alias("node"))
        if level.isEmpty():
            return depth
        depth += 1


def predictions(rows: DataFrame, nodes: DataFrame, features: Sequence[str], keys: Sequence[str], depth: int | None = None) -> DataFrame:
    """keys, prediction: every row walks down all trees at once, one join with the nodes per level.

    `keys` tell the rows apart. The table of nodes is small, and Spark broadcasts it while it is below its own bound; beyond
    it the walk is dealt by tree and node.
    """
    depth = depth_of(nodes) if depth is None else depth
    trees = nodes.filter("node = 0").select(F.sort_array(F.collect_list("tree")).alias("trees")).scalar()
    walk = rows.select(*keys, F.array(*(F.col(c).cast("double") for c in features)).alias("_x"), F.explode(trees).alias("_tree")) \
        .withColumn("_node", F.lit(0))
    inner = nodes.filter("left IS NOT NULL").select("tree", "node", "left", "right", "feature", "threshold")
    for level in range(depth):
        step = inner.withColumnsRenamed({c: f"_{c}{level}" for c in inner.columns})
        at = lambda c, level=level: F.col(f"_{c}{level}")
        goes_left = F.get("_x", at("feature")) <= at("threshold")
        # a row that has come to a leaf stays there
        walk = walk.join(step, (F.col("_tree") == at("tree")) & (F.col("_node") == at("node")), "left") \
            .withColumn("_node", F.when(at("left").isNull(), F.col("_node")).when(goes_left, at("left")).otherwise(at("right"))) \
            .select(*keys, "_x", "_tree", "_node")
    leaves = nodes.select(F.col("tree").alias("_of"), F.col("node").alias("_at"), (F.col("weight") * F.col("value")).alias("_part"))
    return walk.join(leaves, (F.col("_tree") == F.col("_of")) & (F.col("_node") == F.col("_at"))) \
        .groupBy(*keys).agg(F.sum("_part").alias("prediction"))


def importances(nodes: DataFrame, features: Sequence[str], per_tree: bool = True) -> DataFrame:
    """feature, importance: gain times rows, added up over the trees and scaled to 1.

    With `per_tree` every tree counts alike, as the library has it for forests; without, by its own sum, as for boosting. A
    tree without a split has no say; features that part nothing have 0.
    """
    gained = nodes.filter("left IS NOT NULL").groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("rows")).alias("gained"))
    of_tree = gained.groupBy(F.col("tree").alias("_of")).agg(F.sum("gained").alias("all"))
    shares = gained.join(of_tree, F.col("tree") == F.col("_of")).filter(F.col("all") > 0)
    summed = shares.groupBy("feature").agg(F.sum(F.col("gained") / (F.col("all") if per_tree else F.lit(1.0))).alias("share"))
    whole = summed.agg(F.sum("share")).scalar()
    named = F.element_at(F.array(*(F.lit(f) for f in features)), F.col("feature") + 1)
    found = summed.select(named.alias("_feature"), (F.col("share") / whole).alias("importance"))
    every = nodes.sparkSession.range(1).select(F.explode(F.array(*(F.lit(f) for f in features))).alias("feature"))
    return every.join(found, F.col("feature") == F.col("_feature"), "left") \
        .select("feature", F.coalesce("importance", F.lit(0.0)).alias("importance"))
