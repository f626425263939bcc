"""Connected components of a graph, by alternating large and small stars over tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeropanel.session import scratch_path, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hooks the neighbours of every node to the smallest of them: the larger ones, or the smaller ones and itself."""
    if large:
        near = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    lowest = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")).select(F.col("a").alias("at"), "low")
    met = near.join(lowest, F.col("a") == F.col("at"))
    if large:
        hooked = met.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        hooked = met.filter(F.col("b") != F.col("low")).select(F.col("b").alias("a"), F.col("low").alias("b")).union(
            lowest.select(F.col("at").alias("a"), F.col("low").alias("b")))
    return hooked.filter(F.col("a") != F.col("b")).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every edge (a, b), with a > b, leads from a node without another edge to one that leads nowhere."""
    ends = edges.select(F.inline(F.array(
        F.struct(F.col("a").alias("node"), F.lit(1).alias("up")), F.struct(F.col("b").alias("node"), F.lit(0).alias("up")))))
    per_node = ends.groupBy("node").agg(F.sum("up").alias("up"), F.count("*").alias("n"))
    return per_node.filter((F.col("up") > 0) & (F.col("n") > 1)).count() == 0


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) of integers -> node, label: the smallest node of its component, for every node with an edge.

    Each step is a grouping that combines before its shuffle and a join, so a node with very many neighbours splits;
    rows never exceed the edges plus the nodes. Steps are written, so a lost executor costs its tasks only. They end with the
    first whose edges all lead from a node to the smallest of its component.
    """
    path = scratch_path(edges.sparkSession, "components")
    return _labelled(written(_downwards(edges), f"{path}/0"), path)


def _downwards(edges: DataFrame) -> DataFrame:
    """Every edge once, from its larger node to its smaller one."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter(F.col("a") != F.col("b")).distinct()


def _labelled(now: DataFrame, path: str) -> DataFrame:
    """node, label for written edges that lead downwards."""
    step = 0
    while not _are_stars(now):
        step += 1
        now = written(_star(_star(now, large=True), large=False), f"{path}/{step}")
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("label", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(roots)


def with_links(labels: DataFrame, links: DataFrame) -> DataFrame:
    """node, label after more links (a, b), from `labels` that `components` found before; the same frame if they join nothing.

    A component found before counts as one node, so only what the links join is gone through again.
    """
    path = scratch_path(labels.sparkSession, "links")
    known = links
    for end in ("a", "b"):
        named = labels.select(F.col("node").alias(end), F.col("label").alias("_label"))
        known = known.join(named, end, "left").withColumn(end, F.coalesce("_label", end)).drop("_label")
    between = written(_downwards(known), f"{path}/0")
    if not between.count():
        return labels
    joined = _labelled(between, path)
    # what has no label yet is its own
    every = labels.select("node", "label").union(joined.select("node", F.col("node").alias("label"))).distinct()
    return every.join(joined.toDF("label", "_label"), "label", "left").select("node", F.coalesce("_label", "label").alias("label"))
