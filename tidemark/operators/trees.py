"""Tree ensembles as tables (F6-F8): a fitted forest or boosted ensemble as a table of nodes, and scoring by it.

``tree_nodes``   (tree, weight, node, feature, threshold, left_child, right_child, value, root) of a fitted MLlib ensemble,
                 read from the artifact, where it is a distributed table already. Inner nodes send a record left if its
                 feature is at most the threshold; leaves have no feature.
``score_nodes``  every record descends every tree, a level at a time: one join with the node table for each level. The
                 node table is small beside the records, so Spark broadcasts it if its size allows and shuffles otherwise. The result equals
                 MLlib's ``transform`` but for the order in which a sum is taken.

Scoring in bulk stays with ``transform`` (JVM, no join); the table is what another engine can score and check.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NODES = "tree int, weight double, node int, feature int, threshold double, left_child int, right_child int, value double"


def tree_nodes(spark: SparkSession, path: str) -> DataFrame:
    """The nodes of a forest or boosted ensemble stored by MLlib at ``path`` (categorical splits are refused)."""
    data = spark.read.parquet(f"{path.rstrip('/')}/data")
    trees = spark.read.parquet(f"{path.rstrip('/')}/treesMetadata")
    key, _, weight = trees.columns[:3]
    n, split = F.col("nodeData"), F.col("nodeData.split")
    leaf = n["leftChild"] < 0
    cut = F.when(~leaf, F.when(split["numCategories"] == -1, F.element_at(split["leftCategoriesOrThreshold"], 1)).otherwise(F.raise_error(F.lit("categorical split"))))
    inner = lambda c: F.when(~leaf, c)
    nodes = data.select(
        F.col("treeID").alias("tree"),
        n["id"].alias("node"),
        inner(split["featureIndex"]).alias("feature"),
        cut.alias("threshold"),
        inner(n["leftChild"]).alias("left_child"),
        inner(n["rightChild"]).alias("right_child"),
        n["prediction"].alias("value"),
    )
    weights = trees.select(F.col(key).cast("int").alias("tree"), F.col(weight).cast("double").alias("weight"))
    return nodes.join(weights, "tree").select("tree", "weight", "node", "feature", "threshold", "left_child", "right_child", "value")


def score_nodes(rows: DataFrame, nodes: DataFrame, features, id_col: str, combine: str = "mean", out: str = "score") -> DataFrame:
    """(id, ``out``): the mean of the trees' values (forest) or their sum by weight (boosting).

    Descends until every record is at a leaf; a record with a missing feature goes right, as NaN does. Rows are told apart by ``id_col``.
    """
    if combine not in ("mean", "sum"):
        raise ValueError(f"unknown combination: {combine}")
    x = F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(float("nan"))) for f in features])
    roots = nodes.where("node = 0").agg(F.array_sort(F.collect_list(F.struct("tree", "weight"))).alias("trees"))  # one row
    count = roots.first()["trees"]  # a pair for each tree
    trees = F.array(*[F.struct(F.lit(t["tree"]).alias("tree"), F.lit(t["weight"]).alias("weight")) for t in count])
    at = rows.select(F.col(id_col).alias("id"), x.alias("x"), F.explode(trees).alias("t")).select("id", "x", "t.tree", "t.weight", F.lit(0).alias("node"))
    table = nodes.select("tree", "node", "feature", "threshold", "left_child", "right_child", "value")
    for _ in range(_depth(nodes)):
        here = at.join(table.drop("value"), ["tree", "node"])
        # Spark orders NaN above all numbers, so it goes right
        below: Column = F.when(F.col("feature").isNull(), F.col("node")).when(F.get("x", F.col("feature")) <= F.col("threshold"), F.col("left_child")).otherwise(F.col("right_child"))
        at = here.select("id", "x", "tree", "weight", below.alias("node"))
    value = at.join(table.select("tree", "node", "value"), ["tree", "node"])
    total = F.avg("value") if combine == "mean" else F.sum(F.col("weight") * F.col("value"))
    return value.groupBy("id").agg(total.alias(out)).withColumnRenamed("id", id_col)


def _depth(nodes: DataFrame) -> int:
    """Levels below the roots; a tree's nodes are one small group, and a child's number is above its parent's."""

    def deepest(t: pa.Table) -> pa.Table:
        level = {0: 0}
        for node, left, right in sorted(zip(*(t.column(c).to_pylist() for c in ("node", "left_child", "right_child")), strict=True)):
            if left is not None:
                level[left] = level[right] = level[node] + 1
        return pa.table({"depth": pa.array([max(level.values())], pa.int32())})

    found = nodes.select("tree", "node", "left_child", "right_child").groupBy("tree").applyInArrow(deepest, "depth int")
    return found.agg(F.max("depth")).first()[0] or 0
