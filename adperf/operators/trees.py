"""Fitted tree ensembles as tables of nodes: the least size of a split, and scores by an expression over the nodes."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# A split of fewer rows is none.
CREATIVE_SPLIT = 5
BID_SPLIT = 10


def nodes(spark: SparkSession, model: PipelineModel, path: str) -> DataFrame:
    """One row per (tree, node) of the pipeline's last stage, which is saved below ``path``.

    ``n_rows`` counts the rows of the tree's sample that reached the node, a row drawn twice as two. ``left`` and ``right`` are
    -1 for a leaf. A split by classes lists those that go left; one by value has ``n_classes`` -1 and the largest value that
    goes left. ``weight`` is the tree's share of a score.
    """
    ensemble = model.stages[-1]
    ensemble.write().overwrite().save(path)
    n_trees = ensemble.getNumTrees
    n_trees = n_trees() if callable(n_trees) else n_trees
    share = F.lit(1.0 / n_trees) if isinstance(ensemble, RandomForestRegressionModel) else F.col("weights")
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "metadata", "weights").select("tree", share.alias("weight"))
    found = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), F.col("nodeData.id").alias("node"), F.col("nodeData.prediction").alias("prediction"),
        F.col("nodeData.rawCount").alias("n_rows"), F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"), F.col("nodeData.split.featureIndex").alias("feature"),
        F.col("nodeData.split.leftCategoriesOrThreshold").alias("goes_left"), F.col("nodeData.split.numCategories").alias("n_classes"),
    )
    return found.join(weights, "tree")


def pruned(found: DataFrame, min_split: int) -> DataFrame:
    """The nodes that remain where only nodes of at least ``min_split`` rows are split.

    No node has more rows than one above it, so a node remains if its parent is split still. For a forest these are the trees
    that a fit with that rule grows from the same draws; boosting's later trees were fitted to what the unpruned earlier
    ones left over.
    """
    splits = found.filter((F.col("left") >= 0) & (F.col("n_rows") >= min_split))
    children = splits.select("tree", F.explode(F.array("left", "right")).alias("node"))
    kept = found.join(children, ["tree", "node"], "left_semi").unionByName(found.filter("node = 0"))
    small = F.col("n_rows") < min_split
    return kept.withColumns({c: F.when(small, -1).otherwise(F.col(c)) for c in ("left", "right")})


def ensemble_row(found: DataFrame) -> DataFrame:
    """The ensemble as one row: an array of its trees, each with its weight and its nodes, which name their children by place.

    As large as the model: at most trees x 2^(depth + 1) nodes, whatever the training rows.
    """
    node = F.struct("node", "prediction", "left", "right", "feature", "goes_left", "n_classes")
    by_tree = found.groupBy("tree", "weight").agg(F.array_sort(F.collect_list(node)).alias("nodes"))
    place = lambda n, child: F.array_position(F.col("ids"), n[child]).cast("int").alias(child)
    placed = F.transform("nodes", lambda n: F.struct(
        n["prediction"].alias("prediction"), place(n, "left"), place(n, "right"), n["feature"].alias("feature"),
        n["goes_left"].alias("goes_left"), n["n_classes"].alias("n_classes"),
    ))
    by_tree = by_tree.withColumn("ids", F.transform("nodes", lambda n: n["node"]))
    return by_tree.select("tree", "weight", placed.alias("nodes")).agg(
        F.array_sort(F.collect_list(F.struct("tree", "weight", "nodes"))).alias("trees")
    )


def _leaf(of: Column, x: Column, depth: int) -> Column:
    """The prediction of the leaf that a row with features ``x`` reaches in the tree with the nodes ``of``."""

    def below(at: Column) -> Column:
        def choose(n: Column) -> Column:
            value = F.element_at(x, n["feature"] + 1)
            left = F.when(n["n_classes"] < 0, value <= n["goes_left"][0]).otherwise(F.array_contains(n["goes_left"], value))
            return F.when(n["left"] == 0, at).when(left, n["left"]).otherwise(n["right"])

        return F.transform(F.array(F.element_at(of, at)), choose)[0]

    last = F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(1), lambda at, _: below(at))
    return F.element_at(of, last)["prediction"]


def score(model: PipelineModel, found: DataFrame, rows: DataFrame, output: str = "prediction") -> DataFrame:
    """``rows`` with the score of the ensemble that the nodes ``found`` describe, after the model's own preparation of features.

    The one row of the ensemble is broadcast: its size is the model's.
    """
    depth = max(model.stages[-1].getMaxDepth(), 1)
    prepared = rows
    for stage in model.stages[:-1]:
        prepared = stage.transform(prepared)
    prepared = prepared.select(*rows.columns, vector_to_array("features").alias("__x"))
    joined = prepared.crossJoin(F.broadcast(ensemble_row(found).withColumnRenamed("trees", "__trees")))
    sums = F.aggregate(
        "__trees", F.lit(0.0), lambda total, t: total + t["weight"] * _leaf(t["nodes"], F.col("__x"), depth)
    )
    return joined.select(*rows.columns, sums.alias(output))
