import math

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from adperf.operators import models, trees


@pytest.fixture(scope="module")
def rows(spark):
    noise = (F.crc32(F.col("id").cast("string")) % 97) / 97.0
    kind = F.element_at(F.array(*map(F.lit, "abc")), (F.col("id") % 3 + 1).cast("int"))
    made = spark.range(240).select(
        "id", (F.col("id") % 11).cast("double").alias("x"), noise.alias("z"), kind.alias("kind"),
        (F.col("id") % 11 * 2 + noise * 5 + F.when(kind == "b", 9).otherwise(0)).alias("y"),
    )
    return made.cache()


def fitted(rows, boosted):
    if boosted:
        tree = GBTRegressor(featuresCol="features", labelCol="y", maxIter=5, maxDepth=4, stepSize=0.3, seed=1)
    else:
        tree = RandomForestRegressor(featuresCol="features", labelCol="y", numTrees=7, maxDepth=6, seed=1)
    return models.fit(Pipeline(stages=models._stages(rows, ["x", "z", "kind"]) + [tree]), rows)


def plain(found, x, min_split):
    """The score of one row by walking the node dictionaries, stopping at nodes of too few rows."""
    total = 0.0
    for tree in {n.tree for n in found}:
        by_id = {n.node: n for n in found if n.tree == tree}
        at = by_id[0]
        while at.left >= 0 and at.n_rows >= min_split:
            value = x[at.feature]
            left = value <= at.goes_left[0] if at.n_classes < 0 else value in at.goes_left
            at = by_id[at.left if left else at.right]
        total += at.weight * at.prediction
    return total


@pytest.mark.parametrize("boosted", [False, True])
def test_nodes_give_the_models_scores_and_pruned_ones(spark, rows, boosted, tmp_path):
    model = fitted(rows, boosted)
    found = trees.nodes(spark, model, str(tmp_path / "model")).cache()
    own = model.transform(rows).select("id", "y", "prediction", vector_to_array("features").alias("v")).collect()
    all_nodes = found.collect()
    assert any(n.n_classes > 0 for n in all_nodes)
    unpruned = {r.id: r.score for r in trees.score(model, found, rows, "score").collect()}
    assert all(math.isclose(unpruned[r.id], r.prediction, rel_tol=1e-9) for r in own)
    for least in (2, 20, 10_000):
        fewer = trees.pruned(found, least)
        kept = fewer.collect()
        assert len({(n.tree, n.node) for n in kept}) == len(kept)
        assert all(n.n_rows >= least for n in kept if n.left >= 0)
        scores = {r.id: r.score for r in trees.score(model, fewer, rows, "score").collect()}
        assert len(scores) == len(own)
        assert all(math.isclose(scores[r.id], plain(all_nodes, r.v, least), rel_tol=1e-9) for r in own)
    assert len(set(scores.values())) == 1  # roots alone


def test_a_tree_of_one_node_and_no_rows(spark, tmp_path):
    flat = spark.range(5).select(F.col("id").cast("double").alias("x"), F.lit(3.0).alias("y"))
    stages = [VectorAssembler(inputCols=["x"], outputCol="features"), RandomForestRegressor(labelCol="y", numTrees=2, maxDepth=3, seed=1)]
    model = models.fit(Pipeline(stages=stages), flat)
    found = trees.pruned(trees.nodes(spark, model, str(tmp_path / "m")), 5)
    assert {r.prediction for r in trees.score(model, found, flat).collect()} == {3.0}
    assert trees.score(model, found, flat.limit(0)).count() == 0


def test_pruned_forest_is_the_forest_of_a_fit_that_stops_earlier(spark, rows, tmp_path):
    # one tree on all rows, all features: what the rule leaves is nested in the whole tree, with the means of its nodes
    stages = models._stages(rows, ["x", "z"]) + [RandomForestRegressor(labelCol="y", numTrees=1, maxDepth=6, featureSubsetStrategy="all", subsamplingRate=1.0, bootstrap=False, seed=1)]
    model = models.fit(Pipeline(stages=stages), rows)
    fewer = trees.pruned(trees.nodes(spark, model, str(tmp_path / "m")), 30)
    scored = trees.score(model, fewer, rows, "score")
    leaves = scored.groupBy("score").agg(F.avg("y").alias("mean")).collect()
    assert len(leaves) > 1 and all(math.isclose(r.score, r.mean, rel_tol=1e-9) for r in leaves)
