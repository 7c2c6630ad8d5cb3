"""Training, evaluation, storage and use of the two models."""

from __future__ import annotations

import json
from datetime import datetime
from functools import reduce
from multiprocessing.pool import ThreadPool

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.numbers import round_half_up
from ..settings import ensure_checkpoint_dir

SEED = 42


def bucket(*keys: str, buckets: int = 100, salt: str = str(SEED)) -> Column:
    """Stable bucket of a row by its key: independent of partitioning, order and reruns."""
    text = F.concat_ws("|", F.lit(salt), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % buckets


def split(df: DataFrame, *keys: str, train_percent: int = 80) -> tuple[DataFrame, DataFrame]:
    marked = bucket(*keys)
    return df.filter(marked < train_percent), df.filter(marked >= train_percent)


def _stages(df: DataFrame, features) -> list:
    """Index and encode text features, then put all features into one vector."""
    texts = [f for f in features if isinstance(df.schema[f].dataType, T.StringType)]
    stages, inputs = [], [f for f in features if f not in texts]
    if texts:
        indexed = [f"{t}_index" for t in texts]
        encoded = [f"{t}_class" for t in texts]
        stages += [
            StringIndexer(inputCols=texts, outputCols=indexed, handleInvalid="keep"),
            OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=False),
        ]
        inputs += encoded
    return stages + [VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error")]


def creative_scorer(df: DataFrame, features, target: str = "avg_ctr", trees: int = 100, depth: int = 10) -> Pipeline:
    """Random forest for the CTR of a creative."""
    forest = RandomForestRegressor(
        featuresCol="features", labelCol=target, numTrees=trees, maxDepth=depth, minInstancesPerNode=2,
        featureSubsetStrategy="sqrt", seed=SEED, cacheNodeIds=False,
    )
    return Pipeline(stages=_stages(df, features) + [forest])


def bid_model(
    df: DataFrame, features, target: str = "optimal_bid", rounds: int = 200, depth: int = 5, rate: float = 0.1
) -> Pipeline:
    """Gradient-boosted trees for the bid of a campaign at an hour and weekday."""
    boosted = GBTRegressor(
        featuresCol="features", labelCol=target, maxIter=rounds, maxDepth=depth, stepSize=rate,
        minInstancesPerNode=4, subsamplingRate=0.8, seed=SEED, checkpointInterval=10,
    )
    return Pipeline(stages=_stages(df, features) + [boosted])


def evaluate(predictions: DataFrame, label: str, prediction: str = "prediction", keys=()) -> DataFrame:
    """Samples, MSE, RMSE, MAE, R2 and MAPE in one aggregation."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    error = y - p
    sums = predictions.groupBy(*keys).agg(
        F.count(error).alias("samples"),
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(y).alias("variance"),
        F.avg(F.abs(error / F.nullif(y, F.lit(0.0)))).alias("relative"),
    )
    return sums.select(
        *keys,
        "samples",
        round_half_up("mse", 6).alias("mse"),
        round_half_up(F.sqrt("mse"), 6).alias("rmse"),
        round_half_up("mae", 6).alias("mae"),
        round_half_up(F.lit(1.0) - F.col("mse") / F.nullif("variance", F.lit(0.0)), 6).alias("r2"),
        round_half_up(F.col("relative") * 100.0, 6).alias("mape"),
    )


def slot_names(model: PipelineModel, df: DataFrame) -> list[str]:
    """Names of the feature vector's entries."""
    attrs = model.transform(df.limit(0)).schema["features"].metadata["ml_attr"]["attrs"]
    by_index = {a["idx"]: a["name"] for group in attrs.values() for a in group}
    return [by_index[i] for i in sorted(by_index)]


def feature_importance(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Importance per feature; one row per entry of the feature vector."""
    weights = model.stages[-1].featureImportances.toArray().tolist()
    rows = list(zip(slot_names(model, df), weights))
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


def top_importance(importance: DataFrame, k: int = 10) -> DataFrame:
    return importance.orderBy(F.col("importance").desc_nulls_last(), "feature").limit(k)


def fit(pipeline: Pipeline, df: DataFrame) -> PipelineModel:
    ensure_checkpoint_dir(df.sparkSession)
    return pipeline.fit(df)


def fold_predictions(pipeline: Pipeline, df: DataFrame, *keys: str, folds: int = 5) -> DataFrame:
    """Every row predicted by the model fitted on the other folds; folds are assigned by key.

    The fits run side by side: each is a sequence of short jobs that leaves executors idle.
    """
    folded = df.withColumn("fold", bucket(*keys, buckets=folds, salt="fold").cast("int"))

    def one(i: int) -> DataFrame:
        return fit(pipeline, folded.filter(F.col("fold") != i)).transform(folded.filter(F.col("fold") == i))

    ensure_checkpoint_dir(df.sparkSession)
    with ThreadPool(folds) as pool:
        parts = pool.map(inheritable_thread_target(df.sparkSession)(one), range(folds))
    return reduce(DataFrame.unionByName, parts)


def cross_validate(pipeline: Pipeline, df: DataFrame, target: str, *keys: str, folds: int = 5) -> DataFrame:
    """R2 over the folds: mean, and two standard deviations."""
    scores = evaluate(fold_predictions(pipeline, df, *keys, folds=folds), target, keys=["fold"])
    return scores.agg(
        F.count(F.lit(1)).alias("folds"),
        F.avg("r2").alias("cv_r2_mean"),
        (F.stddev_pop("r2") * 2).alias("cv_r2_spread"),
    )


def sample_predictions(predictions: DataFrame, label: str, *keys: str, k: int = 10) -> DataFrame:
    """A few actual and predicted values, in key order."""
    return (
        predictions.select(*keys, F.col(label).alias("actual"), F.col("prediction").alias("predicted"))
        .withColumn("difference", F.col("predicted") - F.col("actual"))
        .orderBy(*keys)
        .limit(k)
    )


def score(model: PipelineModel, df: DataFrame, keep, output: str = "prediction") -> DataFrame:
    """Predictions for every row, with the columns of ``keep``."""
    return model.transform(df).select(*keep, F.col("prediction").alias(output))


REGISTRY = (
    "name string, version int, model_type string, created_at timestamp, metrics string, path string, "
    "status string, entered bigint"
)


class ModelRegistry:
    """Versioned models below a root folder, and the log of what is in production.

    Every publication or rollback appends an entry, a file named by its number; the last entry of a name decides. Versions and
    entries are taken by creating a file that must not exist yet, so publishers that run at once never share one. The file
    system must do that atomically (HDFS does, local files are created so; an object store needs conditional writes). A publisher that
    ends early leaves a version without an entry, or an empty entry: neither is ever in production.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, place: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{place}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _numbers(self, folder: str) -> list[int]:
        path, fs = self._path(folder)
        if not fs.exists(path):
            return []
        names = [f.getPath().getName().removesuffix(".json") for f in fs.listStatus(path)]
        return [int(n) for n in names if n.isdigit()]

    def _claim(self, folder: str, suffix: str, content) -> int:
        """Takes the first number of ``folder`` that no other publisher has, and writes ``content`` of it into its file."""
        number = max(self._numbers(folder), default=0)
        while True:
            number += 1
            path, fs = self._path(f"{folder}/{number:012d}{suffix}")
            if fs.getScheme() == "file":  # Hadoop's local files are looked for, then created: not exclusive
                fs.mkdirs(path.getParent())
                try:
                    with open(path.toUri().getPath(), "x") as own:
                        own.write(content(number))
                except FileExistsError:
                    continue
                return number
            try:
                out = fs.create(path, False)
            except Py4JJavaError:
                if not fs.exists(path):
                    raise
                continue
            try:
                out.write(bytearray(content(number), "utf-8"))
            finally:
                out.close()
            return number

    def rows(self) -> DataFrame:
        if not self._numbers("registry"):
            return self.spark.createDataFrame([], REGISTRY)
        return self.spark.read.schema(REGISTRY).json(f"{self.root}/registry")

    def next_version(self, name: str) -> int:
        """The highest version that was taken for the name, published or not, plus 1."""
        return max(self._numbers(f"{name}/claims"), default=0) + 1

    def _append(self, name, version, model_type, at, metrics, path) -> None:
        row = {
            "name": name, "version": version, "model_type": model_type, "created_at": at.isoformat(), "metrics": metrics,
            "path": path, "status": "production",
        }
        self._claim("registry", ".json", lambda number: json.dumps(row | {"entered": number}) + "\n")

    def publish(
        self, name: str, model: PipelineModel, model_type: str, metrics: dict, features, target: str, at: datetime
    ) -> int:
        """Stores the model with its feature list, metrics and metadata as the next version, then puts it into production."""
        version = self._claim(f"{name}/claims", "", lambda number: "")
        base = f"{self.root}/{name}/v={version}"
        model.save(f"{base}/model")
        metadata = {
            "model_type": model_type, "framework": "spark-ml", "target": target, "n_features": len(features),
            "version": version, "created_at": at.isoformat(), **metrics,
        }
        for part, content in (("features", {"features": list(features)}), ("metrics", metrics), ("metadata", metadata)):
            self.spark.createDataFrame([(json.dumps(content),)], "value string").write.text(f"{base}/{part}")
        self._append(name, version, model_type, at, json.dumps(metrics), f"{base}/model")
        return version

    def current(self, name: str):
        """The entry in production, or None."""
        last = F.max_by(F.struct("version", "path", "model_type", "metrics"), "entered").alias("last")
        row = self.rows().filter((F.col("name") == name) & (F.col("status") == "production")).agg(last).first()
        return row["last"]

    def rollback(self, name: str, version: int, at: datetime) -> None:
        """Puts an earlier version back into production."""
        old = self.rows().filter((F.col("name") == name) & (F.col("version") == version)).first()
        if old is None:
            raise ValueError(f"{name} has no version {version}")
        self._append(name, version, old["model_type"], at, old["metrics"], old["path"])

    def load(self, name: str) -> PipelineModel | None:
        row = self.current(name)
        return PipelineModel.load(row["path"]) if row else None
