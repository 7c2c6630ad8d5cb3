import math
from datetime import datetime
from multiprocessing.pool import ThreadPool

import pytest
from pyspark.sql import functions as F

from adperf.operators import models, training
from adperf.registry import bid_set, creative_set
from adperf.plans import jobs
from tests.conftest import SMALL

KEYS = ("campaign_id", "hour_of_day", "day_of_week")


@pytest.fixture(scope="module")
def creatives(spark, tmp_path_factory):
    rows, features = training.prepare_creative(creative_set(spark, SMALL))
    return jobs.store(rows, str(tmp_path_factory.mktemp("c") / "rows")), features


@pytest.fixture(scope="module")
def bids(spark, tmp_path_factory):
    rows, features = training.prepare_bids(training.bid_features(bid_set(spark, SMALL)))
    return jobs.store(rows, str(tmp_path_factory.mktemp("b") / "rows")), features


def test_feature_lists(bids, creatives):
    assert "cpc_squared" in bids[1] and "avg_cpc" not in bids[1] and "campaign_id" not in bids[1]
    assert not {"headline", "creative_text", "avg_cpc", "days_active"} & set(creatives[1])
    assert len(creatives[1]) == 27


def test_leaky_columns_can_be_left_out(spark):
    _, features = training.prepare_bids(training.bid_features(bid_set(spark, SMALL)), drop_leaky=True)
    assert not set(training.BID_LEAKY) & set(features)


def test_split_is_stable_and_complete(bids):
    rows, _ = bids
    train, test = models.split(rows, *KEYS)
    assert train.count() + test.count() == rows.count()
    again, _ = models.split(rows.repartition(7), *KEYS)
    assert sorted(map(str, again.select(*KEYS).collect())) == sorted(map(str, train.select(*KEYS).collect()))


def test_forest(creatives):
    rows, features = creatives
    model = models.fit(models.creative_scorer(rows, features, trees=20, depth=5), rows)
    importance = models.feature_importance(model, rows)
    assert math.isclose(importance.agg(F.sum("importance")).first()[0], 1.0, abs_tol=1e-6)
    assert models.top_importance(importance).count() == 10
    scores = models.evaluate(model.transform(rows), "avg_ctr").first()
    assert scores.samples == rows.count() and scores.r2 > 0


def test_boosted_model_beats_the_mean(bids):
    rows, features = bids
    train, test = models.split(rows, *KEYS)
    model = models.fit(models.bid_model(rows, features, rounds=10), train)
    predictions = model.transform(test)
    assert models.evaluate(predictions, "optimal_bid").first().r2 > 0
    sample = models.sample_predictions(predictions, "optimal_bid", *KEYS)
    assert all(math.isclose(r.difference, r.predicted - r.actual) for r in sample.collect())


def test_evaluation_formulas(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 4.0)], "y double, prediction double")
    row = models.evaluate(df, "y").first()
    assert (row.samples, row.mse, row.mae, row.r2) == (3, 0.666667, 0.666667, 0.75)
    assert row.mape == round((1 + 0 + 0.2) / 3 * 100, 6)


def test_cross_validation(bids):
    rows, features = bids
    row = models.cross_validate(models.bid_model(rows, features, rounds=3), rows, "optimal_bid", *KEYS).first()
    assert row.folds == 5 and math.isfinite(row.cv_r2_mean) and row.cv_r2_spread >= 0


def test_registry(spark, bids, tmp_path):
    rows, features = bids
    registry = models.ModelRegistry(spark, str(tmp_path / "models"))
    assert registry.current("bid") is None and registry.load("bid") is None
    for n, at in ((1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2))):
        pipeline = models.bid_model(rows, features, rounds=n)
        version = jobs.run_training(
            rows, features, pipeline, "optimal_bid", KEYS, registry, "bid", "GBTRegressor", at
        )
        assert version == n
    assert registry.current("bid")["version"] == 2
    assert registry.load("bid").stages[-1].getNumTrees == 2
    registry.rollback("bid", 1, datetime(2024, 1, 3))
    assert registry.current("bid")["version"] == 1 and registry.next_version("bid") == 3
    with pytest.raises(ValueError):
        registry.rollback("bid", 9, datetime(2024, 1, 3))
    metadata = spark.read.json(str(tmp_path / "models" / "bid" / "v=1" / "metadata")).first()
    assert metadata.target == "optimal_bid" and metadata.n_features == len(features)


def test_publishers_at_once_and_ones_that_end_early(spark, bids, tmp_path):
    rows, features = bids
    model = models.fit(models.bid_model(rows, features, rounds=1), rows)
    registry = models.ModelRegistry(spark, str(tmp_path / "models"))
    with ThreadPool(4) as pool:
        versions = pool.map(lambda n: registry.publish("bid", model, "GBTRegressor", {"n": n}, features, "optimal_bid", datetime(2024, 1, 1)), range(4))
    assert sorted(versions) == [1, 2, 3, 4]
    entries = registry.rows().collect()
    assert sorted(r.entered for r in entries) == [1, 2, 3, 4] and sorted(r.version for r in entries) == [1, 2, 3, 4]
    last = registry.current("bid")["version"]
    assert last == max(entries, key=lambda r: r.entered).version
    # one that took a version and an entry, and wrote neither
    assert registry._claim("bid/claims", "", lambda n: "") == 5 and registry._claim("registry", ".json", lambda n: "") == 5
    assert registry.current("bid")["version"] == last and registry.next_version("bid") == 6
    registry.rollback("bid", 1, datetime(2024, 1, 2))
    assert registry.current("bid")["version"] == 1 and registry.rows().agg(F.max("entered")).first()[0] == 6
    assert registry.publish("other", model, "GBTRegressor", {}, features, "optimal_bid", datetime(2024, 1, 3)) == 1


@pytest.mark.parametrize("n", [0, 1, 2, 9_999, 30_001, 60_000])
@pytest.mark.parametrize("value", ["cast(id as double)", "cast(id % 2 as double)", "exp(id % 700) * (id % 3 - 1)", "cast(xxhash64(id) as double)"])
def test_exact_median(spark, monkeypatch, n, value):
    monkeypatch.setattr(training, "FEW", 50)
    rows = spark.range(n).select(F.expr(value).alias("v")).cache()
    wanted = rows.agg(F.median("v")).first()[0]
    found = training.exact_median(rows, n)
    assert found is None if wanted is None else found == pytest.approx(wanted, rel=1e-15, abs=0)
    rows.unpersist()


def test_median_survives_a_poor_sketch(spark, monkeypatch):
    monkeypatch.setattr(training, "FEW", 50)
    monkeypatch.setattr(training.F, "percentile_approx", lambda c, at, _: F.array(F.min("v"), F.min("v")) if at[0] > 0.3 else F.array(F.min("v"), F.max("v")))
    rows = spark.range(10_001).select(F.col("id").cast("double").alias("v")).cache()
    monkeypatch.setattr(training, "ACCURACY", 20)
    assert training.value_at(rows.filter("v <= 60"), 30, 61) == 30.0
    rows.unpersist()


def test_profile_of_an_empty_set(spark):
    row = training.target_profile(spark.createDataFrame([], "y double"), "y").first()
    assert row.samples == 0 and row.minimum is None and row.median is None
