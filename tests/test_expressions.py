import math
from datetime import date

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from adperf.functions import bids, dates, numbers, ratings


def values(spark, column, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_half_up_on_the_binary_value(spark):
    assert values(spark, numbers.round_half_up("x"), [(0.125,), (1.005,), (2.675,), (None,)], "x double") == [
        0.13, 1.0, 2.68, None,
    ]


def test_ratio_guards(spark):
    rows = [(5, 100), (5, 0), (None, 10), (5, None), (0, 10)]
    assert values(spark, numbers.percent("a", "b"), rows, "a bigint, b bigint") == [5.0, None, None, None, 0.0]


def test_mean_does_not_depend_on_order(spark):
    xs = [(round(i * 0.37 % 9, 2),) for i in range(1000)]
    df = spark.createDataFrame(xs, "x double")
    means = {df.repartition(n).agg(numbers.mean_of("x")).first()[0] for n in (1, 3, 7)}
    assert len(means) == 1
    assert math.isclose(means.pop(), sum(x for (x,) in xs) / 1000)
    assert df.filter("x < 0").agg(numbers.mean_of("x")).first()[0] is None


def test_clamp_keeps_null(spark):
    assert values(spark, numbers.clamp("x", F.lit(1.0), F.lit(15.0)), [(None,), (0.5,), (20.0,), (3.0,)], "x double") == [
        None, 1.0, 15.0, 3.0,
    ]


def test_text_to_number(spark):
    rows = [("3.5",), ("",), ("x",), (None,), (" 7 ",)]
    assert values(spark, numbers.to_number("x"), rows, "x string") == [3.5, None, None, None, 7.0]


def test_instants(spark):
    rows = [("2024-12-01T12:05:23Z",), ("2024-12-01T12:05:23.000123",), ("2024-12-01T12:05:23",), ("soon",)]
    out = values(spark, dates.iso_text(dates.instant("x")), rows, "x string")
    assert out == ["2024-12-01T12:05:23.000000", "2024-12-01T12:05:23.000123", "2024-12-01T12:05:23.000000", None]


def test_calendar(spark):
    row = spark.createDataFrame([(date(2001, 6, 30),)], "d date").select(
        dates.dow0("d"), dates.day_name(dates.dow0("d")), dates.week_start("d"), dates.month_start("d"),
        dates.is_weekend(dates.dow0("d")),
    ).first()
    assert list(row) == [6, "Saturday", date(2001, 6, 25), date(2001, 6, 1), 1]


def test_rating_edges(spark):
    ctr = values(spark, ratings.ctr_rating("x"), [(2.51,), (2.5,), (1.5,), (0.8,), (None,)], "x double")
    assert ctr == ["Excellent", "Good", "Fair", "Needs improvement", "Needs improvement"]
    cpc = values(spark, ratings.cpc_rating("x"), [(4.99,), (5.0,), (8.0,), (12.0,), (None,)], "x double")
    assert cpc == ["Excellent", "Good", "Fair", "Too expensive", "Too expensive"]
    category = values(spark, ratings.performance_category("x"), [(3.0,), (1.5,), (0.5,), (0.49,), (None,)], "x double")
    assert category == ["high", "medium", "low", "very_low", "very_low"]
    pacing = values(
        spark, ratings.pacing_status("s", "b"),
        [(79.9, 100.0), (80.0, 100.0), (110.0, 100.0), (110.2, 100.0), (1.0, 0.0), (None, 1.0)], "s double, b double",
    )
    assert pacing == ["Under-pacing", "On track", "On track", "Over-pacing", "Over-pacing", "On track"]


def test_retention(spark):
    rows = [(89, "raw"), (90, "raw"), (29, "processed"), (30, "processed"), (90, "processed")]
    assert values(spark, ratings.retention_tier("a", "k"), rows, "a int, k string") == [
        "hot", "delete", "hot", "infrequent", "archive",
    ]


CASES = [
    # ctr, rate, cpc, training target, next bid
    (None, 5.0, 4.0, 4.0, None),
    (0.0, 5.0, 4.0, 4.0, 4.0),
    (0.1, 50.0, 4.0, 8.0, 6.0),
    (50.0, 50.0, 4.0, 2.0, 2.8),
    (2.0, 0.0, 4.0, 4.0, 4.0),
    (2.0, None, 4.0, 4.0, 4.0),
    (2.0, 0.001, 4.0, 1.0, 4.0),
    (0.5, 99.0, 15.0, 20.0, 15.0),
    (9.0, 50.0, 0.5, 1.0, 1.0),
    (2.0, 50.0, None, None, None),
]


@pytest.mark.parametrize("ctr, rate, cpc, target, following", CASES)
def test_bids(spark, ctr, rate, cpc, target, following):
    df = spark.createDataFrame([(ctr, rate, cpc)], "ctr double, rate double, cpc double")
    row = df.select(bids.optimal_bid("ctr", "rate", "cpc"), bids.heuristic_bid("ctr", "cpc")).first()
    assert list(row) == [target, following]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 60), st.floats(0, 100), st.floats(0.01, 50)), min_size=1, max_size=50))
def test_bid_ranges(spark, rows):
    df = spark.createDataFrame(rows, "ctr double, rate double, cpc double")
    for r in df.select("*", bids.optimal_bid("ctr", "rate", "cpc").alias("a"), bids.heuristic_bid("ctr", "cpc").alias("b")).collect():
        assert r.a == r.cpc or 1 <= r.a <= 20
        assert r.b == r.cpc or 1 <= r.b <= 15


def test_sql_functions_equal_the_columns(spark):
    from adperf.functions import sql

    spark.createDataFrame([], "report_date date, creative_id string, total_impressions bigint, total_clicks bigint, ctr_percent double, avg_cpc double, total_conversions bigint, cost_per_conversion double").createOrReplaceTempView("creative_performance")
    sql.register(spark)
    sql.register(spark)  # again: replaced
    values = [None, 0.0, 0.5, 0.8, 1.5, 2.5, 2.675, 3.0, 5.0, 8.0, 11.0, 12.0]
    grid = spark.createDataFrame([(a, b) for a in values for b in values], "a double, b double")
    pairs = {
        "ad_ratio(a, b)": numbers.safe_ratio("a", "b"), "ad_percent(a, b)": numbers.percent("a", "b"),
        "ad_ctr_rating(a)": ratings.ctr_rating("a"), "ad_cpc_rating(a)": ratings.cpc_rating("a"),
        "ad_pacing_status(a, b)": ratings.pacing_status("a", "b"), "ad_performance_category(a)": ratings.performance_category("a"),
    }
    for call, column in pairs.items():
        assert grid.filter(~F.expr(call).eqNullSafe(column)).count() == 0, call
    assert spark.sql("SELECT * FROM ad_creatives(DATE '2024-01-01', 7, 10)").count() == 0
