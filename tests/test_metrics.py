from datetime import datetime, timedelta

from pyspark.sql import functions as F

from adperf.operators import alarms, metrics

START = datetime(2024, 1, 1)
ROW = "ts timestamp, namespace string, name string, value double, unit string, dimensions map<string,string>"


def series(spark, values, name="CTR", hours=6, dims=None, namespace=metrics.COLLECTOR):
    rows = [
        (START + timedelta(hours=hours * i), namespace, name, float(v), "None", dims)
        for i, v in enumerate(values) if v is not None
    ]
    return spark.createDataFrame(rows, ROW)


def states(spark, values, alarm, **more):
    out = alarms.evaluate_alarms(series(spark, values, alarm.metric, **more), [alarm]).orderBy("period_start")
    return [r.state for r in out.collect()]


def low(n, missing="notBreaching"):
    return alarms.Alarm("low", metrics.COLLECTOR, "CTR", "Average", 21600, "<", 1.0, n, missing)


def test_runs_of_breaches(spark):
    assert states(spark, [2, 0.5, 0.5, 2], low(3)) == ["OK"] * 4
    assert states(spark, [2, 0.5, 0.5, 0.5, 2], low(3)) == ["OK", "OK", "OK", "ALARM", "OK"]
    assert states(spark, [0.5] * 4, low(3)) == ["OK", "OK", "ALARM", "ALARM"]


def test_gap_ends_a_run(spark):
    assert states(spark, [0.5, 0.5, None, 0.5, 0.5, 0.5], low(3)) == ["OK"] * 5 + ["ALARM"]
    assert states(spark, [0.5, None, 0.5], low(1, "missing")) == ["ALARM", "INSUFFICIENT_DATA", "ALARM"]


def test_threshold_is_strict_or_not(spark):
    over = alarms.Alarm("n", metrics.COLLECTOR, "E", "Sum", 21600, ">", 1.0, 1)
    at = alarms.Alarm("n", metrics.COLLECTOR, "E", "Sum", 21600, ">=", 1.0, 1)
    assert states(spark, [1, 2], over) == ["OK", "ALARM"]
    assert states(spark, [1, 2], at) == ["ALARM", "ALARM"]


def test_sum_and_average_over_a_period(spark):
    total = alarms.Alarm("spend", metrics.COLLECTOR, "TotalCost", "Sum", 86400, ">", 100.0, 1)
    assert states(spark, [30, 30, 30, 30, 10], total) == ["ALARM", "OK"]
    mean = alarms.Alarm("cpc", metrics.COLLECTOR, "CPC", "Average", 86400, ">", 8.0, 1)
    assert states(spark, [7, 7, 10, 10, 8], mean) == ["ALARM", "OK"]


def test_dimension_of_function_alarms(spark):
    rows = series(spark, [1], "Errors", dims={"FunctionName": "optimizer"}, namespace=alarms.FUNCTIONS)
    hit = alarms.evaluate_alarms(rows, alarms.CATALOGUE).collect()
    assert [(r.alarm, r.state) for r in hit] == [("optimizer-errors", "ALARM")]


def test_no_data_no_states(spark):
    assert alarms.evaluate_alarms(metrics.empty_metrics(spark), alarms.CATALOGUE).isEmpty()


def test_transitions(spark):
    out = alarms.transitions(alarms.evaluate_alarms(series(spark, [0.5, 0.5, 2, 2, 0.5]), [low(1)]))
    got = [(r.previous_state, r.state) for r in out.orderBy("period_start").collect()]
    assert got == [("OK", "ALARM"), ("ALARM", "OK"), ("OK", "ALARM")]


def test_catalogue_size():
    assert len(alarms.CATALOGUE) == 13 and len({a.name for a in alarms.CATALOGUE}) == 13


def test_collector_totals_without_data(spark, elements):
    row = metrics.collector_totals(elements([("2024-12-01", 6, "a", "x", None, None, None, None)])).first()
    assert (row.total_impressions, row.total_clicks, row.total_cost, row.ctr, row.cpc) == (0, 0, 0.0, None, None)


def test_run_without_impressions_reports_no_ctr(spark, elements):
    rows = metrics.collector_metrics(elements([("2024-12-01", 6, "a", "x", 0, 0, 0.0, 0)])).collect()
    assert sorted(r.name for r in rows) == ["SuccessfulPulls", "TotalClicks", "TotalCost", "TotalImpressions"]


def test_alarms_over_stored_metrics(spark, tmp_path):
    from adperf.streaming import rollup

    path = str(tmp_path / "metrics")
    series(spark, [0.5, 0.5, 0.5]).write.parquet(path)
    series(spark, [None, None, None, 0.5, 2]).write.mode("append").parquet(path)
    since = START + timedelta(hours=6)
    out = rollup.alarms_of_batch(spark, path, since, [low(3)]).orderBy("period_start").collect()
    assert [r.state for r in out] == ["OK", "ALARM", "ALARM", "OK"]
    whole = alarms.evaluate_alarms(spark.read.parquet(path), [low(3)]).filter(F.col("period_start") >= F.lit(since))
    assert [r.state for r in whole.orderBy("period_start").collect()] == [r.state for r in out]
