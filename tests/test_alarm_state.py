"""Alarm states kept by a stream against the evaluation of whole tables."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from adperf.operators import alarms
from adperf.streaming import alarm_state

NOON = datetime(2024, 3, 1, 12)
RULES = [
    alarms.Alarm("cost", "n", "Cost", "Sum", 3600, ">", 5.0, 2),
    alarms.Alarm("errors", "n", "Errors", "Sum", 1800, ">=", 1.0, 1, "missing", "FunctionName=a"),
    alarms.Alarm("ctr", "n", "CTR", "Average", 3600, "<", 1.0, 1),
]
SCHEMA = "ts timestamp, namespace string, name string, value double, unit string, dimensions map<string,string>"


def at(minutes):
    return NOON + timedelta(minutes=minutes)


def run_parts(spark, tmp_path, parts, delay="1 hour"):
    rows_path, out, progress = (str(tmp_path / n) for n in ("rows", "out", "progress"))
    for part in parts:
        part.write.mode("append").parquet(rows_path)
        stream = spark.readStream.schema(SCHEMA).parquet(rows_path)
        states = alarm_state.run_alarm_states(stream, out, progress, RULES, delay)
    return {(r.alarm, r.period_start): (r.value, r.breach, r.breach_run, r.state) for r in states.collect()}, states


def test_states_over_runs(spark, tmp_path):
    a = {"FunctionName": "a"}
    runs = [
        [(at(10), "n", "Cost", 4.0, None, None), (at(70), "n", "Cost", 6.0, None, None), (at(5), "n", "Errors", 1.0, None, a), (at(20), "n", "CTR", None, None, None)],
        # Out of order by less than the delay; another function's errors do not count.
        [(at(30), "n", "Cost", 3.0, None, None), (at(15), "n", "CTR", 0.5, None, None), (at(100), "n", "Errors", 9.0, None, {"FunctionName": "b"})],
        [(at(310), "n", "Cost", 7.0, None, None), (at(200), "n", "Errors", 2.0, None, a), (at(320), "n", "CTR", 2.0, None, a)],
    ]
    rows = [spark.createDataFrame(r, SCHEMA) for r in runs]
    before = spark.conf.get(alarm_state.PROVIDER)
    found, _ = run_parts(spark, tmp_path, [*rows, alarm_state.tick(spark, at(600), rows[0].schema)])
    assert spark.conf.get(alarm_state.PROVIDER) == before
    whole = rows[0].unionByName(rows[1]).unionByName(rows[2])
    wanted = {(r.alarm, r.period_start): (r.value, r.breach, r.breach_run, r.state) for r in alarms.evaluate_alarms(whole, RULES).collect()}
    assert {k: found[k] for k in wanted} == wanted
    assert found["cost", at(60)] == (6.0, True, 2, "ALARM")
    # Timers go on where an alarm's data end: until an hour, the delay, before the clock.
    later = {k: v for k, v in found.items() if k not in wanted}
    assert later and all(v[:3] == (None, False, 0) for v in later.values())
    assert {v[3] for k, v in later.items() if k[0] == "errors"} == {"INSUFFICIENT_DATA"}
    assert {v[3] for k, v in later.items() if k[0] == "cost"} == {"OK"}
    assert max(k[1] for k in found if k[0] == "errors") in (at(480), at(510))


def test_each_period_is_emitted_once_and_open_ones_wait(spark, tmp_path):
    first = spark.createDataFrame([(at(10), "n", "Cost", 9.0, None, None), (at(130), "n", "Cost", 9.0, None, None)], SCHEMA)
    late = spark.createDataFrame([(at(20), "n", "Cost", 100.0, None, None)], SCHEMA)
    found, states = run_parts(spark, tmp_path, [first, late])
    assert found == {("cost", at(0)): (9.0, True, 1, "OK")}  # the watermark is at 70 minutes: the late row is dropped
    assert states.groupBy("alarm", "period_start").count().filter(F.col("count") > 1).isEmpty()


def test_no_rows(spark, tmp_path):
    found, _ = run_parts(spark, tmp_path, [spark.createDataFrame([], SCHEMA)])
    assert found == {}
