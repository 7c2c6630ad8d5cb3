"""Threshold alarms over metric rows."""

from __future__ import annotations

from dataclasses import astuple, dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numbers import round_half_up
from .metrics import COLLECTOR

FUNCTIONS = "adperf/functions"


@dataclass(frozen=True)
class Alarm:
    """``stat`` of ``metric`` per ``period`` seconds compared with ``threshold`` in ``periods`` periods in a row.

    ``missing``: a period without data is "notBreaching", or "missing" (state INSUFFICIENT_DATA).
    ``dimension``: "key=value" the metric rows must carry, or "" for any.
    """

    name: str
    namespace: str
    metric: str
    stat: str
    period: int
    op: str
    threshold: float
    periods: int
    missing: str = "notBreaching"
    dimension: str = ""


# The alarm catalogue.
CATALOGUE = [
    Alarm("collector-errors", FUNCTIONS, "Errors", "Sum", 3600, ">", 1.0, 1, "notBreaching", "FunctionName=collector"),
    Alarm("collection-failures", COLLECTOR, "CollectionFailure", "Sum", 21600, ">", 0.0, 2),
    Alarm("high-daily-spend", COLLECTOR, "TotalCost", "Sum", 86400, ">", 100.0, 1),
    Alarm("low-ctr", COLLECTOR, "CTR", "Average", 21600, "<", 1.0, 3),
    Alarm("high-cpc", COLLECTOR, "CPC", "Average", 21600, ">", 8.0, 2),
]
for _function in ("data-processor", "optimizer", "copy-generator", "token-rotator"):
    _on = f"FunctionName={_function}"
    CATALOGUE += [
        Alarm(f"{_function}-errors", FUNCTIONS, "Errors", "Sum", 300, ">=", 1.0, 1, "missing", _on),
        Alarm(f"{_function}-duration", FUNCTIONS, "Duration", "Average", 300, ">", 240000.0, 2, "missing", _on),
    ]

RULE_SCHEMA = (
    "alarm string, namespace string, name string, stat string, period bigint, op string, threshold double, "
    "periods int, missing string, dimension string"
)


def rule_table(spark, alarms) -> DataFrame:
    return spark.createDataFrame([astuple(a) for a in alarms], RULE_SCHEMA)


def _breaches(value: Column) -> Column:
    threshold = F.col("threshold")
    return (
        F.when(F.col("op") == ">", value > threshold)
        .when(F.col("op") == ">=", value >= threshold)
        .when(F.col("op") == "<", value < threshold)
        .when(F.col("op") == "<=", value <= threshold)
    )


def matched(metrics: DataFrame, alarms) -> DataFrame:
    """Metric rows with each alarm that reads them.

    The rule table has one row per configured alarm, hence the broadcast.
    """
    rules = F.broadcast(rule_table(metrics.sparkSession, alarms))
    key = F.split_part("dimension", F.lit("="), F.lit(1))
    wanted = F.split_part("dimension", F.lit("="), F.lit(2))
    applies = (F.col("dimension") == "") | F.coalesce(F.try_element_at("dimensions", key) == wanted, F.lit(False))
    return metrics.join(rules, ["namespace", "name"]).filter(applies)


def alarm_periods(metrics: DataFrame, alarms) -> DataFrame:
    """Each alarm's statistic per period that has data.

    One pass over the metric rows for all alarms and periods, with the period start computed per rule.
    """
    rows = matched(metrics, alarms)
    seconds = F.unix_timestamp("ts")
    start = F.timestamp_seconds(seconds - F.pmod(seconds, F.col("period")))
    settings = ["alarm", "stat", "period", "op", "threshold", "periods", "missing"]
    sums = rows.groupBy(*settings, start.alias("period_start")).agg(
        F.sum("value").alias("total"), F.count("value").alias("n")
    )
    value = F.when(F.col("stat") == "Average", F.col("total") / F.col("n")).otherwise(F.col("total"))
    return sums.withColumn("value", round_half_up(value, 6)).drop("total", "n")


def evaluate(periods: DataFrame) -> DataFrame:
    """State of every alarm in every period between its first and last data.

    A period without data does not breach. The alarm is on when the last ``periods`` periods all
    breach. The window sorts one alarm's periods: their number is elapsed time over period length,
    whatever the number of metric rows.
    """
    order = Window.partitionBy("alarm").orderBy("period_start")
    # Each period with data fills the gap up to the next one.
    start, following = F.unix_timestamp("period_start"), F.unix_timestamp(F.lead("period_start").over(order))
    until = F.coalesce(F.col("following") - F.col("period"), F.col("start"))
    filled = periods.withColumns({"start": start, "following": following}).withColumn(
        "second", F.explode(F.sequence("start", until, "period"))
    )
    seen = filled.withColumns(
        {
            "period_start": F.timestamp_seconds("second"),
            "value": F.when(F.col("second") == F.col("start"), F.col("value")),
        }
    )
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = seen.withColumns(
        {"breach": F.coalesce(_breaches(F.col("value")), F.lit(False)), "nr": F.row_number().over(order)}
    )
    last_ok = F.coalesce(F.max(F.when(~F.col("breach"), F.col("nr"))).over(so_far), F.lit(0))
    run = numbered.withColumn("breach_run", F.when(F.col("breach"), F.col("nr") - last_ok).otherwise(F.lit(0)))
    state = (
        F.when(F.col("breach_run") >= F.col("periods"), "ALARM")
        .when(F.col("value").isNull() & (F.col("missing") == "missing"), "INSUFFICIENT_DATA")
        .otherwise("OK")
    )
    return run.withColumn("state", state).select(
        "alarm", "period_start", "value", "breach", "breach_run", "state"
    )


def evaluate_alarms(metrics: DataFrame, alarms=CATALOGUE) -> DataFrame:
    return evaluate(alarm_periods(metrics, alarms))


def transitions(states: DataFrame) -> DataFrame:
    """Periods in which an alarm changes state, and its first period if that is an alarm."""
    before = F.lag("state").over(Window.partitionBy("alarm").orderBy("period_start"))
    changed = states.withColumn("previous_state", F.coalesce(before, F.lit("OK")))
    return changed.filter(F.col("state") != F.col("previous_state")).select(
        "alarm", "period_start", "previous_state", "state", "value"
    )
