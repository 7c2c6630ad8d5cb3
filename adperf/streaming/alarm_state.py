"""Alarm states of a metric stream, kept by a stateful operator with event-time timers."""

from __future__ import annotations

import math
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..operators.alarms import CATALOGUE, matched

STATES = "alarm string, period_start bigint, value double, breach boolean, breach_run int, state string"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PREALLOCATE = "spark.sql.streaming.stateStore.rocksdb.allowFAllocate"
CLOCK = "clock"


def slices(metrics: DataFrame, alarms, delay: str) -> DataFrame:
    """Partial sums of each alarm's metric per slice, the longest time that divides every alarm's period.

    A metric that holds a third of all rows reaches the alarms' state as one row per slice, summed before the shuffle.
    """
    width = reduce(math.gcd, [a.period for a in alarms])
    rows = matched(metrics.withWatermark("ts", delay), alarms)
    value = F.nanvl("value", F.lit(None).cast("double"))
    sums = rows.groupBy("alarm", F.window("ts", f"{width} seconds")).agg(F.sum(value).alias("total"), F.count(value).alias("n"))
    return sums.select(
        "alarm", F.window_time("window").alias("ts"), F.unix_timestamp("window.start").alias("start"), F.coalesce("total", F.lit(0.0)).alias("total"), "n"
    )


def alarm_processor(alarms) -> StatefulProcessor:
    """The operator that keeps one alarm's open periods, its next period and its run of breaches.

    A class of this function's own, so that it travels to the workers with the job.
    """
    rules = {a.name: (a.period, a.stat, a.op, a.threshold, a.periods, a.missing) for a in alarms}

    class AlarmPeriods(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            self.open = handle.getMapState("open", "start bigint", "total double, n bigint")
            self.place = handle.getValueState("place", "next bigint, run int")

        def handleInputRows(self, key, rows, timerValues):
            period = rules[key[0]][0]
            first = None
            for row in rows:
                start = row.start - row.start % period
                total, n = self.open.getValue((start,)) if self.open.containsKey((start,)) else (0.0, 0)
                self.open.updateValue((start,), (total + row.total, n + row.n))
                first = start if first is None else min(first, start)
            if first is not None and (not self.place.exists() or first < self.place.get()[0]):
                # Before the first state of an alarm, an earlier period may still come.
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer)
                self.place.update((first, 0))
                self.handle.registerTimer((first + period) * 1000)
            return iter(())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            from pyspark.sql import Row

            period, stat, op, threshold, periods, missing = rules[key[0]]
            until = timerValues.getCurrentWatermarkInMs() // 1000
            start, run = self.place.get()
            while start + period <= until:
                total, n = 0.0, 0
                if self.open.containsKey((start,)):
                    total, n = self.open.getValue((start,))
                    self.open.removeKey((start,))
                value = None
                if n and math.isfinite(total):
                    value = math.floor((total / n if stat == "Average" else total) * 1e6 + 0.5) / 1e6
                breach = value is not None and (
                    value > threshold if op == ">" else value >= threshold if op == ">=" else value < threshold if op == "<" else value <= threshold
                )
                run = run + 1 if breach else 0
                state = "ALARM" if run >= periods else "INSUFFICIENT_DATA" if value is None and missing == "missing" else "OK"
                yield Row(alarm=key[0], period_start=start, value=value, breach=breach, breach_run=run, state=state)
                start += period
            self.place.update((start, run))
            self.handle.registerTimer((start + period) * 1000)

        def close(self):
            pass

    return AlarmPeriods()


def alarm_states(metrics: DataFrame, alarms=CATALOGUE, delay: str = "1 day") -> DataFrame:
    """A stream of the state of every alarm in every period, each once, when the watermark has passed the period's end.

    Event-time timers close the periods, so one without data is emitted too, as long as the watermark moves on: with rows of
    any metric, or of the clock (``tick``). Periods begin with an alarm's first data. Rows later than ``delay`` are dropped by
    the watermark; ``rollup.alarms_of_batch`` evaluates stored rows anew. Values that are NULL or no number count as absent.

    State holds an alarm's open periods, at most ``delay`` over the period's length and one more, whatever its history.
    """
    found = slices(metrics, alarms, delay).groupBy("alarm").transformWithState(alarm_processor(alarms), STATES, "append", "eventTime")
    return found.withColumn("period_start", F.timestamp_seconds("period_start"))


def run_alarm_states(
    metrics: DataFrame, out: str, checkpoint: str, alarms=CATALOGUE, delay: str = "1 day", partitions: int = 4
) -> DataFrame:
    """Runs ``alarm_states`` over the rows that are there and appends the states of closed periods to ``out``.

    The next run continues from ``checkpoint``, where the state is kept as well, so it must be a folder all executors
    reach. Timers and maps need the RocksDB state store, with files of its own for each of the ``partitions`` of state. Their
    disk space is not allocated in advance, which would be megabytes for a few states each. Rows reach these summed, so a
    few partitions suffice for hundreds of alarms, however many the metric rows; the first run's number holds. The session's settings are put back afterwards.
    """
    spark = metrics.sparkSession
    settings = {PROVIDER: ROCKSDB, PREALLOCATE: "false", "spark.sql.shuffle.partitions": str(partitions)}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        states = alarm_states(metrics, alarms, delay)
        sink = states.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        sink.outputMode("append").trigger(availableNow=True).start().awaitTermination()
        return spark.read.schema(states.schema).parquet(out)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def tick(spark: SparkSession, at: datetime, schema) -> DataFrame:
    """A metric row no alarm reads, whose time moves the watermark on where no other metric reports."""
    given = {"ts": F.lit(at), "namespace": F.lit(CLOCK), "name": F.lit(CLOCK), "value": F.lit(1.0)}
    columns = [given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).select(*columns)
