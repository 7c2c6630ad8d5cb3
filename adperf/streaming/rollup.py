"""Streaming metric roll-up."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.alarms import CATALOGUE, evaluate_alarms
from ..operators.metrics import event_rollup
from ..sources.tables import pull_metrics_from
from .ingest import Store, one_of, touched_periods

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def stream_events(spark: SparkSession, folder: str, name: str = "events.parquet") -> DataFrame:
    rows = spark.readStream.schema(EVENTS).option("pathGlobFilter", name).parquet(folder)
    return pull_metrics_from(rows)


def closed_windows(pulls: DataFrame, period: str = "6 hours", delay: str = "1 day", keys=()) -> DataFrame:
    """Tumbling windows, each emitted once when the watermark has passed its end."""
    return event_rollup(pulls.withWatermark("ts", delay), period, keys)


def run_rollup(windows: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """Runs the stream over what is available, appending closed windows to ``out``."""
    query = (
        windows.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return windows.sparkSession.read.schema(windows.schema).parquet(out)


def run_whole_rollup(pulls: DataFrame, out: str, checkpoint: str, period: str = "6 hours", keys=()) -> DataFrame:
    """Runs the stream over what is available; ``out`` then holds the windows of all rows so far, open ones included.

    Rows are kept by day of their window and by batch, and the days that a batch touches are computed anew, so a row
    counts however late it is. A batch that runs again replaces its own partitions. A new checkpoint numbers its batches
    anew and needs a new ``out``.
    """
    spark = pulls.sparkSession
    store = Store(spark, out)
    rows_path, windows_path = store.path("pulls"), store.path("windows")

    def write(rows: DataFrame, path: str, *by: str) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)

    def process(batch: DataFrame, batch_id: int) -> None:
        day = F.to_date(F.window("ts", period)["start"]).alias("period")
        rows = batch.select(*pulls.columns, day).withColumn("batch", F.lit(batch_id).cast("bigint"))
        write(rows, rows_path, "period", "batch")
        kept = batch.sparkSession.read.schema(rows.schema).parquet(rows_path)
        days = touched_periods(kept.filter(F.col("batch") == batch_id))
        if days:
            windows = event_rollup(kept.filter(one_of("period", days)), period, keys)
            write(windows.withColumn("period", F.to_date("period_start")).hint("rebalance", "period"), windows_path, "period")

    query = pulls.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    none = event_rollup(spark.createDataFrame([], pulls.schema), period, keys)
    return spark.read.schema(none.schema).parquet(windows_path).select(*none.columns) if store.exists("windows") else none


def alarms_of_batch(spark: SparkSession, metric_path: str, since, alarms=CATALOGUE) -> DataFrame:
    """Alarm states of the periods from the one of ``since`` on, for use after each micro-batch.

    Reads as many earlier periods as the alarms look back on, so the states equal those over the whole history;
    ``breach_run`` counts no further back than that.
    """
    metrics = spark.read.parquet(metric_path)
    back = max((a.period * a.periods for a in alarms), default=0)
    states = evaluate_alarms(metrics.filter(metrics.ts >= since - timedelta(seconds=back)), alarms)
    length = F.create_map(*[F.lit(x) for a in alarms for x in (a.name, a.period)])[F.col("alarm")]
    return states.filter(F.unix_timestamp("period_start") + length > F.unix_timestamp(F.lit(since)))
