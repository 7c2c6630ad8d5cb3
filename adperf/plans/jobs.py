"""The daily jobs: processing, optimisation, copy patterns and training.

A view used by several outputs is written once and read back, so each output is an independent job
over the stored view and a lost executor costs one task, not the chain.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import decisions, metrics, models, reports, training
from ..operators.aggregates import creative_metadata, daily_aggregates, weekly_summaries
from ..operators.reports import last_days
from ..operators.views import creative_performance
from ..settings import Thresholds
from ..streaming import lifetime
from ..streaming.ingest import Store
from ..sources.sinks import (
    append_actions,
    with_period,
    write_creative_metadata,
    write_partitioned,
    write_training_set,
)


BID_DAYS = 30  # whose elements the bid training set reads


def store(df: DataFrame, path: str) -> DataFrame:
    """Writes ``df`` and returns the table read back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_daily(df: DataFrame, path: str, unit: str = "day") -> DataFrame:
    """Writes a daily view by period; filters on ``period`` then read only its days or months."""
    write_partitioned(with_period(df, "report_date", unit), path, "period")
    return df.sparkSession.read.parquet(path)


def stored_days(view: DataFrame, as_of: date, days: int, unit: str = "day") -> DataFrame:
    """The last days of a view written by ``store_daily``; partitions outside them are not read."""
    first = as_of - timedelta(days=days)
    if unit == "month":
        first = first.replace(day=1)
    return view.filter(F.col("period").between(F.lit(first), F.lit(as_of))).drop("period")


def run_processing(
    spark: SparkSession, elements: DataFrame, content: DataFrame, root: str, as_of: date, at: datetime,
    unit: str = "day",
) -> DataFrame:
    """Training sets, dashboard aggregates, and the metric rows describing them, from an element table."""
    cp = store_daily(creative_performance(elements), f"{root}/creative_performance", unit)
    return _outputs(spark, cp, elements, creative_metadata(cp), content, root, as_of, at, unit)


def run_daily(store_of: Store, content: DataFrame, root: str, as_of: date, at: datetime) -> DataFrame:
    """The same outputs from the store that the ingest keeps: its daily rows of the windows, the elements of the bid window's
    periods, and lifetimes folded from monthly states. Nothing reads the whole history."""
    cp = store_of.table("creative_performance")
    first, last = as_of - timedelta(days=BID_DAYS), as_of + timedelta(days=1)
    if store_of.unit == "month":
        first = first.replace(day=1)
    elements = store_of.current([first + timedelta(days=i) for i in range((last - first).days)])
    return _outputs(store_of.spark, cp, elements, lifetime.creatives(store_of), content, root, as_of, at, store_of.unit)


def _outputs(
    spark: SparkSession, cp: DataFrame, elements: DataFrame, metadata: DataFrame, content: DataFrame, root: str, as_of: date,
    at: datetime, unit: str,
) -> DataFrame:
    """Writes the outputs of the processing job; ``cp`` is partitioned by period."""
    creative_paths = write_training_set(
        training.creative_training_set(stored_days(cp, as_of, 60, unit), content, as_of), root, "creative_scoring", at
    )
    bid_paths = write_training_set(training.bid_training_set(elements, as_of), root, "bid_optimization", at)
    write_partitioned(daily_aggregates(stored_days(cp, as_of, 90, unit), as_of), f"{root}/aggregates/daily")
    # From a Monday on: a week that is replaced has all its days.
    first = as_of - timedelta(days=180)
    whole_weeks = last_days(stored_days(cp, as_of, 180 + first.weekday(), unit), as_of, 180 + first.weekday())
    write_partitioned(weekly_summaries(whole_weeks), f"{root}/aggregates/weekly", "week_start")
    write_creative_metadata(metadata, f"{root}/aggregates")
    manifest = metrics.manifest_of(
        {
            "creative_scoring": spark.read.parquet(creative_paths["parquet"]),
            "bid_optimization": spark.read.parquet(bid_paths["parquet"]),
        },
        ["daily", "weekly", "creative_metadata"],
    )
    return metrics.processor_metrics(manifest, at)


@dataclass
class Optimisation:
    actions: DataFrame
    log: DataFrame
    report: DataFrame
    metrics: DataFrame


def run_optimisation(
    cp: DataFrame, root: str, as_of: date, at: datetime, t: Thresholds = Thresholds(),
    predicted: DataFrame | None = None,
) -> Optimisation | None:
    """Decisions of the day, appended to the action log; None when no creative has enough clicks.

    Bids use all creatives, those just paused included.
    """
    stamp = at.strftime("%Y%m%d_%H%M%S")
    perf = store(
        decisions.performance(cp, as_of, min_clicks=t.min_sample), f"{root}/optimizer/performance/run_ts={stamp}"
    )
    if perf.isEmpty():
        return None
    actions = store(
        decisions.all_actions(decisions.creative_actions(perf, t), decisions.bid_actions(perf, t, predicted)),
        f"{root}/optimizer/actions/run_ts={stamp}",
    )
    log = decisions.log_rows(actions, at)
    append_actions(log, f"{root}/logs/optimizer_actions")
    report = decisions.report_lines(perf, t)
    rows = metrics.optimizer_metrics(perf, decisions.classify_creatives(perf, t), actions, at, t)
    return Optimisation(actions, log, report, rows)


def run_copy_patterns(cp: DataFrame, as_of: date) -> DataFrame:
    """What the winning creatives of the last 30 days have in common."""
    return reports.winning_patterns(reports.winning_creatives(cp, as_of))


def run_training(
    prepared: DataFrame, features, pipeline, target: str, keys, registry: models.ModelRegistry, name: str,
    model_type: str, at: datetime,
) -> int:
    """Fits on the training part, evaluates on both parts and publishes the next version."""
    train, test = models.split(prepared, *keys)
    model = models.fit(pipeline, train)
    scored = {
        part: models.evaluate(model.transform(rows), target).first().asDict()
        for part, rows in (("train", train), ("test", test))
    }
    metrics_row = {f"{part}_{k}": v for part, row in scored.items() for k, v in row.items()}
    return registry.publish(name, model, model_type, metrics_row, features, target, at)
