"""Metric rows of the collector, the optimizer and the data processor, and their roll-ups."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.dates import instant
from ..functions.numbers import percent, round_half_up, safe_ratio
from ..settings import Thresholds
from ..sources.schema import METRIC_COLUMNS
from .decisions import DEFAULTS, action_counts, campaign_metrics, performance_summary, portfolio_health

COLLECTOR = "adperf/collector"
OPTIMIZER = "adperf/optimizer"
CAMPAIGNS = "adperf/campaigns"
PROCESSOR = "adperf/processor"
NO_DIMENSIONS = "map<string,string>"


def _zero_if_missing(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0))


def collector_totals(elements: DataFrame, keys=()) -> DataFrame:
    """Totals over all elements (absent numbers count 0); CTR and CPC unrounded, NULL without a base."""
    sums = elements.groupBy(*keys).agg(
        _zero_if_missing("impressions").cast("bigint").alias("total_impressions"),
        _zero_if_missing("clicks").cast("bigint").alias("total_clicks"),
        _zero_if_missing("cost").cast("double").alias("total_cost"),
    )
    return sums.withColumns(
        {
            "ctr": percent("total_clicks", "total_impressions", None),
            "cpc": safe_ratio("total_cost", "total_clicks", digits=None),
        }
    )


def pull_success(raw: DataFrame) -> DataFrame:
    """Pulls with data and pulls in which both halves are missing; a pull in several documents counts once."""
    no_analytics = F.col("analytics").isNull() | F.col("analytics.elements").isNull()
    no_config = F.col("campaign_config").isNull() | F.col("campaign_config.id").isNull()
    pulls = raw.groupBy("campaign_id", "pulled_at").agg(F.min(no_analytics & no_config).alias("failed"))
    return pulls.agg(
        F.count_if(~F.col("failed")).alias("successful_pulls"),
        F.count_if(F.col("failed")).alias("failed_pulls"),
    )


def collection_runs(raw: DataFrame) -> DataFrame:
    """Totals, successful and failed pulls of every collection run, the run being the end of the documents' date range.

    A pull in several documents counts once and has failed when both halves are missing in all of them. Totals are added
    inside a document first, so no element is a row of its own.
    """
    elements = F.coalesce("analytics.elements", F.array().cast(raw.schema["analytics"].dataType["elements"].dataType))

    def inside(field: str, zero) -> Column:
        return F.aggregate(elements, zero, lambda total, e: total + F.coalesce(e[field], F.lit(0)))

    no_analytics = F.col("analytics").isNull() | F.col("analytics.elements").isNull()
    no_config = F.col("campaign_config").isNull() | F.col("campaign_config.id").isNull()
    whole = F.lit(0).cast("bigint")
    sums = raw.select(
        instant("date_range.end").alias("run_at"), "campaign_id", "pulled_at", (no_analytics & no_config).alias("failed"),
        inside("impressions", whole).alias("impressions"), inside("clicks", whole).alias("clicks"),
        inside("costInUsd", F.lit(0.0)).alias("cost"),
    )
    pulls = sums.groupBy("run_at", "campaign_id", "pulled_at").agg(
        F.min("failed").alias("failed"), *[F.sum(c).alias(c) for c in ("impressions", "clicks", "cost")]
    )
    runs = pulls.groupBy("run_at").agg(
        *[F.sum(c).alias(f"total_{c}") for c in ("impressions", "clicks", "cost")],
        F.count_if(~F.col("failed")).alias("successful_pulls"),
        F.count_if(F.col("failed")).alias("failed_pulls"),
    )
    return runs.withColumns(
        {
            "ctr": percent("total_clicks", "total_impressions", None),
            "cpc": safe_ratio("total_cost", "total_clicks", digits=None),
            "failure": F.when(F.col("successful_pulls") == 0, F.lit(1)),
        }
    )


def run_metrics(raw: DataFrame) -> DataFrame:
    """Metric rows per collection run: totals, ratios with a base, successful and failed pulls of every run, and
    CollectionFailure for a run of which no pull succeeded."""
    counts = [("SuccessfulPulls", "successful_pulls", "Count"), ("FailedPulls", "failed_pulls", "Count")]
    columns = RUN_METRICS + counts + [("CollectionFailure", "failure", "Count")]
    return long_rows(collection_runs(raw), F.col("run_at"), COLLECTOR, columns)


def long_rows(df: DataFrame, ts: Column, namespace: str, columns, dimensions: Column | None = None) -> DataFrame:
    """Wide totals to metric rows; ``columns`` lists (metric name, column name, unit).

    A metric without a value is not reported.
    """
    items = F.array(
        *[
            F.struct(F.lit(name).alias("name"), F.col(col).cast("double").alias("value"), F.lit(unit).alias("unit"))
            for name, col, unit in columns
        ]
    )
    dims = F.lit(None).cast(NO_DIMENSIONS) if dimensions is None else dimensions
    rows = df.select(
        ts.cast("timestamp").alias("ts"),
        F.lit(namespace).alias("namespace"),
        dims.alias("dimensions"),
        F.explode(items).alias("item"),
    )
    out = rows.select("ts", "namespace", "item.*", "dimensions").filter(F.col("value").isNotNull())
    return out.select(*METRIC_COLUMNS)


RUN_METRICS = [
    ("TotalImpressions", "total_impressions", "Count"),
    ("TotalClicks", "total_clicks", "Count"),
    ("TotalCost", "total_cost", "None"),
    ("CTR", "ctr", "Percent"),
    ("CPC", "cpc", "None"),
]


def collector_metrics(elements: DataFrame) -> DataFrame:
    """Metric rows per collection run (all campaigns pulled at one instant)."""
    per_campaign = elements.groupBy("pulled_ts", "campaign_id").agg(
        F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"), F.sum("cost").alias("cost")
    )
    pulls = per_campaign.groupBy("pulled_ts").agg(
        _zero_if_missing("impressions").cast("bigint").alias("total_impressions"),
        _zero_if_missing("clicks").cast("bigint").alias("total_clicks"),
        _zero_if_missing("cost").cast("double").alias("total_cost"),
        F.count(F.lit(1)).alias("successful_pulls"),
    )
    runs = pulls.withColumns(
        {
            "ctr": percent("total_clicks", "total_impressions", None),
            "cpc": safe_ratio("total_cost", "total_clicks", digits=None),
        }
    )
    columns = RUN_METRICS + [("SuccessfulPulls", "successful_pulls", "Count")]
    return long_rows(runs, F.col("pulled_ts"), COLLECTOR, columns)


def event_metrics(pulls: DataFrame, run: str = "6 hours") -> DataFrame:
    """Metric rows of event data, a run being a tumbling window; errors count as failures."""
    runs = event_rollup(pulls, run)
    columns = [
        ("TotalImpressions", "impressions", "Count"),
        ("TotalClicks", "clicks", "Count"),
        ("TotalCost", "cost", "None"),
        ("CTR", "ctr", "Percent"),
        ("CPC", "cpc", "None"),
        ("CollectionFailure", "errors", "Count"),
    ]
    return long_rows(runs, F.col("period_start"), COLLECTOR, columns)


def optimizer_metrics(
    perf: DataFrame, classified: DataFrame, actions: DataFrame, at: datetime, t: Thresholds = DEFAULTS
) -> DataFrame:
    """15 metrics over all creatives and two per campaign."""
    one_row = (
        action_counts(actions)
        .crossJoin(performance_summary(perf))
        .crossJoin(portfolio_health(classified, t))
    )
    overall = long_rows(
        one_row,
        F.lit(at),
        OPTIMIZER,
        [
            ("TotalActions", "total_actions", "Count"),
            ("CreativesPaused", "paused", "Count"),
            ("BidAdjustments", "bid_adjustments", "Count"),
            ("TopPerformersIdentified", "top_performers", "Count"),
            ("TotalImpressions", "total_impressions", "Count"),
            ("TotalClicks", "total_clicks", "Count"),
            ("TotalCost", "total_cost", "None"),
            ("AverageCTR", "avg_ctr", "Percent"),
            ("AverageCPC", "avg_cpc", "None"),
            ("TotalCreatives", "total_creatives", "Count"),
            ("ActiveCreatives", "active_creatives", "Count"),
            ("HighPerformers", "high_performers", "Count"),
            ("Underperformers", "underperformers", "Count"),
            ("CostPerClick", "avg_cpc", "None"),
            ("ClickThroughRate", "avg_ctr", "Percent"),
        ],
    )
    per_campaign = long_rows(
        campaign_metrics(perf),
        F.lit(at),
        CAMPAIGNS,
        [("Impressions", "total_impressions", "Count"), ("CTR", "avg_ctr", "Percent")],
        F.create_map(F.lit("CampaignId"), F.col("campaign_id")),
    )
    return overall.unionByName(per_campaign)


def manifest_of(datasets: dict[str, DataFrame], aggregates: list[str]) -> DataFrame:
    """Rows and columns of each data set, and the aggregates that were written."""
    kind = {True: "dataset", False: "aggregate"}
    parts = [
        df.agg(F.count(F.lit(1)).alias("samples")).select(
            F.lit(kind[True]).alias("kind"),
            F.lit(name).alias("type"),
            "samples",
            F.lit(len(df.columns)).cast("bigint").alias("features"),
        )
        for name, df in datasets.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    names = F.explode(F.array(*[F.lit(a) for a in aggregates])).alias("type")
    extra = parts[0].select(
        F.lit(kind[False]).alias("kind"),
        names,
        F.lit(None).cast("bigint").alias("samples"),
        F.lit(None).cast("bigint").alias("features"),
    )
    return out.unionByName(extra)


def processor_metrics(manifest: DataFrame, at: datetime, success: bool = True) -> DataFrame:
    """Data sets and aggregates written, samples and features per data set, and the outcome."""
    is_dataset = F.col("kind") == "dataset"
    totals = manifest.agg(
        F.count(F.when(is_dataset, F.lit(1))).alias("datasets"),
        _zero_if_missing("samples").cast("bigint").alias("samples"),
        F.count(F.when(~is_dataset, F.lit(1))).alias("aggregates"),
        F.lit(1).alias("outcome"),
    )
    overall = long_rows(
        totals,
        F.lit(at),
        PROCESSOR,
        [
            ("DatasetsCreated", "datasets", "Count"),
            ("TotalTrainingSamples", "samples", "Count"),
            ("AggregatesCreated", "aggregates", "Count"),
            ("ProcessingSuccess" if success else "ProcessingFailure", "outcome", "Count"),
        ],
    )
    per_set = long_rows(
        manifest.filter(is_dataset),
        F.lit(at),
        PROCESSOR,
        [("DatasetSamples", "samples", "Count"), ("DatasetFeatures", "features", "Count")],
        F.create_map(F.lit("DatasetType"), F.col("type")),
    )
    return overall.unionByName(per_set)


def union_metrics(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def event_rollup(pulls: DataFrame, period: str, keys=()) -> DataFrame:
    """Sums and ratios of event data per tumbling window; works on batch and streaming input."""
    grouped = pulls.groupBy(F.window("ts", period).alias("w"), *keys).agg(
        F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"),
        F.sum("conversions").alias("conversions"),
        F.sum("errors").alias("errors"),
        F.count(F.lit(1)).alias("executions"),
        F.sum("cost").alias("cost"),
    )
    return grouped.select(
        F.col("w.start").alias("period_start"),
        *keys,
        "impressions",
        "clicks",
        "conversions",
        "errors",
        "executions",
        round_half_up("cost", 6).alias("cost"),
        percent("clicks", "impressions").alias("ctr"),
        safe_ratio(round_half_up("cost", 6), "clicks").alias("cpc"),
    )


def metric_rollup(metrics: DataFrame, period: str) -> DataFrame:
    """Sum, average and count of each metric per tumbling window."""
    grouped = metrics.groupBy("namespace", "name", F.window("ts", period).alias("w")).agg(
        F.sum("value").alias("total"), F.avg("value").alias("average"), F.count("value").alias("samples")
    )
    return grouped.select(
        "namespace",
        "name",
        F.col("w.start").alias("period_start"),
        round_half_up("total", 6).alias("total"),
        round_half_up("average", 6).alias("average"),
        "samples",
    )


def dashboard_series(pulls: DataFrame, period: str = "6 hours") -> DataFrame:
    """The dashboard's series in long form: impressions, clicks, spend, CTR, CPC, executions, errors."""
    wide = event_rollup(pulls, period)
    chart = [
        ("Impressions & Clicks", "TotalImpressions", "impressions"),
        ("Impressions & Clicks", "TotalClicks", "clicks"),
        ("Ad Spend ($)", "TotalCost", "cost"),
        ("CTR (%)", "CTR", "ctr"),
        ("CPC ($)", "CPC", "cpc"),
        ("Executions", "Invocations", "executions"),
        ("Executions", "Errors", "errors"),
    ]
    items = F.array(
        *[
            F.struct(F.lit(w).alias("widget"), F.lit(s).alias("series"), F.col(c).cast("double").alias("value"))
            for w, s, c in chart
        ]
    )
    return wide.select("period_start", F.explode(items).alias("item")).select("period_start", "item.*")


def latest_events(log: DataFrame, pattern: str, k: int = 20) -> DataFrame:
    """The last ``k`` log rows whose message matches."""
    return log.filter(F.col("message").rlike(pattern)).orderBy(
        F.col("ts").desc_nulls_last(), F.col("event_id").desc_nulls_last()
    ).limit(k)


def empty_metrics(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [], "ts timestamp, namespace string, name string, value double, unit string, dimensions map<string,string>"
    )
