"""The base views over exploded elements.

Every view is one hash aggregation with partial sums before the shuffle, so a campaign or creative
holding a large share of the rows reaches its reducer as one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import dow0
from ..functions.numbers import percent, safe_ratio

SUMS = ["impressions", "clicks", "cost", "conversions", "unique_impressions"]


def measured(elements: DataFrame) -> DataFrame:
    """Elements with an impression count."""
    return elements.filter(F.col("impressions").isNotNull())


def _sums(names, prefix: str = ""):
    return [F.sum(n).alias(n if n.startswith("unique") else prefix + n) for n in names]


def creative_performance(elements: DataFrame) -> DataFrame:
    """Daily totals and ratios per campaign and creative."""
    sums = measured(elements).groupBy("report_date", "campaign_id", "creative_id").agg(*_sums(SUMS, "total_"))
    return with_creative_ratios(sums)


def with_creative_ratios(sums: DataFrame) -> DataFrame:
    return sums.withColumns(
        {
            "ctr_percent": percent("total_clicks", "total_impressions"),
            "avg_cpc": safe_ratio("total_cost", "total_clicks"),
            "cost_per_conversion": safe_ratio("total_cost", "total_conversions"),
            "conversion_rate_percent": percent("total_conversions", "total_clicks"),
        }
    )


def daily_summary(elements: DataFrame) -> DataFrame:
    """Daily totals and ratios per campaign configuration."""
    keys = ["report_date", "campaign_id", "campaign_name", "campaign_status", "daily_budget", "unit_cost"]
    sums = measured(elements).groupBy(*keys).agg(*_sums(SUMS))
    return sums.withColumns(
        {
            "ctr": percent("clicks", "impressions"),
            "cpc": safe_ratio("cost", "clicks"),
            "cpa": safe_ratio("cost", "conversions"),
            "conversion_rate": percent("conversions", "clicks"),
        }
    )


def campaign_totals(elements: DataFrame) -> DataFrame:
    """All-time totals per campaign.

    Days are summed first: counting distinct days over (campaign, day) rows needs no expansion of
    the raw rows.
    """
    names = SUMS[:4]
    daily = measured(elements).groupBy("campaign_id", "campaign_name", "report_date").agg(*_sums(names))
    totals = daily.groupBy("campaign_id", "campaign_name").agg(
        F.min("report_date").alias("first_seen"),
        F.max("report_date").alias("last_seen"),
        F.count("report_date").alias("days_active"),
        *_sums(names, "total_"),
    )
    return totals.withColumns(
        {
            "overall_ctr": percent("total_clicks", "total_impressions"),
            "overall_cpc": safe_ratio("total_cost", "total_clicks"),
            "overall_cpa": safe_ratio("total_cost", "total_conversions"),
            "overall_conversion_rate": percent("total_conversions", "total_clicks"),
        }
    )


def hourly_breakdown(elements: DataFrame) -> DataFrame:
    """Totals per date, hour, weekday, campaign and creative."""
    keyed = measured(elements).withColumns({"hour_of_day": F.hour("pulled_ts"), "day_of_week": dow0("pulled_ts")})
    keys = ["report_date", "hour_of_day", "day_of_week", "campaign_id", "creative_id"]
    return (
        keyed.groupBy(*keys)
        .agg(*_sums(SUMS[:3]))
        .withColumns({"ctr": percent("clicks", "impressions"), "cpc": safe_ratio("cost", "clicks")})
    )


def latest_pull(elements: DataFrame, day: str = "report_date") -> DataFrame:
    """Daily totals from the last pull of each (day, campaign, creative) only.

    Pulls of one day overlap, so summing them counts impressions more than once. ``day`` may be the
    pull date or the element's own date. Two mergeable aggregations instead of a ranking window: no
    task has to sort all rows of a key.
    """
    keys = [day, "campaign_id", "creative_id"]
    per_pull = measured(elements).groupBy(*keys, "pulled_ts").agg(*_sums(SUMS, "total_"))
    values = [c for c in per_pull.columns if c not in (*keys, "pulled_ts")]
    # One max_by per number: buffers of fixed length stay in the hash aggregate, a struct would sort.
    last = per_pull.groupBy(*keys).agg(
        F.max("pulled_ts").alias("pulled_ts"), *[F.max_by(v, "pulled_ts").alias(v) for v in values]
    )
    return with_creative_ratios(last.withColumnRenamed(day, "report_date"))


def pull_date_rows(elements: DataFrame) -> DataFrame:
    """Distinct (creative, campaign, day)."""
    return elements.select("creative_id", "campaign_id", F.col("report_date").alias("date")).distinct()
