"""Stored aggregates for dashboards."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.dates import week_start
from ..functions.numbers import percent, safe_ratio
from ..functions.ratings import performance_category, retention_tier
from .reports import down, last_days, mean, total, up


def daily_aggregates(cp: DataFrame, as_of: date | None = None, days: int = 90) -> DataFrame:
    """Per day and campaign; ``cp`` holds one row per creative there, so counting rows counts creatives."""
    rows = cp if as_of is None else last_days(cp, as_of, days)
    return rows.groupBy("report_date", "campaign_id").agg(
        F.count("creative_id").alias("total_creatives"),
        total("total_impressions", "impressions"),
        total("total_clicks", "clicks"),
        total("total_cost", "cost"),
        total("total_conversions", "conversions"),
        mean("ctr_percent", "avg_ctr"),
        mean("avg_cpc", "avg_cpc"),
        mean("cost_per_conversion", "avg_cpa"),
    )


def daily_aggregates_report(cp: DataFrame, as_of: date, days: int = 90) -> DataFrame:
    return daily_aggregates(cp, as_of, days).orderBy(down("report_date"), up("campaign_id"))


def weekly_summaries(cp: DataFrame, as_of: date | None = None, days: int = 180) -> DataFrame:
    """Per week and campaign: sums, unweighted means, and ratios of the sums."""
    rows = cp if as_of is None else last_days(cp, as_of, days)
    weekly = rows.groupBy(week_start("report_date").alias("week_start"), "campaign_id").agg(
        total("total_impressions", "impressions"),
        total("total_clicks", "clicks"),
        total("total_cost", "cost"),
        total("total_conversions", "conversions"),
        mean("ctr_percent", "avg_ctr"),
        mean("avg_cpc", "avg_cpc"),
    )
    return weekly.withColumns(
        {
            "cpc": safe_ratio("cost", "clicks"),
            "ctr": percent("clicks", "impressions"),
            "cpa": safe_ratio("cost", "conversions"),
        }
    )


def weekly_summaries_report(cp: DataFrame, as_of: date, days: int = 180) -> DataFrame:
    return weekly_summaries(cp, as_of, days).orderBy(down("week_start"), up("campaign_id"))


def weekly_growth(weekly: DataFrame) -> DataFrame:
    """Change against the campaign's previous week; a campaign has one row per week."""
    previous = Window.partitionBy("campaign_id").orderBy("week_start")
    with_lag = weekly.withColumns(
        {f"previous_{c}": F.lag(c).over(previous) for c in ("impressions", "clicks", "cost", "conversions")}
    )
    growth = {
        f"{c}_growth_percent": safe_ratio(
            (F.col(c) - F.col(f"previous_{c}")).cast("double"), f"previous_{c}", 100.0
        )
        for c in ("impressions", "clicks", "cost", "conversions")
    }
    return with_lag.select("week_start", "campaign_id", *[v.alias(k) for k, v in growth.items()])


def creative_metadata(cp: DataFrame) -> DataFrame:
    """Lifetime totals per creative and campaign; ``cp`` has one row per day, so rows are active days."""
    lifetime = cp.groupBy("creative_id", "campaign_id").agg(
        total("total_impressions", "lifetime_impressions"),
        total("total_clicks", "lifetime_clicks"),
        total("total_cost", "lifetime_cost"),
        total("total_conversions", "lifetime_conversions"),
        mean("ctr_percent", "avg_ctr"),
        mean("avg_cpc", "avg_cpc"),
        F.min("report_date").alias("first_seen"),
        F.max("report_date").alias("last_seen"),
        F.count("report_date").alias("days_active"),
    )
    return lifetime.withColumn("performance_category", performance_category("avg_ctr"))


def creative_metadata_report(cp: DataFrame) -> DataFrame:
    return creative_metadata(cp).orderBy(down("lifetime_impressions"), up("creative_id"), up("campaign_id"))


def with_retention(files: DataFrame, as_of: date, day: str, kind: str) -> DataFrame:
    """Age in days and storage tier of dated rows."""
    age = F.datediff(F.lit(as_of), F.col(day))
    return files.withColumn("age_days", age).withColumn("tier", retention_tier("age_days", F.lit(kind)))


def unexpired(files: DataFrame, as_of: date, day: str, days: int = 90) -> DataFrame:
    """Rows younger than the raw retention; a literal bound on the day column, so partitions prune."""
    return files.filter(F.col(day) > F.date_sub(F.lit(as_of), days))
