"""Lifetime totals from mergeable states, folded from the months a batch touched.

A state is one row per creative, or per campaign, and month: sums, the whole-number sums behind the means, the first and the last day,
and the active days as the bits of one number. Two states of a key merge exactly: sums and counts add up, days unite
by ``bit_or`` and are counted by their bits, so a day counts once however many rows name it. A batch rewrites
the states of its months from the stored daily rows of those months, and a lifetime is folded from at most one row a month; no other
daily row and no element is read.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import percent, safe_ratio
from ..functions.ratings import performance_category
from ..operators.views import SUMS, measured
from ..sources.sinks import with_period, write_partitioned

TOTALS = SUMS[:4]
CREATIVE, CAMPAIGN = ["creative_id", "campaign_id"], ["campaign_id", "campaign_name"]
CREATIVE_STATE = (
    "creative_id string, campaign_id string, impressions bigint, clicks bigint, cost double, conversions bigint, "
    "ctr_units bigint, ctr_count bigint, cpc_units bigint, cpc_count bigint, first_seen date, last_seen date, days bigint, month date"
)
CAMPAIGN_STATE = (
    "campaign_id string, campaign_name string, impressions bigint, clicks bigint, cost double, conversions bigint, "
    "first_seen date, last_seen date, days bigint, month date"
)


def _days() -> list[Column]:
    """First and last day, and the days of the month as bits; a row without a day has none."""
    bit = F.expr("shiftleft(1L, dayofmonth(report_date) - 1)")
    days = F.coalesce(F.bit_or(bit), F.lit(0).cast("bigint"))
    return [F.min("report_date").alias("first_seen"), F.max("report_date").alias("last_seen"), days.alias("days")]


def _mean_parts(name: str, alias: str, digits: int = 2) -> list[Column]:
    units = F.sum(F.floor(F.col(name) * F.lit(float(10**digits)) + F.lit(0.5)))
    return [F.coalesce(units, F.lit(0)).cast("bigint").alias(f"{alias}_units"), F.count(name).alias(f"{alias}_count")]


def creative_states(cp: DataFrame) -> DataFrame:
    """One row per creative, campaign and month of daily rows (``creative_performance``)."""
    sums = [F.sum(f"total_{n}").alias(n) for n in TOTALS]
    return (
        cp.groupBy(*CREATIVE, F.trunc("report_date", "month").alias("month"))
        .agg(*sums, *_mean_parts("ctr_percent", "ctr"), *_mean_parts("avg_cpc", "cpc"), *_days())
    )


def campaign_days(elements: DataFrame) -> DataFrame:
    """Daily sums per campaign and name: what the campaigns' states are made from."""
    return measured(elements).groupBy(*CAMPAIGN, "report_date").agg(*[F.sum(n).alias(n) for n in TOTALS])


def campaign_states(days: DataFrame) -> DataFrame:
    """One row per campaign, name and month of ``campaign_days``."""
    grouped = days.groupBy(*CAMPAIGN, F.trunc("report_date", "month").alias("month"))
    return grouped.agg(*[F.sum(n).alias(n) for n in TOTALS], *_days())


def merge(states: DataFrame, keys: list[str]) -> DataFrame:
    """States of a key and month into one: of disjoint or equal days, in any order."""
    added = [c for c in states.columns if c not in (*keys, "month", "first_seen", "last_seen", "days")]
    return states.groupBy(*keys, "month").agg(
        *[F.sum(c).alias(c) for c in added],
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.bit_or("days").alias("days"),
    )


def _folded(states: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    parts = [c for c in states.columns if c.endswith(("_units", "_count"))]
    return states.groupBy(*keys).agg(
        *[F.sum(n).alias(f"{prefix}{n}") for n in TOTALS],
        *[F.sum(c).alias(c) for c in parts],
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.sum(F.bit_count("days").cast("bigint")).alias("days_active"),
    )


def _mean(alias: str, digits: int = 2) -> Column:
    return F.col(f"{alias}_units") / F.nullif(F.col(f"{alias}_count") * F.lit(float(10**digits)), F.lit(0.0))


def creative_lifetimes(states: DataFrame) -> DataFrame:
    """The creative metadata (lifetime totals, means, days, category) of creative states."""
    rows = _folded(states, CREATIVE, "lifetime_").withColumns({"avg_ctr": _mean("ctr"), "avg_cpc": _mean("cpc")})
    rows = rows.drop("ctr_units", "ctr_count", "cpc_units", "cpc_count")
    return rows.withColumn("performance_category", performance_category("avg_ctr"))


def campaign_lifetimes(states: DataFrame) -> DataFrame:
    """The campaign totals of campaign states."""
    return _folded(states, CAMPAIGN, "total_").withColumns(
        {
            "overall_ctr": percent("total_clicks", "total_impressions"),
            "overall_cpc": safe_ratio("total_cost", "total_clicks"),
            "overall_cpa": safe_ratio("total_cost", "total_conversions"),
            "overall_conversion_rate": percent("total_conversions", "total_clicks"),
        }
    )


def months_of(periods: list[date | None]) -> list[date | None]:
    """The months of some periods (days or months), None for undated ones."""
    months = {p.replace(day=1) for p in periods if p is not None}
    return sorted(months) + [None] * (None in periods)


def refresh(store, elements: DataFrame, periods: list[date | None], left: list[date | None]) -> None:
    """Rewrites the campaigns' days of ``periods``, whose ``elements`` hold (periods in ``left`` have rows), and the states of their months."""
    from .ingest import one_of, touched_periods

    days = with_period(campaign_days(elements), "report_date", store.unit)
    write_partitioned(days, store.path("campaign_days"), "period")
    store.drop_periods("campaign_days", [p for p in periods if p not in left])
    months = months_of(periods)
    dated = [m for m in months if m is not None]
    of_months = one_of("period", store.periods_of_months(dated) + [None] * (None in months))
    daily = {
        "creative_states": creative_states(store.table("creative_performance").filter(of_months)),
        "campaign_states": campaign_states(store.table("campaign_days").filter(of_months)),
    }
    for name, states in daily.items():
        rows = states.withColumn("period", F.col("month"))
        write_partitioned(rows, store.path(name), "period")
        held = touched_periods(store.table("campaign_days").filter(of_months).select(F.trunc("period", "month").alias("period")))
        store.drop_periods(name, [m for m in months if m not in held])


def creatives(store) -> DataFrame:
    """Lifetimes of all creatives of a store."""
    return creative_lifetimes(store.spark.read.schema(CREATIVE_STATE).parquet(store.path("creative_states")))


def campaigns(store) -> DataFrame:
    """Lifetimes of all campaigns of a store."""
    return campaign_lifetimes(store.spark.read.schema(CAMPAIGN_STATE).parquet(store.path("campaign_states")))
