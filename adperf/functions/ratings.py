"""Rating labels. NULL takes the last label in every chain."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .numbers import as_column


def ctr_rating(ctr) -> Column:
    c = as_column(ctr)
    return (
        F.when(c > 2.5, "Excellent").when(c > 1.5, "Good").when(c > 0.8, "Fair").otherwise("Needs improvement")
    )


def cpc_rating(cpc) -> Column:
    c = as_column(cpc)
    return F.when(c < 5, "Excellent").when(c < 8, "Good").when(c < 12, "Fair").otherwise("Too expensive")


def pacing_status(spend, budget) -> Column:
    s, b = as_column(spend), as_column(budget)
    return F.when(s < b * 0.8, "Under-pacing").when(s > b * 1.1, "Over-pacing").otherwise("On track")


def performance_category(ctr) -> Column:
    c = as_column(ctr)
    return F.when(c >= 3.0, "high").when(c >= 1.5, "medium").when(c >= 0.5, "low").otherwise("very_low")


def retention_tier(age_days, kind) -> Column:
    """Storage tier by age: raw data is deleted after 90 days, processed data moves at 30 and 90."""
    age, kind = as_column(age_days), as_column(kind)
    raw = F.when(age >= 90, "delete").otherwise("hot")
    processed = F.when(age >= 90, "archive").when(age >= 30, "infrequent").otherwise("hot")
    return F.when(kind == "raw", raw).otherwise(processed)
