"""Instants, report dates and calendar columns (UTC)."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, functions as F

from .numbers import as_column

DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def instant(iso_text) -> Column:
    """ISO-8601 text, with or without zone, to a timestamp; unreadable text becomes NULL."""
    return as_column(iso_text).try_cast("timestamp")


def iso_text(ts) -> Column:
    return F.date_format(as_column(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def file_stamp(ts) -> Column:
    return F.date_format(as_column(ts), "yyyyMMdd_HHmmss")


def within(d, as_of: date, days: int) -> Column:
    """``as_of - days <= d <= as_of`` with both bounds as literals, so a partition column prunes."""
    return as_column(d).between(F.lit(as_of - timedelta(days=days)), F.lit(as_of))


def dow0(d) -> Column:
    """Day of week, 0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(as_column(d)) - F.lit(1)


def day_name(dow) -> Column:
    names = F.array(*[F.lit(n) for n in DAY_NAMES])
    return F.get(names, as_column(dow))


def week_start(d) -> Column:
    """Monday of the week."""
    return F.date_trunc("week", as_column(d)).cast("date")


def month_start(d) -> Column:
    return F.trunc(as_column(d), "month")


def is_weekend(dow) -> Column:
    return as_column(dow).isin(0, 6).cast("int")


def is_business_hours(hour) -> Column:
    return as_column(hour).between(9, 17).cast("int")


def is_peak_hours(hour) -> Column:
    return as_column(hour).between(10, 14).cast("int")


def cyclic(x, period: int) -> tuple[Column, Column]:
    """Sine and cosine of ``x`` on a circle of ``period`` steps."""
    angle = F.lit(2.0) * F.pi() * as_column(x) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)
