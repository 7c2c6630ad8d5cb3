"""Rounding, guarded ratios and order-independent means."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_column(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_half_up(x, digits: int = 2) -> Column:
    """Half-up on the binary value: the same cell in every engine, unlike ``round`` on doubles."""
    scale = F.lit(float(10**digits))
    return F.floor(as_column(x) * scale + F.lit(0.5)) / scale


def safe_ratio(num, den, scale: float = 1.0, digits: int | None = 2) -> Column:
    """``num * scale / den``, NULL when the denominator is 0 or NULL."""
    n = as_column(num).cast("double")
    if scale != 1.0:
        n = n * F.lit(scale)
    ratio = n / F.nullif(as_column(den).cast("double"), F.lit(0.0))
    return ratio if digits is None else round_half_up(ratio, digits)


def percent(num, den, digits: int | None = 2) -> Column:
    return safe_ratio(num, den, 100.0, digits)


def mean_of(x, digits: int = 2) -> Column:
    """Mean of values carrying ``digits`` decimals, summed as scaled integers.

    An integer sum does not depend on the order in which partitions are merged, so a recomputed
    task or another partition count cannot move a group across a threshold.
    """
    scale = 10**digits
    units = F.floor(as_column(x) * F.lit(float(scale)) + F.lit(0.5))
    return F.sum(units) / F.nullif(F.count(as_column(x)) * F.lit(float(scale)), F.lit(0.0))


def clamp(x, low, high) -> Column:
    """``x`` limited to [low, high]; NULL stays NULL (``greatest``/``least`` would skip it)."""
    x = as_column(x)
    return F.when(x.isNotNull(), F.greatest(low, F.least(high, x)))


def to_number(x) -> Column:
    """Text to double; blank or malformed text becomes NULL."""
    return F.trim(as_column(x)).try_cast("double")
