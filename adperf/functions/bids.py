"""Bid formulas."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .numbers import as_column, clamp, round_half_up


def optimal_bid(ctr, conversion_rate, cpc, target_ctr: float = 2.0, max_cpa: float = 100.0) -> Column:
    """Training target: cpc scaled towards the CTR target, limited by the cost a conversion may have."""
    ctr, rate, cpc = as_column(ctr), as_column(conversion_rate), as_column(cpc)
    scaled = cpc * clamp(F.lit(target_ctr) / F.nullif(ctr, F.lit(0.0)), F.lit(0.5), F.lit(2.0))
    affordable = F.lit(max_cpa) * rate / F.lit(100.0)
    limited = F.when(rate > 0, F.least(scaled, affordable)).otherwise(scaled)
    bid = round_half_up(clamp(limited, F.lit(1.0), F.lit(20.0)))
    return F.when(ctr.isNull() | cpc.isNull() | (ctr == 0), cpc).otherwise(bid)


def heuristic_bid(ctr, cpc, target_ctr: float = 2.0) -> Column:
    """Next bid: at most +50 % / -30 % of the current cpc, inside [1, 15]."""
    ctr, cpc = as_column(ctr), as_column(cpc)
    scaled = cpc * (F.lit(target_ctr) / F.nullif(ctr, F.lit(0.0)))
    limited = clamp(scaled, cpc * F.lit(0.7), cpc * F.lit(1.5))
    return F.when(ctr == 0, cpc).otherwise(round_half_up(clamp(limited, F.lit(1.0), F.lit(15.0))))
