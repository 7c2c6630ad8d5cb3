"""Rules as data: which creatives to pause or scale, which bids to change, and the log of it."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.bids import heuristic_bid
from ..functions.dates import dow0
from ..functions.numbers import clamp, mean_of, round_half_up
from ..functions.text import money, thousands
from ..settings import Thresholds
from .reports import down, last_days, mean, total, up

DEFAULTS = Thresholds()


def performance(cp: DataFrame, as_of: date, days: int = 7, min_clicks: int = 100) -> DataFrame:
    """Decision input per creative and campaign; ``cp`` has one row per day, so rows are active days."""
    grouped = last_days(cp, as_of, days).groupBy("creative_id", "campaign_id").agg(
        mean("ctr_percent", "avg_ctr"),
        mean("avg_cpc", "avg_cpc"),
        total("total_clicks"),
        total("total_impressions"),
        total("total_cost"),
        total("total_conversions"),
        F.count("report_date").alias("days_active"),
    )
    return grouped.filter(F.col("total_clicks") >= min_clicks)


def performance_report(cp: DataFrame, as_of: date, days: int = 7, min_clicks: int = 100) -> DataFrame:
    return performance(cp, as_of, days, min_clicks).orderBy(down("avg_ctr"), up("creative_id"), up("campaign_id"))


def _measure(name: str) -> Column:
    """A metrics map with ctr or cpc, clicks and cost."""
    return F.create_map(
        F.lit(name),
        F.col(f"avg_{name}"),
        F.lit("clicks"),
        F.col("total_clicks").cast("double"),
        F.lit("cost"),
        F.col("total_cost"),
    )


def classify_creatives(perf: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """Every creative with the first rule that holds, or none; comparisons with NULL do not hold."""
    ctr, cpc = F.col("avg_ctr"), F.col("avg_cpc")
    low = (ctr < t.min_ctr) & (F.col("total_clicks") >= t.min_sample)
    rules = (
        F.when(
            low,
            F.struct(
                F.lit("paused").alias("action"),
                F.concat(F.lit("Low CTR ("), money(ctr), F.lit("%) below threshold")).alias("reason"),
                _measure("ctr").alias("metrics"),
            ),
        )
        .when(
            cpc > t.max_cpc,
            F.struct(
                F.lit("paused").alias("action"),
                F.concat(F.lit("High CPC ($"), money(cpc), F.lit(") above threshold")).alias("reason"),
                _measure("cpc").alias("metrics"),
            ),
        )
        .when(
            ctr > t.top_ctr,
            F.struct(
                F.lit("top_performer").alias("action"),
                F.concat(F.lit("High CTR ("), money(ctr), F.lit("%) - candidate for scaling")).alias("reason"),
                _measure("ctr").alias("metrics"),
            ),
        )
    )
    return perf.withColumn("rule", rules).select(*perf.columns, "rule.*")


def creative_actions(perf: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    return classify_creatives(perf, t).filter(F.col("action").isNotNull()).select(
        "action", "creative_id", "campaign_id", "reason", "metrics"
    )


def campaign_rollup(perf: DataFrame) -> DataFrame:
    """Unweighted means over the campaign's creatives, and total cost."""
    return perf.groupBy("campaign_id").agg(
        mean_of("avg_ctr", 6).alias("avg_ctr"),
        mean_of("avg_cpc", 6).alias("avg_cpc"),
        total("total_cost"),
    )


def propose_bids(perf: DataFrame, t: Thresholds = DEFAULTS, predicted: DataFrame | None = None) -> DataFrame:
    """Current and proposed bid per campaign.

    ``predicted`` (campaign_id, predicted_bid), a model's output, replaces the formula where present.
    """
    rolled = campaign_rollup(perf)
    formula = heuristic_bid("avg_ctr", "avg_cpc", t.target_ctr)
    if predicted is None:
        bids = rolled.withColumns({"new_bid": formula, "bid_source": F.lit("heuristic")})
    else:
        joined = rolled.join(predicted.select("campaign_id", "predicted_bid"), "campaign_id", "left")
        bids = joined.withColumns(
            {
                "new_bid": F.coalesce(round_half_up(clamp(F.col("predicted_bid"), F.lit(1.0), F.lit(15.0))), formula),
                "bid_source": F.when(F.col("predicted_bid").isNotNull(), "model").otherwise("heuristic"),
            }
        ).drop("predicted_bid")
    return bids.withColumnRenamed("avg_cpc", "old_bid").withColumn("change", F.col("new_bid") - F.col("old_bid"))


def bid_actions(perf: DataFrame, t: Thresholds = DEFAULTS, predicted: DataFrame | None = None) -> DataFrame:
    """Bid changes of at least the threshold."""
    changed = propose_bids(perf, t, predicted).filter(F.abs("change") >= t.bid_change)
    return changed.select(
        F.lit("bid_adjustment").alias("action"),
        "campaign_id",
        "old_bid",
        "new_bid",
        "change",
        F.concat(F.lit("Bid optimization: $"), money("old_bid"), F.lit(" → $"), money("new_bid")).alias("reason"),
    )


def all_actions(creative: DataFrame, bids: DataFrame) -> DataFrame:
    """Creative and bid actions as one table; columns of the other kind are NULL."""
    return creative.unionByName(bids, allowMissingColumns=True)


def log_rows(actions: DataFrame, at: datetime) -> DataFrame:
    """Action table rows in the form of the log; nothing has been applied at this point."""
    kind = (
        F.when(F.col("action") == "paused", "pause_creative")
        .when(F.col("action") == "top_performer", "identify_winner")
        .when(F.col("action") == "bid_adjustment", "adjust_bid")
    )
    bid_metrics = F.create_map(
        F.lit("old_bid"), F.col("old_bid"), F.lit("new_bid"), F.col("new_bid"), F.lit("change"), F.col("change")
    )
    is_bid = F.col("action") == "bid_adjustment"
    return actions.select(
        F.lit(at).cast("timestamp").alias("timestamp"),
        kind.alias("action_type"),
        F.when(is_bid, F.col("campaign_id")).otherwise(F.col("creative_id")).alias("resource_id"),
        F.col("reason").alias("details"),
        F.when(is_bid, bid_metrics).otherwise(F.col("metrics")).alias("metrics"),
        F.lit(False).alias("applied"),
    )


def change_payload(actions: DataFrame) -> DataFrame:
    """The change request of each pause and bid action as JSON; other actions change nothing."""
    pause = F.to_json(F.struct(F.lit("PAUSED").alias("status")))
    bid = F.to_json(
        F.struct(F.struct(money("new_bid").alias("amount"), F.lit("USD").alias("currencyCode")).alias("unitCost"))
    )
    is_bid = F.col("action") == "bid_adjustment"
    rows = actions.select(
        "action",
        F.when(is_bid, F.col("campaign_id")).otherwise(F.col("creative_id")).alias("resource_id"),
        F.col("campaign_id"),
        F.when(F.col("action") == "paused", pause).when(is_bid, bid).alias("payload"),
    )
    return rows.filter(F.col("payload").isNotNull())


def campaign_metrics(perf: DataFrame) -> DataFrame:
    """Sums per campaign and the mean CTR of its creatives."""
    return perf.groupBy("campaign_id").agg(
        total("total_impressions"), total("total_clicks"), total("total_cost"), mean_of("avg_ctr", 6).alias("avg_ctr")
    )


def performance_summary(perf: DataFrame) -> DataFrame:
    """One row over all creatives."""
    return perf.agg(
        F.coalesce(F.sum("total_impressions"), F.lit(0)).cast("bigint").alias("total_impressions"),
        F.coalesce(F.sum("total_clicks"), F.lit(0)).cast("bigint").alias("total_clicks"),
        F.coalesce(F.sum("total_cost"), F.lit(0.0)).cast("double").alias("total_cost"),
        mean_of("avg_ctr", 6).alias("avg_ctr"),
        mean_of("avg_cpc", 6).alias("avg_cpc"),
    )


def action_counts(actions: DataFrame) -> DataFrame:
    def count_of(action: str) -> Column:
        return F.count(F.when(F.col("action") == action, F.lit(1)))

    return actions.agg(
        F.count(F.lit(1)).alias("total_actions"),
        count_of("paused").alias("paused"),
        count_of("bid_adjustment").alias("bid_adjustments"),
        count_of("top_performer").alias("top_performers"),
    )


def portfolio_health(classified: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """Creatives in total, left active, above the top and below the minimum CTR."""
    rows = classified.agg(
        F.count(F.lit(1)).alias("total_creatives"),
        F.count(F.when(F.col("action") == "paused", F.lit(1))).alias("paused"),
        F.count(F.when(F.col("avg_ctr") > t.top_ctr, F.lit(1))).alias("high_performers"),
        F.count(F.when(F.col("avg_ctr") < t.min_ctr, F.lit(1))).alias("underperformers"),
    )
    return rows.select(
        "total_creatives",
        (F.col("total_creatives") - F.col("paused")).alias("active_creatives"),
        "high_performers",
        "underperformers",
    )


def report_lines(perf: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """The daily report, one row per line, ordered by (section, sort_key).

    Lines instead of one text value: the number of actions is not bounded.
    """
    creative = creative_actions(perf, t)
    bids = bid_actions(perf, t)
    counts = action_counts(all_actions(creative, bids))
    summary = performance_summary(perf)

    def heading(section: int, label: str, column: str) -> DataFrame:
        line = F.concat(F.lit(f"{label}: "), F.col(column).cast("string"))
        shown = counts if section == 0 else counts.filter(F.col(column) > 0)
        return shown.select(F.lit(section).alias("section"), F.lit("").alias("sort_key"), line.alias("line"))

    def lines(rows: DataFrame, section: int, key: Column, line: Column) -> DataFrame:
        return rows.select(
            F.lit(section).alias("section"), key.alias("sort_key"), F.concat(F.lit("  • "), line).alias("line")
        )

    by_creative = F.concat_ws("/", "creative_id", "campaign_id")
    paused = lines(
        creative.filter(F.col("action") == "paused"),
        1,
        by_creative,
        F.concat(F.col("creative_id"), F.lit(": "), F.col("reason")),
    )
    arrow = F.when(F.col("change") > 0, "↑").otherwise("↓")
    changed = lines(
        bids,
        2,
        F.col("campaign_id"),
        F.concat(
            F.lit("Campaign "), F.col("campaign_id"), F.lit(": $"), money("old_bid"), F.lit(" → $"),
            money("new_bid"), F.lit(" "), arrow,
        ),
    )
    winners = lines(
        creative.filter(F.col("action") == "top_performer"),
        3,
        by_creative,
        F.concat(F.col("creative_id"), F.lit(": CTR "), money(F.col("metrics")["ctr"]), F.lit("%")),
    )
    totals = summary.select(
        F.posexplode(
            F.array(
                F.concat(F.lit("Total Impressions: "), thousands("total_impressions")),
                F.concat(F.lit("Total Clicks: "), thousands("total_clicks")),
                F.concat(F.lit("Total Cost: $"), money("total_cost")),
                F.concat(F.lit("Average CTR: "), money(F.coalesce("avg_ctr", F.lit(0.0))), F.lit("%")),
                F.concat(F.lit("Average CPC: $"), money(F.coalesce("avg_cpc", F.lit(0.0)))),
            )
        ).alias("place", "line")
    ).select(F.lit(4).alias("section"), F.col("place").cast("string").alias("sort_key"), "line")

    parts = [
        heading(0, "ACTIONS TAKEN", "total_actions"),
        heading(1, "PAUSED CREATIVES", "paused"), paused,
        heading(2, "BID ADJUSTMENTS", "bid_adjustments"), changed,
        heading(3, "TOP PERFORMERS", "top_performers"), winners,
        totals,
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.orderBy("section", "sort_key")


def extra_triggers(perf: DataFrame, today: DataFrame, as_of: date, t: Thresholds = DEFAULTS) -> DataFrame:
    """Documented triggers beyond the three rules: variation, lower bid, weekend budget, no impressions.

    ``today`` has one row per campaign: campaign_id, daily_budget, impressions on ``as_of``.
    """
    variation = perf.filter(F.col("avg_ctr") > t.top_ctr).select(
        F.lit("create_variation").alias("trigger"),
        F.col("creative_id").alias("resource_id"),
        "campaign_id",
        F.col("avg_ctr").alias("value"),
    )
    lower = campaign_rollup(perf).filter(F.col("avg_cpc") > t.max_cpc).select(
        F.lit("lower_bid").alias("trigger"),
        F.col("campaign_id").alias("resource_id"),
        "campaign_id",
        F.col("avg_cpc").alias("value"),
    )
    weekend = today.filter(dow0(F.lit(as_of)).isin(0, 6)).select(
        F.lit("reduce_budget").alias("trigger"),
        F.col("campaign_id").alias("resource_id"),
        "campaign_id",
        (F.col("daily_budget") * 0.5).alias("value"),
    )
    unseen = today.filter(F.coalesce(F.col("impressions"), F.lit(0)) == 0).select(
        F.lit("broaden_targeting").alias("trigger"),
        F.col("campaign_id").alias("resource_id"),
        "campaign_id",
        F.lit(0.0).alias("value"),
    )
    return variation.unionByName(lower).unionByName(weekend).unionByName(unseen)


def campaigns_today(ds: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    """Campaigns seen in the last days with their budget and the impressions of ``as_of``."""
    is_today = F.col("report_date") == F.lit(as_of)
    return last_days(ds, as_of, days).groupBy("campaign_id").agg(
        F.max_by("daily_budget", F.struct("report_date", "daily_budget")).alias("daily_budget"),
        F.sum(F.when(is_today, F.col("impressions"))).alias("impressions"),
    )


def independent_rules(perf: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """Variant in which the cost rule is checked besides the CTR rules: up to two rows per creative."""
    ctr, cpc = F.col("ctr"), F.col("cpc")
    by_ctr = F.when(
        (ctr < t.min_ctr) & (F.col("clicks") > t.min_sample),
        F.struct(
            F.lit("paused").alias("action"),
            F.concat(F.lit("CTR "), money(ctr), F.lit("% below threshold")).alias("reason"),
        ),
    ).when(
        ctr > t.top_ctr,
        F.struct(
            F.lit("scaled").alias("action"), F.concat(F.lit("High CTR "), money(ctr), F.lit("%")).alias("reason")
        ),
    )
    by_cost = F.when(
        cpc > t.max_cpc,
        F.struct(
            F.lit("paused").alias("action"),
            F.concat(F.lit("CPC $"), money(cpc), F.lit(" above threshold")).alias("reason"),
        ),
    )
    rows = perf.select("creative_id", F.explode(F.array(by_ctr, by_cost)).alias("rule"))
    return rows.filter(F.col("rule").isNotNull()).select("creative_id", "rule.*")


def prediction_vs_actual(predictions: DataFrame, actuals: DataFrame, key: str) -> DataFrame:
    """Predicted next to realised values and their difference, for keys present in both."""
    return predictions.select(key, "predicted").join(actuals.select(key, "actual"), key).withColumn(
        "difference", F.col("predicted") - F.col("actual")
    )
