"""Report queries over the base views.

Each takes a view (computed or stored) and the reference date. The date predicate is on the view's
grouping key, so it moves below the aggregation or prunes partitions of a stored view. Averages of
daily ratios are unweighted, as the report defines them.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import day_name, dow0, instant, month_start, week_start, within
from ..functions.numbers import mean_of, percent, safe_ratio
from ..functions.ratings import cpc_rating, ctr_rating, pacing_status
from ..functions.text import money


def last_days(view: DataFrame, as_of: date, days: int) -> DataFrame:
    return view.filter(within("report_date", as_of, days))


def total(name: str, alias: str | None = None):
    return F.sum(name).alias(alias or name)


def mean(name: str, alias: str, digits: int = 2):
    return mean_of(name, digits).alias(alias)


def down(name: str):
    return F.col(name).desc_nulls_last()


def up(name: str):
    return F.col(name).asc_nulls_last()


def top_creatives(cp: DataFrame, as_of: date, days: int = 7, min_clicks: int = 10, k: int = 10) -> DataFrame:
    grouped = last_days(cp, as_of, days).groupBy("creative_id").agg(
        total("total_impressions", "impressions"),
        total("total_clicks", "clicks"),
        mean("ctr_percent", "avg_ctr"),
        mean("avg_cpc", "avg_cpc"),
        total("total_conversions", "conversions"),
        mean("cost_per_conversion", "avg_cpa"),
    )
    return grouped.filter(F.col("clicks") > min_clicks).orderBy(down("avg_ctr"), up("creative_id")).limit(k)


def underperforming(
    cp: DataFrame, as_of: date, days: int = 3, min_clicks: int = 100, max_ctr: float = 1.0
) -> DataFrame:
    grouped = last_days(cp, as_of, days).groupBy("creative_id").agg(
        total("total_impressions", "impressions"),
        total("total_clicks", "clicks"),
        mean("ctr_percent", "avg_ctr"),
        mean("avg_cpc", "avg_cpc"),
        total("total_cost", "total_spent"),
    )
    weak = grouped.filter((F.col("clicks") > min_clicks) & (F.col("avg_ctr") < max_ctr))
    return weak.orderBy(down("total_spent"), up("creative_id"))


def daily_trend(ds: DataFrame, as_of: date, days: int = 30, descending: bool = True) -> DataFrame:
    grouped = last_days(ds, as_of, days).groupBy("report_date").agg(
        total("impressions", "total_impressions"),
        total("clicks", "total_clicks"),
        total("cost", "total_cost"),
        total("conversions", "total_conversions"),
        mean("ctr", "avg_ctr"),
        mean("cpc", "avg_cpc"),
        mean("cpa", "avg_cpa"),
    )
    return grouped.orderBy(down("report_date") if descending else up("report_date"))


def budget_pacing(ds: DataFrame, as_of: date) -> DataFrame:
    spent = (
        ds.filter(F.col("report_date") == F.lit(as_of))
        .groupBy("campaign_id", "campaign_name", "daily_budget")
        .agg(total("cost", "actual_spend"))
    )
    return spent.withColumns(
        {
            "pacing_percent": percent("actual_spend", "daily_budget", 1),
            "status": pacing_status("actual_spend", "daily_budget"),
        }
    )


def weekly_spend(ds: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    weekly = (
        last_days(ds, as_of, days)
        .groupBy("campaign_id", "campaign_name", week_start("report_date").alias("week"))
        .agg(total("cost", "weekly_spend"), total("conversions", "weekly_conversions"))
        .withColumn("weekly_cpa", safe_ratio("weekly_spend", "weekly_conversions"))
    )
    return weekly.orderBy(down("week"), down("weekly_spend"), up("campaign_id"))


def ready_to_scale(
    cp: DataFrame,
    as_of: date,
    days: int = 7,
    min_clicks: int = 100,
    min_ctr: float = 3.0,
    max_cpc: float = 8.0,
    min_conversions: int = 2,
) -> DataFrame:
    grouped = last_days(cp, as_of, days).groupBy("creative_id", "campaign_id").agg(
        total("total_impressions", "impressions"),
        total("total_clicks", "clicks"),
        mean("ctr_percent", "avg_ctr"),
        mean("avg_cpc", "avg_cpc"),
        total("total_conversions", "conversions"),
        mean("conversion_rate_percent", "conversion_rate"),
    )
    strong = grouped.filter(
        (F.col("clicks") > min_clicks)
        & (F.col("avg_ctr") > min_ctr)
        & (F.col("avg_cpc") < max_cpc)
        & (F.col("conversions") > min_conversions)
    )
    return strong.orderBy(down("avg_ctr"), up("creative_id"), up("campaign_id"))


def expensive_low_conversion(
    cp: DataFrame, as_of: date, days: int = 7, min_spend: float = 100.0, max_rate: float = 2.0
) -> DataFrame:
    grouped = last_days(cp, as_of, days).groupBy("creative_id", "campaign_id").agg(
        total("total_cost", "total_spent"),
        total("total_clicks", "clicks"),
        total("total_conversions", "conversions"),
        mean("avg_cpc", "avg_cpc"),
        mean("conversion_rate_percent", "conversion_rate"),
    )
    poor = (F.col("conversions") == 0) | (F.col("conversion_rate") < max_rate)
    return grouped.filter((F.col("total_spent") > min_spend) & poor).orderBy(
        down("total_spent"), up("creative_id"), up("campaign_id")
    )


def campaign_health(totals: DataFrame) -> DataFrame:
    return totals.select(
        "campaign_name",
        "days_active",
        "total_impressions",
        "total_clicks",
        "total_cost",
        "total_conversions",
        "overall_ctr",
        "overall_cpc",
        "overall_cpa",
        ctr_rating("overall_ctr").alias("ctr_rating"),
        cpc_rating("overall_cpc").alias("cpc_rating"),
    ).orderBy(down("total_cost"), up("campaign_name"))


def day_of_week(ds: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    grouped = (
        last_days(ds, as_of, days)
        .groupBy(dow0("report_date").alias("day_of_week"))
        .agg(
            F.count(F.lit(1)).alias("data_points"),
            mean("ctr", "avg_ctr"),
            mean("cpc", "avg_cpc"),
            mean("conversion_rate", "avg_conversion_rate"),
        )
    )
    return grouped.withColumn("day_name", day_name("day_of_week")).orderBy("day_of_week")


def _pulls(raw: DataFrame, as_of: date, days: int) -> DataFrame:
    """One row per (day, campaign, pull) with its documents and how many of them are empty.

    The pieces of a split pull count as one document.
    """
    elements = F.col("analytics.elements")
    empty = elements.isNull() | (F.size(elements) == 0)
    piece = F.col("part").isNotNull().cast("int") if "part" in raw.columns else F.lit(0)
    dated = last_days(raw.withColumn("report_date", F.to_date(instant("pulled_at"))), as_of, days)
    pulls = dated.groupBy("report_date", "campaign_id", "pulled_at").agg(
        F.max(piece).alias("split"),
        F.count(F.lit(1)).alias("documents"),
        F.sum(empty.cast("bigint")).alias("empty"),
    )
    one = F.lit(1).cast("bigint")
    whole = F.when(F.col("split") > 0, one).otherwise(F.col("documents"))
    # A pull in pieces is empty when all of them are.
    empty_pull = F.when(F.col("split") > 0, (F.col("empty") == F.col("documents")).cast("bigint")).otherwise(F.col("empty"))
    return pulls.withColumns({"documents": whole, "empty": empty_pull})


def missing_data(raw: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """Pulls per day, campaigns seen, and pulls without elements."""
    return (
        _pulls(raw, as_of, days)
        .groupBy("report_date")
        .agg(
            F.sum("documents").alias("pull_count"),
            F.countDistinct("campaign_id").alias("unique_campaigns"),
            F.sum("empty").alias("empty_pulls"),
        )
        .orderBy(down("report_date"))
    )


def collection_frequency(raw: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """Pulls per day with the first and the last pull."""
    return (
        _pulls(raw, as_of, days)
        .groupBy("report_date")
        .agg(
            F.sum("documents").alias("pulls_per_day"),
            F.min("pulled_at").alias("first_pull"),
            F.max("pulled_at").alias("last_pull"),
        )
        .orderBy(down("report_date"))
    )


def winning_creatives(
    cp: DataFrame, as_of: date, days: int = 30, min_ctr: float = 3.0, min_clicks: int = 100, k: int | None = 10
) -> DataFrame:
    """Creatives by the days on which they reached ``min_ctr``."""
    grouped = (
        last_days(cp, as_of, days)
        .filter(F.col("ctr_percent") >= min_ctr)
        .groupBy("creative_id", "campaign_id")
        .agg(
            mean("ctr_percent", "avg_ctr"),
            mean("avg_cpc", "avg_cpc"),
            total("total_clicks"),
            total("total_conversions"),
        )
        .filter(F.col("total_clicks") > min_clicks)
        .orderBy(down("avg_ctr"), up("creative_id"), up("campaign_id"))
    )
    return grouped if k is None else grouped.limit(k)


def winning_patterns(winners: DataFrame) -> DataFrame:
    """One row describing the winners, with defaults when there are none."""
    raw = winners.agg(
        mean("avg_ctr", "avg_ctr", 6),
        mean("avg_cpc", "avg_cpc", 6),
        F.coalesce(F.sum("total_conversions"), F.lit(0)).cast("bigint").alias("total_conversions"),
        F.count(F.lit(1)).alias("sample_size"),
    )
    some = F.col("sample_size") > 0
    insights = F.when(
        some,
        F.array(
            F.concat(F.lit("Top performers average "), money("avg_ctr"), F.lit("% CTR")),
            F.concat(F.lit("Successful creatives maintain CPC around $"), money("avg_cpc")),
            F.concat(
                F.lit("Total conversions from these creatives: "), F.col("total_conversions").cast("string")
            ),
        ),
    ).otherwise(F.array(F.lit("Using general best practices for B2B ads")))
    return raw.select(
        F.when(some, F.col("avg_ctr")).otherwise(F.lit(2.5)).alias("avg_ctr"),
        F.when(some, F.col("avg_cpc")).otherwise(F.lit(5.0)).alias("avg_cpc"),
        "total_conversions",
        "sample_size",
        insights.alias("insights"),
    )


def monthly_trend(ds: DataFrame, k: int = 3) -> DataFrame:
    return (
        ds.groupBy(month_start("report_date").alias("month"))
        .agg(
            total("impressions", "total_impressions"),
            total("clicks", "total_clicks"),
            mean("ctr", "avg_ctr"),
            total("cost", "total_cost"),
        )
        .orderBy(down("month"))
        .limit(k)
    )


def weak_campaigns(totals: DataFrame, max_ctr: float = 1.0) -> DataFrame:
    return (
        totals.filter(F.col("overall_ctr") < max_ctr)
        .select("campaign_id", "campaign_name", "overall_ctr", "overall_cpc", "total_cost")
        .orderBy(down("total_cost"), up("campaign_id"))
    )


def quick_top_ctr(cp: DataFrame, as_of: date, days: int = 7, k: int = 10) -> DataFrame:
    return (
        last_days(cp, as_of, days)
        .groupBy("creative_id")
        .agg(mean("ctr_percent", "avg_ctr"), total("total_clicks", "clicks"))
        .orderBy(down("avg_ctr"), up("creative_id"))
        .limit(k)
    )


def training_export(cp: DataFrame, min_clicks: int = 50) -> DataFrame:
    return (
        cp.groupBy("creative_id")
        .agg(
            mean("ctr_percent", "ctr"),
            mean("avg_cpc", "cpc"),
            total("total_impressions", "impressions"),
            total("total_clicks", "clicks"),
            total("total_conversions", "conversions"),
        )
        .filter(F.col("clicks") > min_clicks)
    )


def recent_performance(cp: DataFrame, as_of: date, days: int = 7, min_clicks: int = 100) -> DataFrame:
    """Input of the independent-rules variant."""
    return (
        last_days(cp, as_of, days)
        .groupBy("creative_id")
        .agg(
            total("total_impressions", "impressions"),
            total("total_clicks", "clicks"),
            mean("ctr_percent", "ctr"),
            mean("avg_cpc", "cpc"),
            total("total_cost", "cost"),
        )
        .filter(F.col("clicks") > min_clicks)
    )


def row_counts(**tables: DataFrame) -> DataFrame:
    """Name and row count of each table."""
    counts = [t.agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("table_name"), "n") for n, t in tables.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def recent_daily(ds: DataFrame, k: int = 10) -> DataFrame:
    """The latest rows of the daily summary."""
    rest = [up(c) for c in ds.columns if c not in ("report_date", "campaign_id")]  # a campaign can have two budgets a day
    return ds.orderBy(down("report_date"), up("campaign_id"), *rest).limit(k)


def low_ctr_runs(cp: DataFrame, days: int = 3, max_ctr: float = 1.0) -> DataFrame:
    """Creatives whose CTR stayed below ``max_ctr`` on ``days`` consecutive calendar days.

    A low day counts towards the ``days`` days it may be part of a run of; a day collecting the full
    count ends a run. That is a mergeable count per (creative, day), so no history is sorted.
    """
    daily = (
        cp.groupBy("report_date", "creative_id")
        .agg(total("total_impressions"), total("total_clicks"))
        .withColumn("ctr", percent("total_clicks", "total_impressions"))
        .filter(F.col("ctr") < max_ctr)
    )
    reach = F.explode(F.sequence("report_date", F.date_add("report_date", days - 1))).alias("run_end")
    return (
        daily.select("creative_id", reach)
        .groupBy("creative_id", "run_end")
        .agg(F.count(F.lit(1)).alias("low_days"))
        .filter(F.col("low_days") == days)
        .select("creative_id", "run_end")
    )


def content_coverage(base: DataFrame, content: DataFrame) -> DataFrame:
    """Creatives with text, all creatives, and their share in percent."""
    joined = base.select("creative_id").join(
        content.select("creative_id", "combined_text"), "creative_id", "left"
    )
    has_text = F.length(F.coalesce("combined_text", F.lit(""))) > 0
    counts = joined.agg(
        F.count(F.lit(1)).alias("creatives"), F.count(F.when(has_text, F.lit(1))).alias("with_text")
    )
    return counts.withColumn("coverage_percent", percent("with_text", "creatives", 1))


def yesterday_report(daily_metrics: DataFrame, as_of: date) -> DataFrame:
    """Totals of the day before ``as_of``: impressions, clicks, cost, mean CTR and CPC (0 without clicks)."""
    zero = F.lit(0)
    day = daily_metrics.filter(F.col("report_date") == F.date_sub(F.lit(as_of), 1))
    sums = day.agg(
        F.coalesce(F.sum("impressions"), zero).cast("bigint").alias("impressions"),
        F.coalesce(F.sum("clicks"), zero).cast("bigint").alias("clicks"),
        F.coalesce(F.sum("cost"), zero).cast("double").alias("cost"),
        F.coalesce(mean_of("ctr", 6), F.lit(0.0)).alias("ctr"),
    )
    return sums.select(
        F.date_sub(F.lit(as_of), 1).alias("report_date"),
        "*",
        F.coalesce(safe_ratio("cost", "clicks"), F.lit(0.0)).alias("cpc"),
    )


def daily_rollup(cp: DataFrame) -> DataFrame:
    """Sums per day, campaign and creative."""
    return cp.groupBy("report_date", "campaign_id", "creative_id").agg(
        total("total_impressions", "impressions"), total("total_clicks", "clicks"), total("total_cost", "cost")
    )


def content_for(content: DataFrame, ids: DataFrame) -> DataFrame:
    """Creative records whose id occurs in ``ids``."""
    return content.join(ids.select("creative_id").distinct(), "creative_id", "left_semi")
