"""Training sets for the creative scorer and the bid model."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.bids import optimal_bid
from ..functions.dates import cyclic, dow0, is_business_hours, is_peak_hours, is_weekend
from ..functions.numbers import mean_of, percent, safe_ratio
from ..functions.text import add_text_features
from ..settings import shared_dir
from .reports import down, last_days, mean, total, up
from .views import measured

CREATIVE_TARGET = "avg_ctr"
BID_TARGET = "optimal_bid"

# Columns that are not features, per model.
CREATIVE_EXCLUDED = [
    "creative_id", "campaign_id", "date", "creative_text", CREATIVE_TARGET, "total_impressions", "total_clicks",
    "total_cost", "total_conversions", "avg_cpc", "avg_conversion_rate", "days_active",
    "headline", "description", "cta",
]
BID_EXCLUDED = ["campaign_id", BID_TARGET, "total_cost", "avg_cpc"]
# Functions of the excluded cpc, from which the target can be read back.
BID_LEAKY = ["cpc_squared", "cpc_x_clicks", "cost_per_impression"]


def creative_base(cp: DataFrame, as_of: date, days: int = 60, min_impressions: int = 100) -> DataFrame:
    """Per creative over all its campaigns."""
    grouped = last_days(cp, as_of, days).groupBy("creative_id").agg(
        mean("ctr_percent", "avg_ctr"),
        mean("avg_cpc", "avg_cpc"),
        total("total_impressions"),
        total("total_clicks"),
        total("total_cost"),
        total("total_conversions"),
        mean("conversion_rate_percent", "avg_conversion_rate"),
        F.countDistinct("report_date").alias("days_active"),
    )
    return grouped.filter(F.col("total_impressions") > min_impressions)


def creative_base_report(cp: DataFrame, as_of: date, days: int = 60, min_impressions: int = 100) -> DataFrame:
    return creative_base(cp, as_of, days, min_impressions).orderBy(down("total_impressions"), up("creative_id"))


def with_content(base: DataFrame, content: DataFrame) -> DataFrame:
    """Adds headline, description, cta and text, empty where the creative has no content.

    Plain equi join: content grows with the number of creatives, so broadcasting it is left to
    Spark's size check.
    """
    empty = F.lit("")
    joined = base.join(content, "creative_id", "left")
    return joined.withColumns(
        {
            "headline": F.coalesce("headline", empty),
            "description": F.coalesce("description", empty),
            "cta": F.coalesce("cta", empty),
            "creative_text": F.coalesce("combined_text", empty),
        }
    ).drop("combined_text")


def creative_training_set(cp: DataFrame, content: DataFrame, as_of: date, days: int = 60) -> DataFrame:
    """Performance, content, text features and calendar constants per creative."""
    rows = add_text_features(with_content(creative_base(cp, as_of, days), content), "creative_text")
    return rows.withColumns({"month": F.lit(as_of.month), "day_of_week": F.lit(as_of.weekday())})


def bid_base(elements: DataFrame, as_of: date, days: int = 30, min_impressions: int = 10) -> DataFrame:
    """Per campaign, hour and weekday: unweighted means of the daily ratios at that hour, and sums."""
    recent = last_days(measured(elements), as_of, days).withColumns(
        {"hour_of_day": F.hour("pulled_ts"), "day_of_week": dow0("pulled_ts")}
    )
    keys = ["campaign_id", "hour_of_day", "day_of_week"]
    daily = (
        recent.groupBy(*keys, "report_date")
        .agg(total("impressions"), total("clicks"), total("cost"), total("conversions"))
        .withColumns(
            {
                "ctr": percent("clicks", "impressions"),
                "cpc": safe_ratio("cost", "clicks"),
                "conversion_rate": percent("conversions", "clicks"),
            }
        )
    )
    return (
        daily.groupBy(*keys)
        .agg(
            mean("ctr", "avg_ctr"),
            mean("cpc", "avg_cpc"),
            mean("conversion_rate", "avg_conversion_rate"),
            total("impressions", "total_impressions"),
            total("clicks", "total_clicks"),
            total("cost", "total_cost"),
        )
        .filter(F.col("total_impressions") > min_impressions)
    )


def bid_base_report(elements: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    return bid_base(elements, as_of, days).orderBy("campaign_id", "hour_of_day", "day_of_week")


def bid_training_set(
    elements: DataFrame, as_of: date, days: int = 30, target_ctr: float = 2.0, max_cpa: float = 100.0
) -> DataFrame:
    return bid_base(elements, as_of, days).withColumns(
        {
            "is_weekend": is_weekend("day_of_week"),
            "is_business_hours": is_business_hours("hour_of_day"),
            "is_peak_hours": is_peak_hours("hour_of_day"),
            BID_TARGET: optimal_bid("avg_ctr", "avg_conversion_rate", "avg_cpc", target_ctr, max_cpa),
        }
    )


def bid_features(df: DataFrame) -> DataFrame:
    """Eleven derived columns: cyclic time, squares, products, logs, cost per impression."""
    hour_sin, hour_cos = cyclic("hour_of_day", 24)
    day_sin, day_cos = cyclic("day_of_week", 7)
    return df.withColumns(
        {
            "hour_sin": hour_sin,
            "hour_cos": hour_cos,
            "day_sin": day_sin,
            "day_cos": day_cos,
            "ctr_squared": F.col("avg_ctr") * F.col("avg_ctr"),
            "cpc_squared": F.col("avg_cpc") * F.col("avg_cpc"),
            "ctr_x_conversion_rate": F.col("avg_ctr") * F.col("avg_conversion_rate"),
            "cpc_x_clicks": F.col("avg_cpc") * F.col("total_clicks"),
            "log_impressions": F.log1p("total_impressions"),
            "log_clicks": F.log1p("total_clicks"),
            "cost_per_impression": F.col("total_cost") / (F.col("total_impressions") + 1),
        }
    )


def feature_columns(df: DataFrame, excluded) -> list[str]:
    return [c for c in df.columns if c not in excluded]


def _numeric(df: DataFrame, features) -> DataFrame:
    """Booleans as 0/1, missing numbers as 0, missing classes as their own class."""
    types = {f.name: f.dataType for f in df.schema.fields}
    changes = {}
    for name in features:
        column = F.col(name)
        if isinstance(types[name], T.StringType):
            changes[name] = F.coalesce(column, F.lit("none"))
        else:
            if isinstance(types[name], T.BooleanType):
                column = column.cast("int")
            changes[name] = F.coalesce(column, F.lit(0))
    return df.withColumns(changes)


def prepare_creative(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Rows with a target; key, target and features only."""
    features = feature_columns(df, CREATIVE_EXCLUDED)
    rows = _numeric(df.filter(F.col(CREATIVE_TARGET).isNotNull()), features)
    return rows.select("creative_id", CREATIVE_TARGET, *features), features


def prepare_bids(df: DataFrame, drop_leaky: bool = False) -> tuple[DataFrame, list[str]]:
    """Rows with a target in (0, 50); ``drop_leaky`` leaves out columns derived from the cpc."""
    features = feature_columns(df, BID_EXCLUDED + (BID_LEAKY if drop_leaky else []))
    target = F.col(BID_TARGET)
    rows = _numeric(df.filter((target > 0) & (target < 50)), features)
    return rows.select("campaign_id", BID_TARGET, *features), features


FEW = 10_000  # values that one task may sort
ACCURACY = 10_000  # of the quantile sketch that proposes the next range


def value_at(rows: DataFrame, rank: int, n: int) -> float:
    """The value of that rank, from 0, among the ``n`` of column ``v``, which has neither NULL nor NaN.

    A quantile sketch, of a size that does not grow with the rows, proposes a range around the rank, and the rows below,
    on and inside its ends are counted: the counts decide, so the value is exact. Each round leaves about 1/2000 of the rows.
    """
    v, inside, before = F.col("v"), rows, 0
    spread = 2 / ACCURACY
    while n > FEW:
        place = (rank - before + 0.5) / n
        ends = F.percentile_approx("v", [max(0.0, place - spread), min(1.0, place + spread)], ACCURACY)
        low, high = inside.agg(ends).first()[0]
        counts = [F.count(F.when(c, 1)) for c in (v < low, v == low, (v > low) & (v < high), v == high)]
        less, on_low, between, on_high = inside.agg(*counts).first()
        at = rank - before - less
        if at < 0 or at >= on_low + between + (on_high if high > low else 0):
            spread *= 2  # the sketch was further off than its accuracy says
        elif at < on_low:
            return low
        elif at >= on_low + between:
            return high
        else:
            inside, before, n = inside.filter((v > low) & (v < high)), before + less + on_low, between
    return inside.agg(F.sort_array(F.collect_list("v"))[rank - before]).first()[0]


def exact_median(rows: DataFrame, n: int) -> float | None:
    """The median of the ``n`` values of column ``v``: the middle one, or the mean of the two in the middle."""
    if n == 0:
        return None
    lower = value_at(rows, (n - 1) // 2, n)
    if n % 2:
        return lower
    up_to, following = rows.agg(F.count(F.when(F.col("v") <= lower, 1)), F.min(F.when(F.col("v") > lower, F.col("v")))).first()
    return (lower + (lower if up_to > n // 2 else following)) / 2


def target_profile(df: DataFrame, target: str) -> DataFrame:
    """Samples, range, mean and median of the target.

    The target column is written once, below ``spark.checkpoint.dir``, since the median's selection reads it several times;
    no buffer grows with the number of distinct values.
    """
    spark, path = df.sparkSession, shared_dir(df.sparkSession, "target")
    df.select(F.col(target).alias("target")).write.parquet(path)
    rows = spark.read.parquet(path)
    values = rows.select(F.col("target").cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    return rows.agg(
        F.count("target").alias("samples"),
        F.min("target").alias("minimum"),
        F.max("target").alias("maximum"),
        mean_of("target", 6).alias("mean"),
        F.lit(exact_median(values, values.count())).cast("double").alias("median"),
    )
