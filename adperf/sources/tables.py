"""The test tables as advertising data: elements, metric events and creative content.

Column rules are the contract of FIXTURES.md section 2.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import combined_text
from .raw import pick_first_content

# The call-to-action phrase of a part, by the last digit of its key.
CTA_PHRASES = [
    "Learn more", "Get started today!", "Download now", "Contact us?", "Sign up free", "Buy 2, save 50%",
    "Watch the demo", "Get a quote: $99", "TRUSTED by 100% of users", "",
]


def _between(column: str, as_of: date | None, days: int | None) -> Column | None:
    """The day window as a range of the stored timestamp, which Parquet can skip row groups by."""
    if as_of is None or days is None:
        return None
    first = datetime.combine(as_of - timedelta(days=days), datetime.min.time())
    after = datetime.combine(as_of + timedelta(days=1), datetime.min.time())
    # The stored column has no zone; literals of the same type keep the comparison free of casts.
    low, high = (F.lit(x.isoformat(sep=" ")).cast("timestamp_ntz") for x in (first, after))
    return (F.col(column) >= low) & (F.col(column) < high)


def ad_elements(
    spark: SparkSession, sf_dir: str, as_of: date | None = None, days: int | None = None, per_part: bool = False
) -> DataFrame:
    """``lineitem`` as exploded elements, whole or limited to the days ending at ``as_of``.

    Fifty creatives as in the contract, or with ``per_part`` one creative per part.
    """
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    window = _between("l_shipdate", as_of, days)
    if window is not None:
        rows = rows.filter(window)
    n = F.col("l_suppkey") % 10
    p = F.col("l_partkey") % 50
    quantity = F.col("l_quantity").cast("bigint")
    shown = F.col("l_quantity") > 2
    clicks = F.when(shown, quantity * (F.lit(4) + p)).otherwise(F.lit(0)).cast("bigint")
    price = F.lit(8) + (p * 7) % 40 + F.round(F.col("l_discount") * 100)
    converted = F.floor(clicks * F.round(F.col("l_tax") * 100) / F.lit(100.0))
    shipped = F.col("l_shipdate").cast("timestamp")
    pull = ((F.col("l_linenumber") - 1) % 4).cast("bigint") * 6 * 3_600_000_000
    return rows.select(
        F.to_date("l_shipdate").alias("report_date"),
        F.timestamp_micros(F.unix_micros(shipped) + pull).alias("pulled_ts"),
        F.concat(F.lit("cmp_"), n.cast("string")).alias("campaign_id"),
        F.concat(F.lit("Campaign "), n.cast("string")).alias("campaign_name"),
        F.when(n < 8, "ACTIVE").otherwise("PAUSED").alias("campaign_status"),
        (F.lit(5000.0) * (F.lit(1) + F.col("l_suppkey") % 5)).alias("daily_budget"),
        (F.lit(4.0) + n).alias("unit_cost"),
        F.concat(F.lit("cr_"), (F.col("l_partkey") if per_part else p).cast("string")).alias("creative_id"),
        F.when(quantity == 1, F.lit(None)).when(quantity == 2, F.lit(0)).otherwise(quantity * 1000)
        .cast("bigint").alias("impressions"),
        clicks.alias("clicks"),
        (clicks * price / F.lit(4.0)).alias("cost"),
        F.when(shown, converted).otherwise(F.lit(0)).cast("bigint").alias("conversions"),
        F.when(quantity == 1, F.lit(None)).otherwise(F.floor(F.col("l_quantity") * 1000 * 4 / 5))
        .cast("bigint").alias("unique_impressions"),
    )


def pull_metrics_from(events: DataFrame) -> DataFrame:
    """Event rows as metric contributions."""

    def one(kind: str) -> Column:
        return (F.col("event_type") == kind).cast("bigint")

    return events.select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("cmp_"), (F.col("user_id") % 5).cast("string")).alias("campaign_id"),
        one("view").alias("impressions"),
        one("click").alias("clicks"),
        one("purchase").alias("conversions"),
        one("error").alias("errors"),
        F.when(F.col("event_type") == "click", F.col("value")).otherwise(F.lit(0.0)).alias("cost"),
    )


def pull_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pull_metrics_from(spark.read.parquet(f"{sf_dir}/events.parquet"))


def _part_content(parts: DataFrame) -> DataFrame:
    phrases = F.array(*[F.lit(p) for p in CTA_PHRASES])
    phrase = F.get(phrases, (F.col("p_partkey") % len(CTA_PHRASES)).cast("int"))
    return parts.select(
        "p_partkey",
        F.col("p_name").alias("headline"),
        F.concat_ws(" ", F.col("p_brand"), F.col("p_type"), phrase).alias("description"),
        phrase.alias("cta"),
    )


def creative_content(spark: SparkSession, sf_dir: str, per_part: bool = False) -> DataFrame:
    """``part`` as ad text, one row per creative.

    A part is a file, its key the file order: the first part of each creative supplies the content.
    """
    content = _part_content(spark.read.parquet(f"{sf_dir}/part.parquet"))
    creative = F.col("p_partkey") if per_part else F.col("p_partkey") % 50
    if per_part:
        return content.select(
            F.concat(F.lit("cr_"), creative.cast("string")).alias("creative_id"),
            "headline",
            "description",
            "cta",
            combined_text("headline", "description").alias("combined_text"),
        )
    rows = content.select(
        F.concat(F.lit("cr_"), creative.cast("string")).alias("creative_id"),
        F.col("p_partkey").alias("place"),
        F.struct("headline", "description", "cta").alias("content"),
    )
    return pick_first_content(rows)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
