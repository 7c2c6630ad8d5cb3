"""The library's ratios, ratings and a report as SQL functions of a session, for users who write SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

_MEAN = "sum(cast(floor({0} * 100 + 0.5D) AS BIGINT)) / nullif(count({0}) * 100D, 0D)"

# Name and body of each; they give what the column functions of the same name give.
SCALAR = {
    "ad_ratio(num DOUBLE, den DOUBLE) RETURNS DOUBLE": "floor(num / nullif(den, 0D) * 100D + 0.5D) / 100D",
    "ad_percent(num DOUBLE, den DOUBLE) RETURNS DOUBLE": "floor(num * 100D / nullif(den, 0D) * 100D + 0.5D) / 100D",
    "ad_ctr_rating(ctr DOUBLE) RETURNS STRING": (
        "CASE WHEN ctr > 2.5 THEN 'Excellent' WHEN ctr > 1.5 THEN 'Good' WHEN ctr > 0.8 THEN 'Fair' ELSE 'Needs improvement' END"
    ),
    "ad_cpc_rating(cpc DOUBLE) RETURNS STRING": (
        "CASE WHEN cpc < 5 THEN 'Excellent' WHEN cpc < 8 THEN 'Good' WHEN cpc < 12 THEN 'Fair' ELSE 'Too expensive' END"
    ),
    "ad_pacing_status(spend DOUBLE, budget DOUBLE) RETURNS STRING": (
        "CASE WHEN spend < budget * 0.8D THEN 'Under-pacing' WHEN spend > budget * 1.1D THEN 'Over-pacing' ELSE 'On track' END"
    ),
    "ad_performance_category(ctr DOUBLE) RETURNS STRING": (
        "CASE WHEN ctr >= 3.0 THEN 'high' WHEN ctr >= 1.5 THEN 'medium' WHEN ctr >= 0.5 THEN 'low' ELSE 'very_low' END"
    ),
}
TABLES = {
    "ad_creatives(as_of DATE, days INT, min_clicks BIGINT) RETURNS TABLE(creative_id STRING, impressions BIGINT, clicks BIGINT, "
    "avg_ctr DOUBLE, avg_cpc DOUBLE, conversions BIGINT, avg_cpa DOUBLE)": f"""
        SELECT creative_id, sum(total_impressions), sum(total_clicks), {_MEAN.format("ctr_percent")}, {_MEAN.format("avg_cpc")},
               sum(total_conversions), {_MEAN.format("cost_per_conversion")}
        FROM {{view}} WHERE report_date BETWEEN date_sub(as_of, days) AND as_of
        GROUP BY creative_id HAVING sum(total_clicks) > min_clicks""",
}


def register(spark: SparkSession, view: str = "creative_performance") -> None:
    """Creates the functions for this session; ``ad_creatives`` reads the view of that name, which must exist.

    They are SQL, so the optimizer inlines them: filters on a report's columns and its days reach the view's scan.
    """
    for head, body in SCALAR.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    for head, body in TABLES.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body.format(view=view)}")
