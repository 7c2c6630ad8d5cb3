"""Every operator as a query over the driver's tables, with the SQL that checks it.

row limits in them are those of the report they implement. A query without SQL is one whose result
SQL cannot state (model fits).
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import oracle as o
from .functions import dates, sql as sql_helpers, text as tx
from .functions.numbers import mean_of, round_half_up, to_number
from .operators import aggregates, alarms, decisions, metrics, models, reports, training, trees, views
from .plans import jobs
from .settings import AS_OF, configure, shared_dir
from .sources import raw, sinks, tables
from .sources.schema import RAW
from .sources.training_files import read_training
from .streaming import alarm_state, ingest, lifetime, rollup

Run = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Run] = {}
ORACLE: dict[str, str] = {}

RUN_AT = datetime(2001, 6, 30, 8, 0, 0)


def add(name: str, run: Run, sql: str | None = None) -> None:
    def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(configure(spark), sf_dir)

    QUERIES[name] = configured
    if sql is not None:
        ORACLE[name] = sql


# --- inputs ---------------------------------------------------------------------------------------


def el(s, d, days=None, as_of=AS_OF, per_part=False):
    return tables.ad_elements(s, d, None if days is None else as_of, days, per_part)


def cp(s, d, days=None, as_of=AS_OF, per_part=False):
    return views.creative_performance(el(s, d, days, as_of, per_part))


def ds(s, d, days=None):
    return views.daily_summary(el(s, d, days))


def totals(s, d):
    return views.campaign_totals(el(s, d))


def perf(s, d, as_of=AS_OF):
    return decisions.performance(cp(s, d, 7, as_of), as_of)


def stored_perf(s, d):
    """The decision input written once, as the daily job does, for queries that use it several times."""
    return jobs.store(perf(s, d), shared_dir(s, "perf"))


def all_actions(p):
    return decisions.all_actions(decisions.creative_actions(p), decisions.bid_actions(p))


def without_zone(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


def r6(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: round_half_up(n, 6) for n in names})


# --- sources and sinks ----------------------------------------------------------------------------

_RAW_PATHS: dict[tuple[str, str], str] = {}


def written_raw(s: SparkSession, d: str) -> str:
    """The raw documents of the whole element table, written once per session."""
    key = (s.sparkContext.applicationId, d)
    if key not in _RAW_PATHS:
        path = shared_dir(s, "raw")
        raw.write_raw(raw.raw_documents(el(s, d)), path, compression="gzip")
        _RAW_PATHS[key] = path
    return _RAW_PATHS[key]


def raw_roundtrip(s, d):
    docs = raw.read_raw(s, written_raw(s, d), multi_line=False)
    return views.creative_performance(raw.explode_elements(docs))


def recent_raw(s, d):
    return per_day(raw.recent_files(raw.read_raw(s, written_raw(s, d), multi_line=False), AS_OF, 60))


def recent_raw_pruned(s, d):
    return per_day(raw.read_recent(s, written_raw(s, d), AS_OF, 60, multi_line=False))


def per_day(docs: DataFrame) -> DataFrame:
    return (
        docs.select(
            F.to_date(dates.instant("pulled_at")).alias("report_date"),
            F.size("analytics.elements").cast("bigint").alias("n"),
        )
        .groupBy("report_date")
        .agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("elements"))
    )


def training_roundtrip(s, d):
    root = shared_dir(s, "training")
    sinks.write_training_set(training.bid_training_set(el(s, d, 30), AS_OF), root, "bid_optimization", RUN_AT)
    return read_training(s, f"{root}/training/bid_optimization/parquet", ("parquet",), distinct=True)


def daily_sink(s, d):
    path = shared_dir(s, "daily")
    sinks.write_partitioned(aggregates.daily_aggregates(cp(s, d, 90), AS_OF), path)
    return s.read.parquet(path)


def metadata_sink(s, d):
    rows = aggregates.creative_metadata(cp(s, d))
    paths = sinks.write_creative_metadata(rows, shared_dir(s, "metadata"))
    return s.read.schema(rows.schema).json(paths["json"])


def exported_table(s, d):
    rows = reports.training_export(cp(s, d))
    path = shared_dir(s, "export")
    table = "creative_training_data_" + path.rsplit("-", 1)[1]
    sinks.export_table(rows, table, path)
    return s.table(table)


def action_log(s, d):
    path = shared_dir(s, "log")
    log = decisions.log_rows(all_actions(stored_perf(s, d)), RUN_AT)
    sinks.append_actions(log, path)
    stored = s.read.schema(log.schema).json(path)
    return flat_log(stored)


def flat_log(log):
    m = F.col("metrics")
    return without_zone(log, "timestamp").select(
        "timestamp", "action_type", "resource_id", "details", "applied",
        *[F.try_element_at(m, F.lit(k)).alias(k) for k in ("ctr", "cpc", "clicks", "cost", "old_bid", "new_bid", "change")],
    )


LOG_SQL = o.sql(
    """
SELECT TIMESTAMP '2001-06-30 08:00:00' AS timestamp, CASE action WHEN 'paused' THEN 'pause_creative' ELSE 'identify_winner' END AS action_type,
       creative_id AS resource_id, reason AS details, false AS applied, metric_ctr AS ctr, metric_cpc AS cpc,
       CAST(total_clicks AS DOUBLE) AS clicks, total_cost AS cost,
       CAST(NULL AS DOUBLE) AS old_bid, CAST(NULL AS DOUBLE) AS new_bid, CAST(NULL AS DOUBLE) AS change FROM acts
UNION ALL
SELECT TIMESTAMP '2001-06-30 08:00:00', 'adjust_bid', campaign_id, reason, false, NULL, NULL, NULL, NULL, old_bid, new_bid, change FROM bidacts""",
    "acts",
    "bidacts",
)


def tiers(s, d):
    per_day = el(s, d).groupBy("report_date").agg(F.count(F.lit(1)).alias("rows"))
    both = [
        aggregates.with_retention(per_day, AS_OF, "report_date", kind).select(
            F.lit(kind).alias("kind"), "report_date", "age_days", "tier", "rows"
        )
        for kind in ("raw", "processed")
    ]
    return both[0].unionByName(both[1])


def unexpired_days(s, d):
    return aggregates.unexpired(el(s, d), AS_OF, "report_date").groupBy("report_date").agg(
        F.count(F.lit(1)).alias("rows")
    )


def sql_text(s, d):
    cp(s, d).createOrReplaceTempView("creative_performance")
    return s.sql(
        "SELECT campaign_id, count(*) AS n, sum(total_clicks) AS clicks, max(ctr_percent) AS best_ctr "
        "FROM creative_performance GROUP BY campaign_id"
    )


def sql_functions(s, d):
    """The report of A5 over all its creatives, by SQL functions with labels of its ratios."""
    cp(s, d).createOrReplaceTempView("creative_performance")
    sql_helpers.register(s)
    return s.sql(
        f"""SELECT *, ad_ctr_rating(avg_ctr) AS ctr_label, ad_cpc_rating(avg_cpc) AS cpc_label, ad_performance_category(avg_ctr) AS category,
       ad_percent(clicks, impressions) AS overall_ctr, ad_ratio(conversions, clicks) AS conversions_a_click,
       ad_pacing_status(clicks * avg_cpc, 1000) AS pacing
FROM ad_creatives(DATE '{AS_OF}', 7, 10)"""
    )


add(
    "x04_sql_functions",
    sql_functions,
    o.sql(
        f"""SELECT *, CASE WHEN avg_ctr > 2.5 THEN 'Excellent' WHEN avg_ctr > 1.5 THEN 'Good' WHEN avg_ctr > 0.8 THEN 'Fair' ELSE 'Needs improvement' END AS ctr_label,
       CASE WHEN avg_cpc < 5 THEN 'Excellent' WHEN avg_cpc < 8 THEN 'Good' WHEN avg_cpc < 12 THEN 'Fair' ELSE 'Too expensive' END AS cpc_label,
       CASE WHEN avg_ctr >= 3.0 THEN 'high' WHEN avg_ctr >= 1.5 THEN 'medium' WHEN avg_ctr >= 0.5 THEN 'low' ELSE 'very_low' END AS category,
       {o.pct('clicks', 'impressions')} AS overall_ctr, {o.ratio('conversions', 'clicks')} AS conversions_a_click,
       CASE WHEN clicks * avg_cpc < 800.0::DOUBLE THEN 'Under-pacing' WHEN clicks * avg_cpc > 1100.0::DOUBLE THEN 'Over-pacing' ELSE 'On track' END AS pacing
FROM (SELECT creative_id, {o.isum('total_impressions')} AS impressions, {o.isum('total_clicks')} AS clicks, {o.avg('ctr_percent')} AS avg_ctr,
             {o.avg('avg_cpc')} AS avg_cpc, {o.isum('total_conversions')} AS conversions, {o.avg('cost_per_conversion')} AS avg_cpa
      FROM cp WHERE {o.days(7)} GROUP BY 1 HAVING SUM(total_clicks) > 10)""",
        "cp",
    ),
)
add("s01_raw_roundtrip", raw_roundtrip, o.sql("SELECT * FROM cp", "cp"))
RECENT_SQL = o.sql(
    f"""SELECT report_date, COUNT(DISTINCT (pulled_ts, campaign_id)) AS documents, COUNT(*) AS elements
FROM el WHERE report_date >= DATE '{AS_OF - timedelta(days=60)}' GROUP BY 1""",
    "el",
)
add("s04_recent_files", recent_raw, RECENT_SQL)
add("s04_pruned", recent_raw_pruned, RECENT_SQL)
add("s06_s10_training_files", training_roundtrip, o.sql("SELECT * FROM bset", "bset"))
add("s07_daily_sink", daily_sink, o.sql("SELECT * FROM daily", "daily"))
add("s08_creative_metadata_json", metadata_sink, o.sql("SELECT * FROM meta", "meta"))
EXPORT_SQL = o.sql(
    f"""SELECT creative_id, {o.avg('ctr_percent')} AS ctr, {o.avg('avg_cpc')} AS cpc, {o.isum('total_impressions')} AS impressions,
       {o.isum('total_clicks')} AS clicks, {o.isum('total_conversions')} AS conversions
FROM cp GROUP BY 1 HAVING SUM(total_clicks) > 50""",
    "cp",
)
add("s09_export_table", exported_table, EXPORT_SQL)
add("s11_action_log", action_log, LOG_SQL)
add(
    "s15_retention_tiers",
    tiers,
    o.sql(
        f"""
SELECT kind, report_date, CAST(age AS INTEGER) AS age_days, rows,
       CASE WHEN kind = 'raw' THEN CASE WHEN age >= 90 THEN 'delete' ELSE 'hot' END
            WHEN age >= 90 THEN 'archive' WHEN age >= 30 THEN 'infrequent' ELSE 'hot' END AS tier
FROM (SELECT report_date, date_diff('day', report_date, DATE '{AS_OF}') AS age, COUNT(*) AS rows FROM el GROUP BY 1, 2),
     (VALUES ('raw'), ('processed')) k(kind)""",
        "el",
    ),
)
add(
    "s15_unexpired_days",
    unexpired_days,
    o.sql(f"SELECT report_date, COUNT(*) AS rows FROM el WHERE report_date > DATE '{AS_OF - timedelta(days=90)}' GROUP BY 1", "el"),
)
add(
    "s16_sql_text",
    sql_text,
    o.sql(
        f"SELECT campaign_id, COUNT(*) AS n, {o.isum('total_clicks')} AS clicks, MAX(ctr_percent) AS best_ctr FROM cp GROUP BY 1",
        "cp",
    ),
)

# --- projections, filters, joins ------------------------------------------------------------------


def nested_fields(s, d):
    docs = raw.raw_documents(el(s, d))
    c = F.col("campaign_config")
    return docs.select(
        "campaign_id", "pulled_at", c["name"].alias("campaign_name"), c["status"].alias("campaign_status"),
        c["dailyBudget"]["amount"].alias("daily_budget"), c["unitCost"]["amount"].alias("unit_cost"),
        F.size("analytics.elements").cast("bigint").alias("elements"),
    )


def coerced(s, d):
    events = s.read.parquet(f"{d}/events.parquet")
    number = to_number(F.get_json_object("props", "$.k"))
    return events.groupBy("event_type").agg(
        F.count(number).alias("numbers"),
        F.sum(number).alias("total"),
        F.count(to_number("event_type")).alias("bad_numbers"),
    )


def best_content(s, d):
    ids = reports.quick_top_ctr(cp(s, d, 7), AS_OF).select("creative_id")
    return reports.content_for(tables.creative_content(s, d), ids)


def unnested(s, d):
    exploded = raw.explode_elements(raw.raw_documents(el(s, d)))
    return exploded.groupBy("report_date", "campaign_id").agg(
        F.count(F.lit(1)).alias("elements"),
        F.count("impressions").alias("measured"),
        F.sum("clicks").alias("clicks"),
        F.sum("cost").alias("cost"),
    )


add(
    "p01_nested_fields",
    nested_fields,
    o.sql(
        """SELECT campaign_id, strftime(pulled_ts, '%Y-%m-%dT%H:%M:%S.%f') AS pulled_at, campaign_name, campaign_status, daily_budget, unit_cost,
       COUNT(*) AS elements FROM el GROUP BY 1, 2, 3, 4, 5, 6""",
        "el",
    ),
)
add(
    "p02_not_null",
    lambda s, d: views.measured(el(s, d)).groupBy("campaign_id").agg(F.count(F.lit(1)).alias("measured")),
    o.sql("SELECT campaign_id, COUNT(*) AS measured FROM el WHERE impressions IS NOT NULL GROUP BY 1", "el"),
)
add(
    "p07_text_to_number",
    coerced,
    """SELECT event_type, COUNT(n) AS numbers, SUM(n) AS total, COUNT(TRY_CAST(event_type AS DOUBLE)) AS bad_numbers
FROM (SELECT event_type, TRY_CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS DOUBLE) AS n FROM events) GROUP BY 1""",
)
add(
    "p13_skip_low_ctr",
    lambda s, d: raw.skip_low_ctr(el(s, d)).groupBy("campaign_id", "creative_id").agg(
        F.count(F.lit(1)).alias("kept"), F.sum("clicks").alias("clicks")
    ),
    o.sql(
        f"""SELECT campaign_id, creative_id, COUNT(*) AS kept, {o.isum('clicks')} AS clicks FROM el
WHERE clicks / NULLIF(CAST(COALESCE(impressions, 1) AS DOUBLE), 0) * 100 >= 0.5 GROUP BY 1, 2""",
        "el",
    ),
)
add(
    "p14_campaign_list",
    lambda s, d: raw.only_campaigns(el(s, d), "cmp_1, cmp_4 ,,cmp_9").groupBy("campaign_id", "report_date").agg(
        F.count(F.lit(1)).alias("elements")
    ),
    o.sql("SELECT campaign_id, report_date, COUNT(*) AS elements FROM el WHERE campaign_id IN ('cmp_1', 'cmp_4', 'cmp_9') GROUP BY 1, 2", "el"),
)
add(
    "j01_unnest",
    unnested,
    o.sql(
        f"""SELECT report_date, campaign_id, COUNT(*) AS elements, COUNT(impressions) AS measured, {o.isum('clicks')} AS clicks, SUM(cost) AS cost
FROM el GROUP BY 1, 2""",
        "el",
    ),
)
add(
    "j02_content_lookup",
    lambda s, d: training.with_content(
        training.creative_base(cp(s, d, 60, per_part=True), AS_OF), tables.creative_content(s, d, per_part=True)
    ).select("creative_id", "avg_ctr", "headline", "description", "cta", "creative_text"),
    o.sql("SELECT creative_id, avg_ctr, headline, description, cta, creative_text FROM cset", "cset"),
)
QUICK = f"""SELECT creative_id, {o.avg('ctr_percent')} AS avg_ctr, {o.isum('total_clicks')} AS clicks FROM cp WHERE {o.days(7)}
GROUP BY 1 ORDER BY avg_ctr DESC NULLS LAST, creative_id LIMIT 10"""
add(
    "j04_metadata_lookup",
    best_content,
    o.sql(f"SELECT c.* FROM content c WHERE creative_id IN (SELECT creative_id FROM ({QUICK}))", "content", "cp"),
)

# --- views and reports ----------------------------------------------------------------------------

add("a01_creative_performance", cp, o.sql("SELECT * FROM cp", "cp"))
add("a02_daily_summary", ds, o.sql("SELECT * FROM ds", "ds"))
add("a03_campaign_totals", totals, o.sql("SELECT * FROM totals", "totals"))
add(
    "a04_hourly_breakdown",
    lambda s, d: views.hourly_breakdown(el(s, d)),
    o.sql(
        f"""SELECT *, {o.pct('clicks', 'impressions')} AS ctr, {o.ratio('cost', 'clicks')} AS cpc
FROM (SELECT report_date, CAST(extract(hour FROM pulled_ts) AS INTEGER) AS hour_of_day, CAST(extract(dow FROM pulled_ts) AS INTEGER) AS day_of_week,
             campaign_id, creative_id, {o.isum('impressions')} AS impressions, {o.isum('clicks')} AS clicks, SUM(cost) AS cost
      FROM el WHERE impressions IS NOT NULL GROUP BY 1, 2, 3, 4, 5)""",
        "el",
    ),
)
add(
    "a05_top_creatives",
    lambda s, d: reports.top_creatives(cp(s, d, 7), AS_OF),
    o.sql(
        f"""SELECT creative_id, {o.isum('total_impressions')} AS impressions, {o.isum('total_clicks')} AS clicks, {o.avg('ctr_percent')} AS avg_ctr,
       {o.avg('avg_cpc')} AS avg_cpc, {o.isum('total_conversions')} AS conversions, {o.avg('cost_per_conversion')} AS avg_cpa
FROM cp WHERE {o.days(7)} GROUP BY 1 HAVING SUM(total_clicks) > 10 ORDER BY avg_ctr DESC NULLS LAST, creative_id LIMIT 10""",
        "cp",
    ),
)
add(
    "a06_underperforming",
    lambda s, d: reports.underperforming(cp(s, d, 3), AS_OF),
    o.sql(
        f"""SELECT * FROM (SELECT creative_id, {o.isum('total_impressions')} AS impressions, {o.isum('total_clicks')} AS clicks,
       {o.avg('ctr_percent')} AS avg_ctr, {o.avg('avg_cpc')} AS avg_cpc, SUM(total_cost) AS total_spent
FROM cp WHERE {o.days(3)} GROUP BY 1) WHERE clicks > 100 AND avg_ctr < 1.0""",
        "cp",
    ),
)
TREND_SQL = o.sql(
    f"""SELECT report_date, {o.isum('impressions')} AS total_impressions, {o.isum('clicks')} AS total_clicks, SUM(cost) AS total_cost,
       {o.isum('conversions')} AS total_conversions, {o.avg('ctr')} AS avg_ctr, {o.avg('cpc')} AS avg_cpc, {o.avg('cpa')} AS avg_cpa
FROM ds WHERE {o.days(30)} GROUP BY 1""",
    "ds",
)
add("a07_daily_trend", lambda s, d: reports.daily_trend(ds(s, d, 30), AS_OF), TREND_SQL)
add(
    "a08_budget_pacing",
    lambda s, d: reports.budget_pacing(ds(s, d, 0), AS_OF),
    o.sql(
        f"""SELECT *, {o.pct('actual_spend', 'daily_budget', 1)} AS pacing_percent,
       CASE WHEN actual_spend < daily_budget * 0.8 THEN 'Under-pacing' WHEN actual_spend > daily_budget * 1.1 THEN 'Over-pacing' ELSE 'On track' END AS status
FROM (SELECT campaign_id, campaign_name, daily_budget, SUM(cost) AS actual_spend FROM ds WHERE report_date = DATE '{AS_OF}' GROUP BY 1, 2, 3)""",
        "ds",
    ),
)
add(
    "a09_weekly_spend",
    lambda s, d: reports.weekly_spend(ds(s, d, 30), AS_OF),
    o.sql(
        f"""SELECT *, {o.ratio('weekly_spend', 'weekly_conversions')} AS weekly_cpa
FROM (SELECT campaign_id, campaign_name, CAST(date_trunc('week', report_date) AS DATE) AS week, SUM(cost) AS weekly_spend,
             {o.isum('conversions')} AS weekly_conversions FROM ds WHERE {o.days(30)} GROUP BY 1, 2, 3)""",
        "ds",
    ),
)
add(
    "a10_ready_to_scale",
    lambda s, d: reports.ready_to_scale(cp(s, d, 7), AS_OF),
    o.sql(
        f"""SELECT * FROM (SELECT creative_id, campaign_id, {o.isum('total_impressions')} AS impressions, {o.isum('total_clicks')} AS clicks,
       {o.avg('ctr_percent')} AS avg_ctr, {o.avg('avg_cpc')} AS avg_cpc, {o.isum('total_conversions')} AS conversions,
       {o.avg('conversion_rate_percent')} AS conversion_rate FROM cp WHERE {o.days(7)} GROUP BY 1, 2)
WHERE clicks > 100 AND avg_ctr > 3 AND avg_cpc < 8 AND conversions > 2""",
        "cp",
    ),
)
add(
    "a11_expensive_low_conversion",
    lambda s, d: reports.expensive_low_conversion(cp(s, d, 7), AS_OF),
    o.sql(
        f"""SELECT * FROM (SELECT creative_id, campaign_id, SUM(total_cost) AS total_spent, {o.isum('total_clicks')} AS clicks,
       {o.isum('total_conversions')} AS conversions, {o.avg('avg_cpc')} AS avg_cpc, {o.avg('conversion_rate_percent')} AS conversion_rate
FROM cp WHERE {o.days(7)} GROUP BY 1, 2) WHERE total_spent > 100 AND (conversions = 0 OR conversion_rate < 2)""",
        "cp",
    ),
)
add(
    "a12_campaign_health",
    lambda s, d: reports.campaign_health(totals(s, d)),
    o.sql(
        """SELECT campaign_name, days_active, total_impressions, total_clicks, total_cost, total_conversions, overall_ctr, overall_cpc, overall_cpa,
       CASE WHEN overall_ctr > 2.5 THEN 'Excellent' WHEN overall_ctr > 1.5 THEN 'Good' WHEN overall_ctr > 0.8 THEN 'Fair' ELSE 'Needs improvement' END AS ctr_rating,
       CASE WHEN overall_cpc < 5 THEN 'Excellent' WHEN overall_cpc < 8 THEN 'Good' WHEN overall_cpc < 12 THEN 'Fair' ELSE 'Too expensive' END AS cpc_rating
FROM totals""",
        "totals",
    ),
)
add(
    "a13_day_of_week",
    lambda s, d: reports.day_of_week(ds(s, d, 30), AS_OF),
    o.sql(
        f"""SELECT CAST(extract(dow FROM report_date) AS INTEGER) AS day_of_week, dayname(ANY_VALUE(report_date)) AS day_name, COUNT(*) AS data_points,
       {o.avg('ctr')} AS avg_ctr, {o.avg('cpc')} AS avg_cpc, {o.avg('conversion_rate')} AS avg_conversion_rate
FROM ds WHERE {o.days(30)} GROUP BY 1""",
        "ds",
    ),
)
add(
    "a14_missing_data",
    lambda s, d: reports.missing_data(raw.raw_documents(el(s, d, 7)), AS_OF),
    o.sql(
        f"""SELECT report_date, COUNT(*) AS pull_count, COUNT(DISTINCT campaign_id) AS unique_campaigns, CAST(0 AS BIGINT) AS empty_pulls
FROM docs WHERE {o.days(7)} GROUP BY 1""",
        "docs",
    ),
)
add(
    "a15_collection_frequency",
    lambda s, d: reports.collection_frequency(raw.raw_documents(el(s, d, 7)), AS_OF),
    o.sql(
        f"""SELECT report_date, COUNT(*) AS pulls_per_day, MIN(pulled_at) AS first_pull, MAX(pulled_at) AS last_pull
FROM docs WHERE {o.days(7)} GROUP BY 1""",
        "docs",
    ),
)
add(
    "a16_decision_input",
    lambda s, d: decisions.performance_report(cp(s, d, 7), AS_OF),
    o.sql("SELECT * FROM perf", "perf"),
)
add(
    "a17_creative_training_base",
    lambda s, d: training.creative_base_report(cp(s, d, 60, per_part=True), AS_OF),
    o.sql("SELECT * FROM cbase", "cbase"),
)
add("a18_bid_training_base", lambda s, d: training.bid_base_report(el(s, d, 30), AS_OF), o.sql("SELECT * FROM bbase", "bbase"))
add("a19_daily_aggregates", lambda s, d: aggregates.daily_aggregates_report(cp(s, d, 90), AS_OF), o.sql("SELECT * FROM daily", "daily"))
add("a20_weekly_summaries", lambda s, d: aggregates.weekly_summaries_report(cp(s, d, 180), AS_OF), o.sql("SELECT * FROM weekly", "weekly"))
add("a21_creative_metadata", lambda s, d: aggregates.creative_metadata_report(cp(s, d)), o.sql("SELECT * FROM meta", "meta"))
add("a22_winning_creatives", lambda s, d: reports.winning_creatives(cp(s, d, 30), AS_OF), o.sql("SELECT * FROM winners", "winners"))
add(
    "a23_winning_patterns",
    lambda s, d: jobs.run_copy_patterns(cp(s, d, 30), AS_OF).withColumn("insights", F.array_join("insights", "; ")),
    o.sql(
        f"""SELECT COALESCE(avg_ctr, 2.5) AS avg_ctr, COALESCE(avg_cpc, 5.0) AS avg_cpc, total_conversions, sample_size,
       CASE WHEN sample_size = 0 THEN 'Using general best practices for B2B ads'
            ELSE 'Top performers average ' || {o.usd('avg_ctr')} || '% CTR; Successful creatives maintain CPC around $' || {o.usd('avg_cpc')}
                 || '; Total conversions from these creatives: ' || total_conversions END AS insights
FROM (SELECT {o.avg('avg_ctr', 6)} AS avg_ctr, {o.avg('avg_cpc', 6)} AS avg_cpc, COALESCE({o.isum('total_conversions')}, 0) AS total_conversions,
             COUNT(*) AS sample_size FROM winners)""",
        "winners",
    ),
)
add(
    "a24_monthly_trend",
    lambda s, d: reports.monthly_trend(ds(s, d)),
    o.sql(
        f"""SELECT CAST(date_trunc('month', report_date) AS DATE) AS month, {o.isum('impressions')} AS total_impressions,
       {o.isum('clicks')} AS total_clicks, {o.avg('ctr')} AS avg_ctr, SUM(cost) AS total_cost FROM ds GROUP BY 1 ORDER BY 1 DESC LIMIT 3""",
        "ds",
    ),
)
add(
    "a25_weak_campaigns",
    lambda s, d: reports.weak_campaigns(totals(s, d), 3.0),
    o.sql("SELECT campaign_id, campaign_name, overall_ctr, overall_cpc, total_cost FROM totals WHERE overall_ctr < 3.0", "totals"),
)
add("a26_quick_top_ctr", lambda s, d: reports.quick_top_ctr(cp(s, d, 7), AS_OF), o.sql(QUICK, "cp"))
add("a27_training_export", lambda s, d: reports.training_export(cp(s, d)), EXPORT_SQL)
RECENT = f"""SELECT * FROM (SELECT creative_id, {o.isum('total_impressions')} AS impressions, {o.isum('total_clicks')} AS clicks,
       {o.avg('ctr_percent')} AS ctr, {o.avg('avg_cpc')} AS cpc, SUM(total_cost) AS cost FROM cp WHERE {o.days(7)} GROUP BY 1) WHERE clicks > 100"""
add("a28_recent_performance", lambda s, d: reports.recent_performance(cp(s, d, 7), AS_OF), o.sql(RECENT, "cp"))
add(
    "a29_row_counts",
    lambda s, d: reports.row_counts(ad_elements=el(s, d), creative_performance=cp(s, d)),
    o.sql(
        "SELECT 'ad_elements' AS table_name, COUNT(*) AS n FROM el UNION ALL SELECT 'creative_performance', COUNT(*) FROM cp",
        "el",
        "cp",
    ),
)
add(
    "a30_campaign_rollup",
    lambda s, d: decisions.campaign_rollup(perf(s, d)),
    o.sql("SELECT campaign_id, avg_ctr, old_bid AS avg_cpc, total_cost FROM bids", "bids"),
)
add(
    "a31_campaign_metrics",
    lambda s, d: decisions.campaign_metrics(perf(s, d)),
    o.sql(
        f"""SELECT campaign_id, {o.isum('total_impressions')} AS total_impressions, {o.isum('total_clicks')} AS total_clicks,
       SUM(total_cost) AS total_cost, {o.avg('avg_ctr', 6)} AS avg_ctr FROM perf GROUP BY 1""",
        "perf",
    ),
)
add("a32_performance_summary", lambda s, d: decisions.performance_summary(perf(s, d)), o.sql("SELECT * FROM summary", "summary"))
add(
    "a33_collector_totals",
    lambda s, d: metrics.collector_totals(el(s, d)),
    o.sql(
        f"""SELECT *, {o.pct('total_clicks', 'total_impressions', None)} AS ctr, {o.ratio('total_cost', 'total_clicks', digits=None)} AS cpc
FROM (SELECT COALESCE({o.isum('impressions')}, 0) AS total_impressions, COALESCE({o.isum('clicks')}, 0) AS total_clicks,
             COALESCE(SUM(cost), 0.0) AS total_cost FROM el)""",
        "el",
    ),
)
add(
    "a34_pull_success",
    lambda s, d: metrics.pull_success(raw.raw_documents(el(s, d))),
    o.sql("SELECT COUNT(*) AS successful_pulls, CAST(0 AS BIGINT) AS failed_pulls FROM docs", "docs"),
)
add("a35_action_counts", lambda s, d: decisions.action_counts(all_actions(perf(s, d))), o.sql("SELECT * FROM counts", "counts"))
add(
    "a36_portfolio_health",
    lambda s, d: decisions.portfolio_health(decisions.classify_creatives(perf(s, d))),
    o.sql("SELECT * FROM health", "health"),
)


def dataset_metrics(s, d):
    sets = {
        "creative_scoring": training.creative_training_set(
            cp(s, d, 60, per_part=True), tables.creative_content(s, d, per_part=True), AS_OF
        ),
        "bid_optimization": training.bid_training_set(el(s, d, 30), AS_OF),
    }
    rows = metrics.processor_metrics(metrics.manifest_of(sets, ["daily", "weekly", "creative_metadata"]), RUN_AT)
    return rows.select(
        "namespace", "name", "value", "unit", F.try_element_at("dimensions", F.lit("DatasetType")).alias("dataset")
    )


add(
    "a37_dataset_metrics",
    dataset_metrics,
    o.sql(
        """SELECT 'adperf/processor' AS namespace, name, CAST(value AS DOUBLE) AS value, 'Count' AS unit, dataset
FROM (SELECT 'DatasetsCreated' AS name, 2 AS value, NULL AS dataset
      UNION ALL SELECT 'TotalTrainingSamples', (SELECT COUNT(*) FROM cset) + (SELECT COUNT(*) FROM bset), NULL
      UNION ALL SELECT 'AggregatesCreated', 3, NULL UNION ALL SELECT 'ProcessingSuccess', 1, NULL
      UNION ALL SELECT 'DatasetSamples', COUNT(*), 'creative_scoring' FROM cset
      UNION ALL SELECT 'DatasetSamples', COUNT(*), 'bid_optimization' FROM bset
      UNION ALL SELECT 'DatasetFeatures', 40, 'creative_scoring' UNION ALL SELECT 'DatasetFeatures', 13, 'bid_optimization')""",
        "cset",
        "bset",
    ),
)
add(
    "a38_content_coverage",
    lambda s, d: reports.content_coverage(
        training.creative_base(cp(s, d, 60, per_part=True), AS_OF), tables.creative_content(s, d, per_part=True)
    ),
    o.sql(
        f"""SELECT *, {o.pct('with_text', 'creatives', 1)} AS coverage_percent
FROM (SELECT COUNT(*) AS creatives, COUNT(*) FILTER (length(creative_text) > 0) AS with_text FROM cset)""",
        "cset",
    ),
)
add(
    "a39_creative_days",
    lambda s, d: views.pull_date_rows(el(s, d, 60)),
    o.sql(f"SELECT DISTINCT creative_id, campaign_id, report_date AS date FROM el WHERE {o.days(60)}", "el"),
)


def yesterday(s, d):
    runs = metrics.collector_totals(el(s, d, 1), ["pulled_ts"])
    named = runs.select(
        F.to_date("pulled_ts").alias("report_date"), F.col("total_impressions").alias("impressions"),
        F.col("total_clicks").alias("clicks"), F.col("total_cost").alias("cost"), "ctr",
    )
    return reports.yesterday_report(named, AS_OF)


add(
    "a40_yesterday_report",
    yesterday,
    o.sql(
        f"""SELECT DATE '{AS_OF - timedelta(days=1)}' AS report_date, *, COALESCE({o.ratio('cost', 'clicks')}, 0.0) AS cpc
FROM (SELECT COALESCE({o.isum('impressions')}, 0) AS impressions, COALESCE({o.isum('clicks')}, 0) AS clicks, COALESCE(SUM(cost), 0.0) AS cost,
             COALESCE({o.avg('ctr', 6)}, 0.0) AS ctr FROM runs WHERE CAST(ts AS DATE) = DATE '{AS_OF - timedelta(days=1)}')""",
        "runs",
    ),
)
add(
    "a41_daily_rollup",
    lambda s, d: reports.daily_rollup(cp(s, d)),
    o.sql(
        """SELECT report_date, campaign_id, creative_id, total_impressions AS impressions, total_clicks AS clicks, total_cost AS cost FROM cp""",
        "cp",
    ),
)

# --- windows, ordering ----------------------------------------------------------------------------

LATEST_SQL = o.sql(
    f"""SELECT report_date, campaign_id, creative_id, total_impressions, total_clicks, total_cost, total_conversions, unique_impressions,
       pulled_ts, {o.pct('total_clicks', 'total_impressions')} AS ctr_percent, {o.ratio('total_cost', 'total_clicks')} AS avg_cpc,
       {o.ratio('total_cost', 'total_conversions')} AS cost_per_conversion, {o.pct('total_conversions', 'total_clicks')} AS conversion_rate_percent
FROM (SELECT *, row_number() OVER (PARTITION BY report_date, campaign_id, creative_id ORDER BY pulled_ts DESC) AS rn
      FROM (SELECT report_date, campaign_id, creative_id, pulled_ts, {o.isum('impressions')} AS total_impressions, {o.isum('clicks')} AS total_clicks,
                   SUM(cost) AS total_cost, {o.isum('conversions')} AS total_conversions, {o.isum('unique_impressions')} AS unique_impressions
            FROM el WHERE impressions IS NOT NULL GROUP BY 1, 2, 3, 4)) WHERE rn = 1""",
    "el",
)
add("w01_latest_pull", lambda s, d: without_zone(views.latest_pull(el(s, d)), "pulled_ts"), LATEST_SQL)
add("w02_first_content", tables.creative_content, o.sql("SELECT * FROM content", "content"))
add(
    "w04_low_ctr_runs",
    lambda s, d: reports.low_ctr_runs(cp(s, d)),
    o.sql(
        f"""SELECT creative_id, report_date AS run_end
FROM (SELECT *, lag(report_date, 1) OVER w AS d1, lag(report_date, 2) OVER w AS d2
      FROM (SELECT creative_id, report_date, {o.pct('SUM(total_clicks)', 'SUM(total_impressions)')} AS ctr FROM cp GROUP BY 1, 2)
      WHERE ctr < 1.0 WINDOW w AS (PARTITION BY creative_id ORDER BY report_date))
WHERE d1 = report_date - 1 AND d2 = report_date - 2""",
        "cp",
    ),
)
GROWTH = ", ".join(
    o.ratio(f"({c} - lag({c}) OVER w)", f"(lag({c}) OVER w)", 100.0) + f" AS {c}_growth_percent"
    for c in ("impressions", "clicks", "cost", "conversions")
)
add(
    "w05_weekly_growth",
    lambda s, d: aggregates.weekly_growth(aggregates.weekly_summaries(cp(s, d, 180), AS_OF)),
    o.sql(f"SELECT week_start, campaign_id, {GROWTH} FROM weekly WINDOW w AS (PARTITION BY campaign_id ORDER BY week_start)", "weekly"),
)
add(
    "o02_recent_daily",
    lambda s, d: reports.recent_daily(ds(s, d)),
    o.sql("SELECT * FROM ds ORDER BY report_date DESC, campaign_id LIMIT 10", "ds"),
)
add(
    "o04_latest_events",
    lambda s, d: metrics.latest_events(
        s.read.parquet(f"{d}/events.parquet").select("event_id", "ts", F.col("event_type").alias("message")), "error|purchase"
    ),
    """SELECT event_id, ts, event_type AS message FROM events WHERE regexp_matches(event_type, 'error|purchase')
ORDER BY ts DESC, event_id DESC LIMIT 20""",
)


def all_metrics(s, d):
    p = stored_perf(s, d)
    collector = metrics.collector_metrics(el(s, d))
    optimizer = metrics.optimizer_metrics(p, decisions.classify_creatives(p), all_actions(p), RUN_AT)
    rows = metrics.union_metrics(collector, optimizer)
    return without_zone(rows, "ts").select(
        "ts", "namespace", "name", round_half_up("value", 6).alias("value"), "unit",
        F.try_element_at("dimensions", F.lit("CampaignId")).alias("campaign_id"),
    )


OPTIMIZER_ROWS = """SELECT TIMESTAMP '2001-06-30 08:00:00' AS ts, 'adperf/optimizer' AS namespace, name, CAST(value AS DOUBLE) AS value, unit, CAST(NULL AS VARCHAR) AS campaign_id
FROM (SELECT 'TotalActions' AS name, total_actions AS value, 'Count' AS unit FROM counts
      UNION ALL SELECT 'CreativesPaused', paused, 'Count' FROM counts
      UNION ALL SELECT 'BidAdjustments', bid_adjustments, 'Count' FROM counts
      UNION ALL SELECT 'TopPerformersIdentified', top_performers, 'Count' FROM counts
      UNION ALL SELECT 'TotalImpressions', total_impressions, 'Count' FROM summary
      UNION ALL SELECT 'TotalClicks', total_clicks, 'Count' FROM summary
      UNION ALL SELECT 'TotalCost', total_cost, 'None' FROM summary
      UNION ALL SELECT 'AverageCTR', avg_ctr, 'Percent' FROM summary
      UNION ALL SELECT 'AverageCPC', avg_cpc, 'None' FROM summary
      UNION ALL SELECT 'TotalCreatives', total_creatives, 'Count' FROM health
      UNION ALL SELECT 'ActiveCreatives', active_creatives, 'Count' FROM health
      UNION ALL SELECT 'HighPerformers', high_performers, 'Count' FROM health
      UNION ALL SELECT 'Underperformers', underperformers, 'Count' FROM health
      UNION ALL SELECT 'CostPerClick', avg_cpc, 'None' FROM summary
      UNION ALL SELECT 'ClickThroughRate', avg_ctr, 'Percent' FROM summary)
UNION ALL SELECT TIMESTAMP '2001-06-30 08:00:00', 'adperf/campaigns', 'Impressions', CAST(SUM(total_impressions) AS DOUBLE), 'Count', campaign_id FROM perf GROUP BY campaign_id
UNION ALL SELECT TIMESTAMP '2001-06-30 08:00:00', 'adperf/campaigns', 'CTR', """ + o.avg("avg_ctr", 6) + """, 'Percent', campaign_id FROM perf GROUP BY campaign_id"""


def optimizer_rows(s, d):
    p = stored_perf(s, d)
    rows = metrics.optimizer_metrics(p, decisions.classify_creatives(p), all_actions(p), RUN_AT)
    return without_zone(rows, "ts").select(
        "ts", "namespace", "name", round_half_up("value", 6).alias("value"), "unit",
        F.try_element_at("dimensions", F.lit("CampaignId")).alias("campaign_id"),
    )


def _rounded(inner: str) -> str:
    return f"SELECT ts, namespace, name, {o.hu('value', 6)} AS value, unit, campaign_id FROM ({inner})"


add(
    "u02_union_actions",
    lambda s, d: all_actions(perf(s, d)).drop("metrics"),
    o.sql(
        """SELECT action, creative_id, campaign_id, reason, CAST(NULL AS DOUBLE) AS old_bid, CAST(NULL AS DOUBLE) AS new_bid, CAST(NULL AS DOUBLE) AS change FROM acts
UNION ALL SELECT 'bid_adjustment', NULL, campaign_id, reason, old_bid, new_bid, change FROM bidacts""",
        "acts",
        "bidacts",
    ),
)
add(
    "u03_union_metrics",
    all_metrics,
    o.sql(
        _rounded(
            f"SELECT ts, 'adperf/collector' AS namespace, name, value, unit, CAST(NULL AS VARCHAR) AS campaign_id FROM runmetrics UNION ALL {OPTIMIZER_ROWS}"
        ),
        "runmetrics",
        "counts",
        "summary",
        "health",
    ),
)

# --- scalar functions -----------------------------------------------------------------------------


def document_features(s, d):
    return tx.add_text_features(tables.documents(s, d).select("doc_id", "text"), "text").drop("text")


def basic_features(s, d):
    return tx.add_basic_features(tables.documents(s, d).select("doc_id", "text"), "text").drop("text")


def content_features(s, d):
    return tx.add_text_features(tables.creative_content(s, d, per_part=True), "combined_text").drop("combined_text")


def parsed_copy(s, d):
    """Parts as generated variations, answered with a tagged fence, a plain fence, bare or broken."""
    content = tables.creative_content(s, d, per_part=True)
    key = F.substring("creative_id", 4, 20).cast("bigint")
    item = F.struct("headline", "description", "cta", F.lit("benefit").alias("angle"))
    body = F.to_json(F.array(item))
    answer = (
        F.when(key % 4 == 0, F.concat(F.lit("Here:\n```json\n"), body, F.lit("\n```\nDone.")))
        .when(key % 4 == 1, F.concat(F.lit("```\n"), body, F.lit("\n```")))
        .when(key % 4 == 2, body)
        .otherwise(F.concat(F.lit("Sorry, "), F.col("description")))
    )
    return tx.parse_copy(content.select("creative_id", answer.alias("response")), "response")


def calendar(s, d):
    times = el(s, d).select("pulled_ts", "report_date").distinct()
    hour_sin, hour_cos = dates.cyclic(F.hour("pulled_ts"), 24)
    day_sin, day_cos = dates.cyclic(dates.dow0("report_date"), 7)
    iso = dates.iso_text("pulled_ts")
    return times.select(
        iso.alias("pulled_at"),
        F.to_date(dates.instant(iso)).alias("day"),
        dates.file_stamp("pulled_ts").alias("stamp"),
        F.hour("pulled_ts").alias("hour"),
        dates.dow0("report_date").alias("dow"),
        dates.day_name(dates.dow0("report_date")).alias("day_name"),
        dates.week_start("report_date").alias("week"),
        dates.month_start("report_date").alias("month"),
        dates.is_weekend(dates.dow0("report_date")).alias("weekend"),
        dates.is_business_hours(F.hour("pulled_ts")).alias("business"),
        dates.is_peak_hours(F.hour("pulled_ts")).alias("peak"),
        *[round_half_up(c, 6).alias(n) for n, c in
          (("hour_sin", hour_sin), ("hour_cos", hour_cos), ("day_sin", day_sin), ("day_cos", day_cos))],
    )


add("f01_f15_document_features", document_features, f"SELECT doc_id, {o.text_columns('text')} FROM documents")
add("f16_content_features", content_features, o.sql(
    f"SELECT creative_id, headline, description, cta, {o.text_columns('combined_text')} FROM contentp", "contentp"))
_BASIC = o.text_columns("text", [n for n in tx.BASIC_FEATURE_NAMES if n != "mention_data"])  # no text is empty
add("f17_basic_features", basic_features, f"SELECT doc_id, {_BASIC}, contains(lower(text), 'data') AS mention_data FROM documents")
add(
    "f19_parse_copy",
    parsed_copy,
    o.sql(
        """SELECT creative_id, 0 AS position, headline, description, cta, 'benefit' AS angle, length(headline) <= 70 AS headline_fits,
       length(description) <= 150 AS description_fits FROM contentp WHERE CAST(substr(creative_id, 4) AS BIGINT) % 4 < 3""",
        "contentp",
    ),
)
add(
    "f20_f27_calendar",
    calendar,
    o.sql(
        f"""SELECT strftime(pulled_ts, '%Y-%m-%dT%H:%M:%S.%f') AS pulled_at, report_date AS day, strftime(pulled_ts, '%Y%m%d_%H%M%S') AS stamp,
       CAST(hour AS INTEGER) AS hour, CAST(dow AS INTEGER) AS dow, dayname(report_date) AS day_name,
       CAST(date_trunc('week', report_date) AS DATE) AS week, CAST(date_trunc('month', report_date) AS DATE) AS month,
       CASE WHEN dow IN (0, 6) THEN 1 ELSE 0 END AS weekend, CASE WHEN hour BETWEEN 9 AND 17 THEN 1 ELSE 0 END AS business,
       CASE WHEN hour BETWEEN 10 AND 14 THEN 1 ELSE 0 END AS peak, {o.hu('sin(2 * pi() * hour / 24)', 6)} AS hour_sin,
       {o.hu('cos(2 * pi() * hour / 24)', 6)} AS hour_cos, {o.hu('sin(2 * pi() * dow / 7)', 6)} AS day_sin, {o.hu('cos(2 * pi() * dow / 7)', 6)} AS day_cos
FROM (SELECT DISTINCT pulled_ts, report_date, extract(hour FROM pulled_ts) AS hour, extract(dow FROM report_date) AS dow FROM el)""",
        "el",
    ),
)
add(
    "f31_optimal_bid",
    lambda s, d: training.bid_training_set(el(s, d, 30), AS_OF).select("campaign_id", "hour_of_day", "day_of_week", "optimal_bid"),
    o.sql("SELECT campaign_id, hour_of_day, day_of_week, optimal_bid FROM bset", "bset"),
)
add(
    "f32_heuristic_bid",
    lambda s, d: decisions.propose_bids(perf(s, d)).drop("bid_source"),
    o.sql("SELECT * FROM bids", "bids"),
)

# --- decisions ------------------------------------------------------------------------------------


def flat_actions(s, d):
    m = F.col("metrics")
    return decisions.classify_creatives(perf(s, d)).select(
        "creative_id", "campaign_id", "action", "reason",
        F.try_element_at(m, F.lit("ctr")).alias("metric_ctr"), F.try_element_at(m, F.lit("cpc")).alias("metric_cpc"),
        F.try_element_at(m, F.lit("clicks")).alias("clicks"), F.try_element_at(m, F.lit("cost")).alias("cost"),
    )


def report(s, d):
    return decisions.report_lines(stored_perf(s, d))


def triggers(s, d):
    return decisions.extra_triggers(perf(s, d), decisions.campaigns_today(ds(s, d, 30), AS_OF), AS_OF)


add(
    "d01_creative_rules",
    flat_actions,
    o.sql(
        """SELECT creative_id, campaign_id, action, reason, metric_ctr, metric_cpc, CASE WHEN action IS NOT NULL THEN CAST(total_clicks AS DOUBLE) END AS clicks,
       CASE WHEN action IS NOT NULL THEN total_cost END AS cost FROM classified""",
        "classified",
    ),
)
add(
    "d02_bid_adjustments",
    lambda s, d: decisions.bid_actions(perf(s, d)),
    o.sql("SELECT 'bid_adjustment' AS action, campaign_id, old_bid, new_bid, change, reason FROM bidacts", "bidacts"),
)
add("d03_action_log", lambda s, d: flat_log(decisions.log_rows(all_actions(perf(s, d)), RUN_AT)), LOG_SQL)
add(
    "d04_daily_report",
    report,
    o.sql(
        f"""SELECT 0 AS section, '' AS sort_key, 'ACTIONS TAKEN: ' || total_actions AS line FROM counts
UNION ALL SELECT 1, '', 'PAUSED CREATIVES: ' || paused FROM counts WHERE paused > 0
UNION ALL SELECT 1, creative_id || '/' || campaign_id, '  • ' || creative_id || ': ' || reason FROM acts WHERE action = 'paused'
UNION ALL SELECT 2, '', 'BID ADJUSTMENTS: ' || bid_adjustments FROM counts WHERE bid_adjustments > 0
UNION ALL SELECT 2, campaign_id, '  • Campaign ' || campaign_id || ': $' || {o.usd('old_bid')} || ' → $' || {o.usd('new_bid')}
          || CASE WHEN change > 0 THEN ' ↑' ELSE ' ↓' END FROM bidacts
UNION ALL SELECT 3, '', 'TOP PERFORMERS: ' || top_performers FROM counts WHERE top_performers > 0
UNION ALL SELECT 3, creative_id || '/' || campaign_id, '  • ' || creative_id || ': CTR ' || {o.usd('avg_ctr')} || '%' FROM acts WHERE action = 'top_performer'
UNION ALL SELECT 4, '0', 'Total Impressions: ' || format('{{:,}}', total_impressions) FROM summary
UNION ALL SELECT 4, '1', 'Total Clicks: ' || format('{{:,}}', total_clicks) FROM summary
UNION ALL SELECT 4, '2', 'Total Cost: $' || {o.usd('total_cost')} FROM summary
UNION ALL SELECT 4, '3', 'Average CTR: ' || {o.usd('COALESCE(avg_ctr, 0)')} || '%' FROM summary
UNION ALL SELECT 4, '4', 'Average CPC: $' || {o.usd('COALESCE(avg_cpc, 0)')} FROM summary""",
        "counts",
        "acts",
        "bidacts",
        "summary",
    ),
)
add("d05_optimizer_metrics", optimizer_rows, o.sql(_rounded(OPTIMIZER_ROWS), "counts", "summary", "health"))
add(
    "d07_extra_triggers",
    triggers,
    o.sql(
        f"""SELECT 'create_variation' AS trigger, creative_id AS resource_id, campaign_id, avg_ctr AS value FROM perf WHERE avg_ctr > 3
UNION ALL SELECT 'lower_bid', campaign_id, campaign_id, old_bid FROM bids WHERE old_bid > 8
UNION ALL SELECT 'reduce_budget', campaign_id, campaign_id, budget * 0.5 FROM today WHERE extract(dow FROM DATE '{AS_OF}') IN (0, 6)
UNION ALL SELECT 'broaden_targeting', campaign_id, campaign_id, 0.0 FROM today WHERE COALESCE(shown, 0) = 0""".replace(
            "today",
            f"""(SELECT campaign_id, arg_max(daily_budget, report_date) AS budget, SUM(impressions) FILTER (report_date = DATE '{AS_OF}') AS shown
   FROM ds WHERE {o.days(30)} GROUP BY 1)""",
        ),
        "perf",
        "bids",
        "ds",
    ),
)
add(
    "d08_independent_rules",
    lambda s, d: decisions.independent_rules(reports.recent_performance(cp(s, d, 7), AS_OF)),
    o.sql(
        f"""SELECT creative_id, 'paused' AS action, 'CTR ' || {o.usd('ctr')} || '% below threshold' AS reason FROM ({RECENT}) WHERE ctr < 1 AND clicks > 100
UNION ALL SELECT creative_id, 'scaled', 'High CTR ' || {o.usd('ctr')} || '%' FROM ({RECENT}) WHERE ctr > 3
UNION ALL SELECT creative_id, 'paused', 'CPC $' || {o.usd('cpc')} || ' above threshold' FROM ({RECENT}) WHERE cpc > 8""",
        "cp",
    ),
)
add(
    "d09_change_payload",
    lambda s, d: decisions.change_payload(all_actions(perf(s, d))),
    o.sql(
        f"""SELECT action, creative_id AS resource_id, campaign_id, '{{"status":"PAUSED"}}' AS payload FROM acts WHERE action = 'paused'
UNION ALL SELECT 'bid_adjustment', campaign_id, campaign_id, '{{"unitCost":{{"amount":"' || {o.usd('new_bid')} || '","currencyCode":"USD"}}}}' FROM bidacts""",
        "acts",
        "bidacts",
    ),
)

# --- training sets and models ---------------------------------------------------------------------


def creative_set(s, d):
    return training.creative_training_set(
        cp(s, d, 60, per_part=True), tables.creative_content(s, d, per_part=True), AS_OF
    )


def bid_set(s, d):
    return training.bid_training_set(el(s, d, 30), AS_OF)


BID_FEATURES = [
    "hour_sin", "hour_cos", "day_sin", "day_cos", "ctr_squared", "cpc_squared", "ctr_x_conversion_rate",
    "cpc_x_clicks", "log_impressions", "log_clicks", "cost_per_impression",
]


def rounded_bid_features(s, d):
    return r6(training.bid_features(bid_set(s, d)), *BID_FEATURES)


_FEATURES_SQL = f"""{o.hu('sin(2 * pi() * hour_of_day / 24)', 6)} AS hour_sin, {o.hu('cos(2 * pi() * hour_of_day / 24)', 6)} AS hour_cos,
  {o.hu('sin(2 * pi() * day_of_week / 7)', 6)} AS day_sin, {o.hu('cos(2 * pi() * day_of_week / 7)', 6)} AS day_cos,
  {o.hu('avg_ctr * avg_ctr', 6)} AS ctr_squared, {o.hu('avg_cpc * avg_cpc', 6)} AS cpc_squared,
  {o.hu('avg_ctr * avg_conversion_rate', 6)} AS ctr_x_conversion_rate, {o.hu('avg_cpc * total_clicks', 6)} AS cpc_x_clicks,
  {o.hu('ln(1 + total_impressions::DOUBLE)', 6)} AS log_impressions, {o.hu('ln(1 + total_clicks::DOUBLE)', 6)} AS log_clicks,
  {o.hu('total_cost / (total_impressions + 1)', 6)} AS cost_per_impression"""


def prepared_bids(s, d):
    rows, _ = training.prepare_bids(training.bid_features(bid_set(s, d)))
    return r6(rows, *BID_FEATURES)


def prepared_creatives(s, d):
    rows, _ = training.prepare_creative(creative_set(s, d))
    return rows


def split_rows(s, d):
    rows = bid_set(s, d)
    keys = ["campaign_id", "hour_of_day", "day_of_week"]
    return rows.select(*keys, (models.bucket(*keys) < 80).alias("in_train"))


def heuristic_scored(s, d):
    from .functions.bids import heuristic_bid

    return models.evaluate(bid_set(s, d).withColumn("prediction", heuristic_bid("avg_ctr", "avg_cpc")), "optimal_bid")


def later_cpc(s, d):
    """Last week's proposed bids next to the cost per click of the week after."""
    before = AS_OF - timedelta(days=8)
    proposed = decisions.propose_bids(perf(s, d, before)).select("campaign_id", F.col("new_bid").alias("predicted"))
    actual = decisions.campaign_rollup(perf(s, d)).select("campaign_id", F.col("avg_cpc").alias("actual"))
    return decisions.prediction_vs_actual(proposed, actual, "campaign_id")


add("m01_creative_training_set", creative_set, o.sql("SELECT * FROM cset", "cset"))
add("m02_bid_training_set", bid_set, o.sql("SELECT * FROM bset", "bset"))
add("m03_bid_features", rounded_bid_features, o.sql(f"SELECT *, {_FEATURES_SQL} FROM bset", "bset"))
_INT_FLAGS = ", ".join(
    f"COALESCE(CAST({n} AS INTEGER), 0) AS {n}" for n in tx.FEATURE_NAMES if n.startswith(("has_", "mention_"))
)
add(
    "m04_prepared_creatives",
    prepared_creatives,
    o.sql(
        f"""SELECT creative_id, avg_ctr, COALESCE(word_count, 0) AS word_count, COALESCE(char_count, 0) AS char_count,
       COALESCE(sentence_count, 0) AS sentence_count, COALESCE(uppercase_ratio, 0) AS uppercase_ratio, {_INT_FLAGS},
       COALESCE(cta_type, 'none') AS cta_type, month, day_of_week FROM cset WHERE avg_ctr IS NOT NULL""",
        "cset",
    ),
)
add(
    "m04_prepared_bids",
    prepared_bids,
    o.sql(
        f"""SELECT campaign_id, optimal_bid, hour_of_day, day_of_week, COALESCE(avg_ctr, 0) AS avg_ctr, COALESCE(avg_conversion_rate, 0) AS avg_conversion_rate,
       total_impressions, total_clicks, is_weekend, is_business_hours, is_peak_hours, {", ".join(f"COALESCE({n}, 0) AS {n}" for n in BID_FEATURES)}
FROM (SELECT *, {_FEATURES_SQL} FROM bset) WHERE optimal_bid > 0 AND optimal_bid < 50""",
        "bset",
    ),
)


def _profile_sql(target: str, source: str) -> str:
    return o.sql(
        f"""SELECT COUNT({target}) AS samples, MIN({target}) AS minimum, MAX({target}) AS maximum, {o.avg(target, 6)} AS mean,
       {o.hu(f'median({target})', 6)} AS median FROM {source}""",
        source,
    )


add("m05_ctr_profile", lambda s, d: r6(training.target_profile(creative_set(s, d), "avg_ctr"), "median"), _profile_sql("avg_ctr", "cset"))
add("m05_bid_profile", lambda s, d: r6(training.target_profile(bid_set(s, d), "optimal_bid"), "median"), _profile_sql("optimal_bid", "bset"))
add(
    "m06_split",
    split_rows,
    o.sql(
        """SELECT campaign_id, hour_of_day, day_of_week,
       CAST('0x' || substr(md5('42|' || campaign_id || '|' || hour_of_day || '|' || day_of_week), 1, 8) AS BIGINT) % 100 < 80 AS in_train FROM bset""",
        "bset",
    ),
)
add(
    "m10_heuristic_evaluation",
    heuristic_scored,
    o.sql(
        f"""SELECT COUNT(e) AS samples, {o.hu('AVG(e * e)', 6)} AS mse, {o.hu('sqrt(AVG(e * e))', 6)} AS rmse, {o.hu('AVG(abs(e))', 6)} AS mae,
       {o.hu('1 - AVG(e * e) / NULLIF(var_pop(y), 0)', 6)} AS r2, {o.hu('AVG(abs(e / NULLIF(y, 0))) * 100', 6)} AS mape
FROM (SELECT optimal_bid AS y, optimal_bid - ({o._heuristic_bid('avg_ctr', 'avg_cpc')}) AS e FROM bset)""",
        "bset",
    ),
)
_before = AS_OF - timedelta(days=8)
add(
    "m15_prediction_vs_actual",
    later_cpc,
    o.sql(
        f"""SELECT campaign_id, p.new_bid AS predicted, a.old_bid AS actual, p.new_bid - a.old_bid AS difference
FROM ({o.bids_sql('(' + o.perf_sql(_before) + ')')}) p JOIN bids a USING (campaign_id)""",
        "cp",
        "bids",
    ),
)

_FITS: dict[tuple, object] = {}


def _once(kind: str, s: SparkSession, d: str, make):
    """One fit per session and data folder, shared by the queries about that model."""
    key = (kind, s.sparkContext.applicationId, d)
    if key not in _FITS:
        _FITS[key] = make()
    return _FITS[key]


def forest(s, d):
    """(model, train, test, features) of the creative scorer."""

    def make():
        prepared, features = training.prepare_creative(creative_set(s, d))
        rows = jobs.store(prepared, shared_dir(s, "creative_features"))
        train, test = models.split(rows, "creative_id")
        return models.fit(models.creative_scorer(rows, features), train), train, test, features

    return _once("forest", s, d, make)


BID_KEYS = ("campaign_id", "hour_of_day", "day_of_week")


def boosted(s, d):
    """(model, train, test, features) of the bid model."""

    def make():
        prepared, features = training.prepare_bids(training.bid_features(bid_set(s, d)))
        rows = jobs.store(prepared, shared_dir(s, "bid_features"))
        train, test = models.split(rows, *BID_KEYS)
        return models.fit(models.bid_model(rows, features), train), train, test, features

    return _once("boosted", s, d, make)


def forest_predictions(s, d):
    model, train, test, _ = forest(s, d)
    return models.score(model, train.unionByName(test), ["creative_id", "avg_ctr"])


def bid_predictions(s, d):
    model, train, test, _ = boosted(s, d)
    return models.score(model, train.unionByName(test), [*BID_KEYS, "optimal_bid"])


def evaluation(fitted, target):
    model, train, test, _ = fitted
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return models.evaluate(model.transform(both), target, keys=["part"])


def reloaded_scores(s, d):
    model, train, test, _ = boosted(s, d)
    path = shared_dir(s, "model")
    model.write().overwrite().save(path)
    loaded = models.PipelineModel.load(path)
    return models.score(loaded, train.unionByName(test), BID_KEYS, "predicted_bid")


def model_bids(s, d):
    """Bids per campaign with the model's predictions in place of the formula."""
    by_campaign = reloaded_scores(s, d).groupBy("campaign_id").agg(mean_of("predicted_bid", 6).alias("predicted_bid"))
    return decisions.propose_bids(perf(s, d), predicted=by_campaign)


def forest_cv(s, d):
    _, train, _, features = forest(s, d)
    return models.cross_validate(models.creative_scorer(train, features), train, "avg_ctr", "creative_id")


def boosted_cv(s, d):
    _, train, _, features = boosted(s, d)
    return models.cross_validate(models.bid_model(train, features), train, "optimal_bid", *BID_KEYS)


def pruned_scores(s, d, fitted, kind, min_split, target, keys):
    """Every row's score by the pruned trees, beside what holds for it whatever the fit.

    ``agrees``: the unpruned node table gives the fitted model's own prediction. ``in_range``: the pruned score of a forest
    lies between the smallest and the largest training target; of boosting it is finite. ``small_splits``: splits of too
    few rows that remain.
    """
    model, train, test, _ = fitted(s, d)
    path = shared_dir(s, "nodes")
    whole = jobs.store(trees.nodes(s, model, f"{path}/model"), f"{path}/whole")
    fewer = jobs.store(trees.pruned(whole, min_split), f"{path}/pruned")
    rows = train.unionByName(test)
    own = models.score(model, rows, rows.columns, "own")
    scored = trees.score(model, fewer, trees.score(model, whole, own, "by_nodes"), "pruned")
    low, high = train.agg(F.min(target), F.max(target)).first()
    margin = 1e-9 * max(1.0, abs(low or 0.0), abs(high or 0.0))
    bounded = F.col("pruned").between((low or 0.0) - margin, (high or 0.0) + margin) if kind == "forest" else F.abs("pruned") < float("inf")
    small = fewer.filter((F.col("left") >= 0) & (F.col("n_rows") < min_split)).count()
    return scored.select(
        *keys, target, (F.abs(F.col("own") - F.col("by_nodes")) <= 1e-9 * F.greatest(F.lit(1.0), F.abs("own"))).alias("agrees"),
        (bounded & ~F.isnan("pruned")).alias("in_range"), F.lit(small).cast("bigint").alias("small_splits"),
    )


def published(s, d):
    """The bid model published by two publishers at once and once more, then rolled back to version 1: one row per version with
    its entries, and the rows that the version in production scores."""
    model, train, test, features = boosted(s, d)
    store = models.ModelRegistry(s, shared_dir(s, "registry"))
    publish = lambda day: store.publish("bid", model, "GBTRegressor", {}, features, "optimal_bid", datetime(2001, 6, day))
    with ThreadPool(2) as pool:
        pool.map(inheritable_thread_target(s)(publish), (1, 2))
    publish(3)
    store.rollback("bid", 1, datetime(2001, 6, 4))
    version = store.current("bid")["version"]
    scored = models.score(store.load("bid"), train.unionByName(test), [], "bid").filter("bid IS NOT NULL").count()
    entries = store.rows().groupBy("version").agg(F.count("*").alias("entries"))
    return entries.select(
        "version", "entries", (F.col("version") == version).alias("in_production"),
        F.when(F.col("version") == version, F.lit(scored)).cast("bigint").alias("scored"),
    )


add("m07_creative_scorer", forest_predictions)
add(
    "m14_registry",
    published,
    o.sql(
        """SELECT v.version, v.entries, v.version = 1 AS in_production, CASE WHEN v.version = 1 THEN n.scored END AS scored
FROM (VALUES (1, CAST(2 AS BIGINT)), (2, CAST(1 AS BIGINT)), (3, CAST(1 AS BIGINT))) v(version, entries),
     (SELECT COUNT(*) AS scored FROM bset WHERE optimal_bid > 0 AND optimal_bid < 50) n""",
        "bset",
    ),
)
add(
    "m07_pruned",
    lambda s, d: pruned_scores(s, d, forest, "forest", trees.CREATIVE_SPLIT, "avg_ctr", ["creative_id"]),
    o.sql(
        "SELECT creative_id, avg_ctr, TRUE AS agrees, TRUE AS in_range, CAST(0 AS BIGINT) AS small_splits FROM cset WHERE avg_ctr IS NOT NULL", "cset"
    ),
)
add(
    "m08_pruned",
    lambda s, d: pruned_scores(s, d, boosted, "boosting", trees.BID_SPLIT, "optimal_bid", list(BID_KEYS)),
    o.sql(
        f"""SELECT {", ".join(BID_KEYS)}, optimal_bid, TRUE AS agrees, TRUE AS in_range, CAST(0 AS BIGINT) AS small_splits
FROM bset WHERE optimal_bid > 0 AND optimal_bid < 50""",
        "bset",
    ),
)
add("m08_bid_model", bid_predictions)
add("m09_batch_scoring", reloaded_scores)
add("m09_model_bids", model_bids)
add("m10_creative_evaluation", lambda s, d: evaluation(forest(s, d), "avg_ctr"))
add("m10_bid_evaluation", lambda s, d: evaluation(boosted(s, d), "optimal_bid"))
add("m11_creative_importance", lambda s, d: models.top_importance(models.feature_importance(*forest(s, d)[:2])))
add("m11_bid_importance", lambda s, d: models.top_importance(models.feature_importance(*boosted(s, d)[:2])))
add("m12_creative_cross_validation", forest_cv)
add("m12_bid_cross_validation", boosted_cv)
add(
    "m13_sample_predictions",
    lambda s, d: models.sample_predictions(boosted(s, d)[0].transform(boosted(s, d)[2]), "optimal_bid", *BID_KEYS),
)

# --- streaming, metrics, alarms -------------------------------------------------------------------


def ingested(s, d):
    """The raw documents through the streaming ingest; its daily view must equal the batch view."""
    store = ingest.Store(s, shared_dir(s, "store"), unit="month")
    ingest.run_ingest(store, written_raw(s, d), shared_dir(s, "progress"), multi_line=False)
    return store.table("creative_performance").drop("period")


def ingested_weekly(s, d):
    """The weekly table the ingest keeps, for the weeks that lie in the last 180 days as a whole."""
    store = ingest.Store(s, shared_dir(s, "store"), unit="month")
    ingest.run_ingest(store, written_raw(s, d), shared_dir(s, "progress"), multi_line=False)
    return store.table("weekly").drop("period")


def pull_rule(n: int):
    """A number below ``n`` for every pull, from its day and campaign."""
    number = F.regexp_extract("campaign_id", r"([0-9]+)", 1).cast("int")
    return F.pmod(F.dayofyear(F.to_date(dates.instant("pulled_at"))) + number, F.lit(n))


def pull_rule_sql(n: int) -> str:
    return f"((dayofyear(pulled_ts) + CAST(regexp_extract(campaign_id, '([0-9]+)', 1) AS INTEGER)) % {n})"


def as_lines(docs: DataFrame) -> DataFrame:
    """Documents as JSON lines, with their rule below 7."""
    return docs.select(pull_rule(7).alias("rule"), F.to_json(F.struct(*RAW.names)).alias("text"))


def written_lines(s, lines: DataFrame) -> str:
    path = shared_dir(s, "delivered")
    lines.select("text").write.text(path, compression="gzip")
    return path


def faulty_sources(s: SparkSession, d: str) -> list[str]:
    """The raw documents as two sources deliver them, one after the other.

    First: pulls of rule 0 with doubled impressions and an invented creative, rule 1 cut in the middle, rule 2 missing, rule 3 without
    elements. Then the right documents of rules 0 to 3, those of rules 4 and 5 again, and those of rule 6 with a field of another type.
    """
    key = (s.sparkContext.applicationId, d, "faulty")
    if key not in _RAW_PATHS:
        docs = stored_documents(s, d)
        rule, elements = pull_rule(7), F.col("analytics.elements")
        doubled = F.transform(elements, lambda e: e.withField("impressions", e["impressions"] * 2))
        more = F.concat(doubled, F.transform(F.slice(elements, 1, 1), lambda e: e.withField("pivotValue", F.lit("invented"))))
        wrong = F.when(rule == 0, more).when(rule == 3, F.slice(elements, 1, 0)).otherwise(elements)
        first = as_lines(docs.withColumn("analytics", F.struct(wrong.alias("elements")))).filter("rule <> 2")
        cut = F.expr("CASE WHEN rule = 1 THEN substring(text, 1, length(text) div 2) ELSE text END")
        right = as_lines(docs)
        mistyped = F.expr("CASE WHEN rule = 6 THEN concat('{\"part\":\"many\",', substring(text, 2)) ELSE text END")
        _RAW_PATHS[key] = [
            written_lines(s, first.withColumn("text", cut)),
            written_lines(s, right.withColumn("text", mistyped)),
        ]
    return _RAW_PATHS[key]


def stored_documents(s, d):
    """The raw documents of the whole element table, written once per session."""
    return raw.read_raw(s, written_raw(s, d), multi_line=False).select(*RAW.names)


_STORES: dict[tuple, ingest.Store] = {}


def faulty_store(s, d) -> ingest.Store:
    """The store after both sources."""
    key = (s.sparkContext.applicationId, d)
    if key not in _STORES:
        store = ingest.Store(s, shared_dir(s, "store"), unit="month")
        for path in faulty_sources(s, d):
            ingest.run_ingest(store, path, shared_dir(s, "progress"), multi_line=False)
        _STORES[key] = store
    return _STORES[key]


def redelivered_versions(s, d):
    """Pulls per campaign, those that came in two versions, and the documents delivered."""
    store = faulty_store(s, d)
    pulls = store.pulls().join(store.deliveries().select("pull", "campaign_id").distinct(), "pull")
    counted = pulls.groupBy("campaign_id").agg(F.count("*").alias("pulls"), F.count_if(F.col("versions") > 1).alias("corrected"))
    return counted.join(store.deliveries().groupBy("campaign_id").agg(F.count("*").alias("deliveries")), "campaign_id")


def rejected(s, d):
    """Texts of each source that cannot be read, by reason, beside the documents that can."""
    parts = [
        raw.read_raw(s, path, multi_line=False, keep_corrupt=True).withColumn("source", F.lit(i))
        for i, path in enumerate(faulty_sources(s, d))
    ]
    docs = parts[0].unionByName(parts[1])
    reason = F.when(F.col(raw.CORRUPT).isNotNull(), raw.reject_reason(raw.CORRUPT)).otherwise(F.lit("accepted"))
    return docs.groupBy("source", reason.alias("reason")).agg(F.count("*").alias("texts"))


def any_case(s, d):
    """Documents whose field names are in other letter cases, some without a campaign."""
    text = F.col("text")
    for name in ("pulled_at", "campaign_config", "analytics", "elements", "impressions", "costInUsd"):
        text = F.replace(text, F.lit(f'"{name}":'), F.concat(F.lit('"'), F.upper(F.lit(name)), F.lit('":')))
    nameless = F.when(F.col("rule") == 3, F.replace(text, F.lit('"campaign_id":'), F.lit('"other_id":'))).otherwise(text)
    path = written_lines(s, as_lines(stored_documents(s, d)).withColumn("text", nameless))
    docs = raw.read_raw(s, path, multi_line=False, any_case=True)
    return raw.explode_elements(docs).groupBy("campaign_id", "campaign_name").agg(
        F.count("*").alias("elements"), F.sum("impressions").alias("impressions"), F.sum("cost").alias("cost")
    )


def late_and_undated(s, d):
    """Rules 3 to 6 first, rule 5 without a readable time, then the older rest and rule 5 again."""
    store = ingest.Store(s, shared_dir(s, "store"), unit="month")
    undated = F.when(pull_rule(7) == 5, F.lit("n/a")).otherwise(F.col("pulled_at"))
    docs = stored_documents(s, d).select(pull_rule(7).alias("rule"), *RAW.names, undated.alias("given"))
    docs = docs.withColumn("pulled_at", F.col("given")).select("rule", F.to_json(F.struct(*RAW.names)).alias("text"))
    for part in ("rule >= 3", "rule < 3 OR rule = 5"):
        ingest.run_ingest(store, written_lines(s, docs.filter(part)), shared_dir(s, "progress"), multi_line=False)
    return store.current().groupBy("campaign_id", F.col("report_date").isNull().alias("undated")).agg(
        F.count("*").alias("elements"), F.sum("clicks").alias("clicks"), F.sum("cost").alias("cost")
    )


def failing_pulls(s, d):
    """Documents of which rule 2 of 9 lost both halves, and so all of every thirtieth day."""
    docs = raw.raw_documents(el(s, d))
    lost = (pull_rule(9) == 2) | (F.dayofyear(F.to_date(dates.instant("pulled_at"))) % 30 == 0)
    halves = {c: F.when(~lost, F.col(c)) for c in ("analytics", "campaign_config")}
    return docs.withColumns(halves)


FAILED_SQL = f"({pull_rule_sql(9)} = 2 OR dayofyear(pulled_ts) % 30 = 0)"


def run_metric_rows(s, d):
    rows = metrics.run_metrics(failing_pulls(s, d)).select("ts", "name", "unit", round_half_up("value", 6).alias("value"))
    return without_zone(rows, "ts")


def event_windows(s, d):
    return without_zone(metrics.event_rollup(tables.pull_metrics(s, d), "6 hours"), "period_start")


def streamed_windows(s, d):
    windows = rollup.closed_windows(rollup.stream_events(s, d), "6 hours", "1 day")
    return without_zone(rollup.run_rollup(windows, shared_dir(s, "windows"), shared_dir(s, "progress")), "period_start")


def streamed_all_windows(s, d):
    pulls = rollup.stream_events(s, d)
    return without_zone(rollup.run_whole_rollup(pulls, shared_dir(s, "rollup"), shared_dir(s, "progress")), "period_start")


def stored_metrics(rows: DataFrame) -> DataFrame:
    """Metric rows written once: the alarms read them for their periods and for their spine."""
    return jobs.store(rows, shared_dir(rows.sparkSession, "metrics"))


# Thresholds that fit the event table; the catalogue's are for real advertising data.
EVENT_ALARMS = [
    alarms.Alarm("collection-failures", metrics.COLLECTOR, "CollectionFailure", "Sum", 21600, ">", 15.0, 2),
    alarms.Alarm("daily-spend", metrics.COLLECTOR, "TotalCost", "Sum", 86400, ">", 1500.0, 1),
    alarms.Alarm("low-ctr", metrics.COLLECTOR, "CTR", "Average", 21600, "<", 90.0, 3),
    alarms.Alarm("high-cpc", metrics.COLLECTOR, "CPC", "Average", 21600, ">", 20.0, 2),
]
COLLECTOR_ALARMS = [a for a in alarms.CATALOGUE if a.metric in ("TotalCost", "CTR", "CPC")]


def event_alarms(s, d):
    rows = stored_metrics(metrics.event_metrics(tables.pull_metrics(s, d)))
    return without_zone(alarms.evaluate_alarms(rows, EVENT_ALARMS), "period_start")


def incremental_alarms(s, d):
    """The states of ``event_alarms`` from a stream in three runs, its rows out of order by up to half a day."""
    rows = stored_metrics(metrics.event_metrics(tables.pull_metrics(s, d)))
    folder, out, progress = (shared_dir(s, name) for name in ("alarm-rows", "alarm-states", "alarm-progress"))
    first, last = rows.agg(F.min("ts"), F.max("ts")).first()
    found = []

    def deliver(part: DataFrame) -> None:
        part.write.mode("append").parquet(folder)
        stream = s.readStream.schema(rows.schema).parquet(folder)
        found.append(alarm_state.run_alarm_states(stream, out, progress, EVENT_ALARMS, "1 day"))

    if first is not None:
        shift = F.pmod(F.xxhash64("name", "ts"), F.lit(43_200))
        place = F.unix_timestamp("ts") - int(first.timestamp()) + shift
        run = F.least(F.floor(place * 3 / ((last - first).total_seconds() + 1)), F.lit(2))
        for i in range(3):
            deliver(rows.filter(run == i))
    # The clock closes what is open after the last row.
    end = (last or datetime(2000, 1, 1)) + timedelta(days=1, seconds=2 * max(a.period for a in EVENT_ALARMS))
    deliver(alarm_state.tick(s, end, rows.schema))
    states = found[-1]
    # Periods without data behind an alarm's last ones are states too, but not of the batch evaluation.
    until = states.filter(F.col("value").isNotNull()).groupBy("alarm").agg(F.max("period_start").alias("until"))
    states = states.join(until, "alarm").filter("period_start <= until").drop("until")
    return without_zone(states, "period_start")


def collector_alarms(s, d):
    rows = stored_metrics(metrics.collector_metrics(el(s, d)))
    return without_zone(alarms.evaluate_alarms(rows, alarms.CATALOGUE), "period_start")


def event_transitions(s, d):
    rows = stored_metrics(metrics.event_metrics(tables.pull_metrics(s, d)))
    return without_zone(alarms.transitions(alarms.evaluate_alarms(rows, EVENT_ALARMS)), "period_start")


add("r01_r07_incremental_ingest", ingested, o.sql("SELECT * FROM cp", "cp"))
add("r06_redelivery", lambda s, d: faulty_store(s, d).table("creative_performance").drop("period"), o.sql("SELECT * FROM cp", "cp"))
add(
    "r06_versions",
    redelivered_versions,
    o.sql(
        f"""SELECT campaign_id, COUNT(*) AS pulls, COUNT(*) FILTER (WHERE r IN (0, 3)) AS corrected,
       COUNT(*) + COUNT(*) FILTER (WHERE r IN (0, 3, 4, 5)) AS deliveries
FROM (SELECT campaign_id, {pull_rule_sql(7)} AS r FROM docs) GROUP BY 1""",
        "docs",
    ),
)
add("r07_creatives", lambda s, d: lifetime.creatives(faulty_store(s, d)), o.sql("SELECT * FROM meta", "meta"))
add("r07_totals", lambda s, d: lifetime.campaigns(faulty_store(s, d)), o.sql("SELECT * FROM totals", "totals"))
add(
    "r08_late_and_unreadable",
    late_and_undated,
    o.sql(
        f"""SELECT campaign_id, {pull_rule_sql(7)} = 5 AS undated, COUNT(*) AS elements, {o.isum('clicks')} AS clicks, SUM(cost) AS cost
FROM el GROUP BY 1, 2""",
        "el",
    ),
)
add(
    "s02_rejects",
    rejected,
    o.sql(
        f"""SELECT CAST(source AS INTEGER) AS source, reason, COUNT(*) AS texts FROM (
  SELECT 0 AS source, CASE WHEN r = 1 THEN 'unparsable' ELSE 'accepted' END AS reason FROM rules WHERE r <> 2
  UNION ALL SELECT 1, CASE WHEN r = 6 THEN 'mistyped' ELSE 'accepted' END FROM rules)
GROUP BY 1, 2""",
        "docs",
    ).replace("FROM rules", f"FROM (SELECT {pull_rule_sql(7)} AS r FROM docs)"),
)
add(
    "s03_any_case",
    any_case,
    o.sql(
        f"""SELECT CASE WHEN {pull_rule_sql(7)} <> 3 THEN campaign_id END AS campaign_id, campaign_name, COUNT(*) AS elements,
       {o.isum('impressions')} AS impressions, SUM(cost) AS cost FROM el GROUP BY 1, 2""",
        "el",
    ),
)
add(
    "a34_failed_pulls",
    lambda s, d: metrics.pull_success(failing_pulls(s, d)),
    o.sql(f"SELECT COUNT(*) FILTER (WHERE NOT {FAILED_SQL}) AS successful_pulls, COUNT(*) FILTER (WHERE {FAILED_SQL}) AS failed_pulls FROM docs", "docs"),
)
add(
    "a14_empty_pulls",
    lambda s, d: reports.missing_data(failing_pulls(s, d), AS_OF, 60),
    o.sql(
        f"""SELECT report_date, COUNT(*) AS pull_count, COUNT(DISTINCT campaign_id) AS unique_campaigns, COUNT(*) FILTER (WHERE {FAILED_SQL}) AS empty_pulls
FROM docs WHERE {o.days(60)} GROUP BY 1""",
        "docs",
    ),
)
add(
    "u03_run_metrics",
    run_metric_rows,
    o.sql(
        f"""SELECT ts, name, unit, {o.hu('value', 6)} AS value FROM (
  SELECT ts, unnest(['TotalImpressions', 'TotalClicks', 'TotalCost', 'CTR', 'CPC', 'SuccessfulPulls', 'FailedPulls', 'CollectionFailure']) AS name,
         unnest(['Count', 'Count', 'None', 'Percent', 'None', 'Count', 'Count', 'Count']) AS unit,
         unnest([impressions, clicks, cost, CAST(clicks AS DOUBLE) / NULLIF(impressions, 0) * 100, cost / NULLIF(clicks, 0), good, bad, CASE WHEN good = 0 THEN 1 END]) AS value
  FROM (SELECT pulled_ts AS ts, CAST(COALESCE(SUM(impressions) FILTER (WHERE NOT {FAILED_SQL}), 0) AS DOUBLE) AS impressions,
               CAST(COALESCE(SUM(clicks) FILTER (WHERE NOT {FAILED_SQL}), 0) AS DOUBLE) AS clicks,
               COALESCE(SUM(cost) FILTER (WHERE NOT {FAILED_SQL}), 0.0) AS cost,
               CAST(COUNT(DISTINCT campaign_id) FILTER (WHERE NOT {FAILED_SQL}) AS DOUBLE) AS good,
               CAST(COUNT(DISTINCT campaign_id) FILTER (WHERE {FAILED_SQL}) AS DOUBLE) AS bad
        FROM el GROUP BY 1)) WHERE value IS NOT NULL""",
        "el",
    ),
)
add("r07_weekly_refresh", ingested_weekly, o.sql("SELECT * FROM allweeks", "allweeks"))
add("r02_metric_windows", event_windows, o.sql("SELECT * FROM roll", "roll"))
add(
    "r02_metric_rollup_daily",
    lambda s, d: without_zone(metrics.metric_rollup(metrics.collector_metrics(el(s, d)), "1 day"), "period_start"),
    o.sql(
        f"""SELECT 'adperf/collector' AS namespace, name, date_trunc('day', ts) AS period_start, {o.hu('SUM(value)', 6)} AS total,
       {o.hu('AVG(value)', 6)} AS average, COUNT(*) AS samples FROM runmetrics GROUP BY 2, 3""",
        "runmetrics",
    ),
)
add(
    "r02_streamed_windows",
    streamed_windows,
    o.sql(
        "SELECT * FROM roll WHERE period_start + INTERVAL 6 HOURS <= (SELECT MAX(ts) FROM pm) - INTERVAL 1 DAY", "roll", "pm"
    ),
)
add("r02_streamed_all_windows", streamed_all_windows, o.sql("SELECT * FROM roll", "roll"))
add(
    "r03_alarm_catalogue",
    collector_alarms,
    o.alarm_sql("runmetrics", COLLECTOR_ALARMS, ("runmetrics",), "SELECT alarm, period_start, value, breach, breach_run, state FROM STATES"),
)
add(
    "r04_alarm_states",
    event_alarms,
    o.alarm_sql("eventmetrics", EVENT_ALARMS, ("eventmetrics",), "SELECT alarm, period_start, value, breach, breach_run, state FROM STATES"),
)
add(
    "r04_incremental",
    incremental_alarms,
    o.alarm_sql("eventmetrics", EVENT_ALARMS, ("eventmetrics",), "SELECT alarm, period_start, value, breach, breach_run, state FROM STATES"),
)
add(
    "r04_alarm_transitions",
    event_transitions,
    o.alarm_sql(
        "eventmetrics",
        EVENT_ALARMS,
        ("eventmetrics",),
        """SELECT alarm, period_start, previous_state, state, value
FROM (SELECT *, COALESCE(lag(state) OVER (PARTITION BY alarm ORDER BY period_start), 'OK') AS previous_state FROM STATES) WHERE state <> previous_state""",
    ),
)
add(
    "r05_dashboard_series",
    lambda s, d: without_zone(metrics.dashboard_series(tables.pull_metrics(s, d)), "period_start"),
    o.sql(
        """SELECT 'Impressions & Clicks' AS widget, 'TotalImpressions' AS series, period_start, CAST(impressions AS DOUBLE) AS value FROM roll
UNION ALL SELECT 'Impressions & Clicks', 'TotalClicks', period_start, CAST(clicks AS DOUBLE) FROM roll
UNION ALL SELECT 'Ad Spend ($)', 'TotalCost', period_start, cost FROM roll
UNION ALL SELECT 'CTR (%)', 'CTR', period_start, ctr FROM roll
UNION ALL SELECT 'CPC ($)', 'CPC', period_start, cpc FROM roll
UNION ALL SELECT 'Executions', 'Invocations', period_start, CAST(executions AS DOUBLE) FROM roll
UNION ALL SELECT 'Executions', 'Errors', period_start, CAST(errors AS DOUBLE) FROM roll""",
        "roll",
    ),
)
