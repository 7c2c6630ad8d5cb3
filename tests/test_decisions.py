from datetime import date, datetime

from adperf.operators import aggregates, decisions, reports, training, views
from adperf.plans import jobs
from adperf.settings import Thresholds

AS_OF = date(2024, 12, 1)
PERF = (
    "creative_id string, campaign_id string, avg_ctr double, avg_cpc double, total_clicks bigint, "
    "total_impressions bigint, total_cost double, total_conversions bigint, days_active bigint"
)


def perf(spark, rows):
    return spark.createDataFrame([(c, k, ctr, cpc, n, 1000, 10.0, 1, 1) for c, k, ctr, cpc, n in rows], PERF)


def test_rule_order(spark):
    rows = [
        ("low", "k", 0.5, 9.0, 100), ("few", "k", 0.5, 5.0, 99), ("cost", "k", 4.0, 9.0, 100), ("win", "k", 4.0, 8.0, 100),
        ("one", "k", 1.0, 8.0, 100), ("three", "k", 3.0, 8.0, 100), ("none", "k", None, None, 100), ("nocpc", "k", 0.5, None, 100),
    ]
    got = {r.creative_id: (r.action, r.reason) for r in decisions.classify_creatives(perf(spark, rows)).collect()}
    assert got["low"] == ("paused", "Low CTR (0.50%) below threshold")
    assert got["cost"] == ("paused", "High CPC ($9.00) above threshold")
    assert got["win"] == ("top_performer", "High CTR (4.00%) - candidate for scaling")
    assert got["nocpc"][0] == "paused"
    assert all(got[n] == (None, None) for n in ("few", "one", "three", "none"))


def test_thresholds_come_from_the_environment(spark):
    t = Thresholds.from_env({"MIN_CTR_THRESHOLD": "2", "MAX_CPC": "20"})
    assert (t.min_ctr, t.max_cpc, t.top_ctr, t.min_sample) == (2.0, 20.0, 3.0, 100)
    assert decisions.creative_actions(perf(spark, [("a", "k", 1.5, 9.0, 100)]), t).first().reason.startswith("Low CTR")


def test_bid_change_threshold_and_model_bids(spark):
    p = perf(spark, [("a", "up", 1.0, 5.0, 100), ("b", "same", 2.0, 5.0, 100), ("c", "half", 1.6, 2.0, 100)])
    bids = {r.campaign_id: r for r in decisions.bid_actions(p).collect()}
    assert set(bids) == {"up", "half"}
    assert (bids["up"].new_bid, bids["half"].change) == (7.5, 0.5)
    predicted = spark.createDataFrame([("same", 9.994)], "campaign_id string, predicted_bid double")
    source = {r.campaign_id: (r.new_bid, r.bid_source) for r in decisions.propose_bids(p, predicted=predicted).collect()}
    assert source["same"] == (9.99, "model") and source["up"] == (7.5, "heuristic")


def test_two_rules_may_fire_in_the_independent_variant(spark):
    df = spark.createDataFrame([("a", 0.5, 9.0, 200), ("b", 4.0, 9.0, 200), ("c", 2.0, 2.0, 200)],
                               "creative_id string, ctr double, cpc double, clicks bigint")
    got = sorted((r.creative_id, r.action) for r in decisions.independent_rules(df).collect())
    assert got == [("a", "paused"), ("a", "paused"), ("b", "paused"), ("b", "scaled")]


def test_extra_triggers(spark):
    p = perf(spark, [("a", "k", 4.0, 9.0, 200)])
    today = spark.createDataFrame([("k", 100.0, 5), ("quiet", 40.0, None)],
                                  "campaign_id string, daily_budget double, impressions bigint")
    sunday = sorted((r.trigger, r.resource_id, r.value) for r in decisions.extra_triggers(p, today, AS_OF).collect())
    assert sunday == [
        ("broaden_targeting", "quiet", 0.0), ("create_variation", "a", 4.0), ("lower_bid", "k", 9.0),
        ("reduce_budget", "k", 50.0), ("reduce_budget", "quiet", 20.0),
    ]
    monday = decisions.extra_triggers(p, today, date(2024, 12, 2))
    assert monday.filter("trigger = 'reduce_budget'").isEmpty()


def test_report_of_nothing(spark):
    lines = [r.line for r in decisions.report_lines(perf(spark, [])).collect()]
    assert lines == ["ACTIONS TAKEN: 0", "Total Impressions: 0", "Total Clicks: 0", "Total Cost: $0.00",
                     "Average CTR: 0.00%", "Average CPC: $0.00"]


def test_winning_patterns_without_winners(spark, elements):
    cp = views.creative_performance(elements([("2024-12-01", 6, "a", "x", 1000, 1, 1.0, 0)]))
    row = jobs.run_copy_patterns(cp, AS_OF).first()
    assert (row.avg_ctr, row.avg_cpc, row.total_conversions, row.sample_size) == (2.5, 5.0, 0, 0)
    assert row.insights == ["Using general best practices for B2B ads"]


def test_low_ctr_runs_need_consecutive_days(spark, elements):
    low = [("2024-11-0%d" % d, 6, "a", "x", 1000, 5, 1.0, 0) for d in (1, 2, 4, 5, 6, 7)]
    cp = views.creative_performance(elements(low + [("2024-11-03", 6, "a", "x", 1000, 50, 1.0, 0)]))
    ends = sorted(r.run_end for r in reports.low_ctr_runs(cp).collect())
    assert ends == [date(2024, 11, 6), date(2024, 11, 7)]


def test_sums_are_kept(spark, elements):
    df = elements([("2024-11-%02d" % (i % 28 + 1), 6, f"k{i % 3}", f"c{i % 7}", i, i // 2, i * 0.25, i % 2) for i in range(300)])
    cp = views.creative_performance(df)
    assert cp.groupBy().sum("total_impressions").first()[0] == df.groupBy().sum("impressions").first()[0]
    weekly = aggregates.weekly_summaries(cp)
    assert weekly.groupBy().sum("clicks").first()[0] == df.groupBy().sum("clicks").first()[0]


def test_processing_and_optimisation_jobs(spark, tmp_path):
    from adperf.sources import tables
    from tests.conftest import SMALL

    as_of, at = date(2001, 6, 30), datetime(2001, 6, 30, 6)
    el = tables.ad_elements(spark, SMALL, as_of, 180)
    content = tables.creative_content(spark, SMALL)
    root = str(tmp_path)
    rows = {(r.name, (r.dimensions or {}).get("DatasetType")): r.value
            for r in jobs.run_processing(spark, el, content, root, as_of, at, unit="month").collect()}
    assert rows[("DatasetsCreated", None)] == 2 and rows[("AggregatesCreated", None)] == 3
    assert rows[("DatasetSamples", "bid_optimization")] == training.bid_training_set(el, as_of).count()
    cp = spark.read.parquet(f"{root}/creative_performance").drop("period")
    result = jobs.run_optimisation(cp, root, as_of, at)
    n = result.actions.count()
    assert n > 0 and spark.read.json(f"{root}/logs/optimizer_actions/date=2001-06-30").count() == n
    assert result.report.first().line == f"ACTIONS TAKEN: {n}"
    assert result.metrics.filter("namespace = 'adperf/optimizer'").count() == 15
    assert jobs.run_optimisation(cp.limit(0), root, as_of, datetime(2001, 6, 30, 7)) is None


def test_weekly_growth_against_the_week_before(spark):
    weekly = spark.createDataFrame(
        [(date(2024, 11, 4), "k", 100, 10, 5.0, 0), (date(2024, 11, 11), "k", 150, 5, 5.0, 2)],
        "week_start date, campaign_id string, impressions bigint, clicks bigint, cost double, conversions bigint",
    )
    last = aggregates.weekly_growth(weekly).orderBy("week_start").collect()[1]
    assert (last.impressions_growth_percent, last.clicks_growth_percent, last.conversions_growth_percent) == (50.0, -50.0, None)
