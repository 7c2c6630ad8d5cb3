"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the data folder (default sf0.1), ``BENCH_CPUS`` the local cores (default 8).
Each query is planned and run in full into Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    from pyspark.sql import SparkSession

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("adperf-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    from adperf import registry as r
    from adperf.operators import aggregates, decisions, models, reports, training
    from adperf.plans import jobs
    from adperf.settings import AS_OF, configure, shared_dir
    from adperf.streaming import ingest

    configure(spark)
    times: dict[str, float] = {}

    def timed(name: str, make) -> None:
        start = time.perf_counter()
        df = make()
        if df is not None:
            df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)

    spark.read.parquet(f"{sf_dir}/nation.parquet").count()  # starts the executor threads

    whole = [
        "a01_creative_performance", "a02_daily_summary", "a03_campaign_totals", "a04_hourly_breakdown",
        "a21_creative_metadata", "a05_top_creatives", "a10_ready_to_scale", "a12_campaign_health", "a19_daily_aggregates",
        "a20_weekly_summaries", "w01_latest_pull", "w04_low_ctr_runs", "d01_creative_rules", "d02_bid_adjustments",
        "d04_daily_report", "m01_creative_training_set", "m02_bid_training_set", "f01_f15_document_features",
        "r02_metric_windows", "r04_alarm_states", "j01_unnest",
    ]
    for name in whole:
        timed(name, lambda: r.QUERIES[name](spark, sf_dir))

    view = {}

    def store_view():
        path = shared_dir(spark, "bench-cp")
        view["cp"] = jobs.store_daily(r.cp(spark, sf_dir), path, "month")

    timed("store_creative_performance", store_view)

    def cp(days):
        return jobs.stored_days(view["cp"], AS_OF, days, "month")

    timed("stored_a05_top_creatives", lambda: reports.top_creatives(cp(7), AS_OF))
    timed("stored_a06_underperforming", lambda: reports.underperforming(cp(3), AS_OF))
    timed("stored_a11_expensive", lambda: reports.expensive_low_conversion(cp(7), AS_OF))
    timed("stored_a20_weekly", lambda: aggregates.weekly_summaries(cp(180), AS_OF))
    timed("stored_d01_rules", lambda: decisions.classify_creatives(decisions.performance(cp(7), AS_OF)))

    store = ingest.Store(spark, shared_dir(spark, "bench-store"))
    day = r.raw.raw_documents(r.el(spark, sf_dir, 40))
    ingest.refresh(store, ingest.append_batch(store, day, 0))
    timed("refresh_one_day", lambda: ingest.refresh(store, [AS_OF]))

    prepared, features = training.prepare_creative(r.creative_set(spark, sf_dir))
    rows = jobs.store(prepared, shared_dir(spark, "bench-creatives"))
    timed("forest_20_trees", lambda: models.fit(models.creative_scorer(rows, features, trees=20), rows) and None)
    bids, bid_features = training.prepare_bids(training.bid_features(r.bid_set(spark, sf_dir)))
    bid_rows = jobs.store(bids, shared_dir(spark, "bench-bids"))
    timed("boosting_20_rounds", lambda: models.fit(models.bid_model(bid_rows, bid_features, rounds=20), bid_rows) and None)

    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": times, "sf": sf_dir.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
