import json
import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from adperf.operators import metrics, reports, views
from adperf.sources import raw, sinks, tables
from adperf.sources.training_files import read_training
from tests.conftest import SMALL

AS_OF = date(2024, 12, 2)


def element(creative="c1", impressions=100, clicks=5, cost=10.0, conversions=1, **more):
    return {
        "pivotValue": creative, "impressions": impressions, "clicks": clicks, "costInUsd": cost,
        "externalWebsiteConversions": conversions, "approximateUniqueImpressions": impressions, **more,
    }


def document(pulled="2024-12-01T06:00:00.000000", campaign="k1", elements=(), **more):
    return {
        "pulled_at": pulled, "campaign_id": campaign, "date_range": {"start": "a", "end": "b"},
        "analytics": {"elements": list(elements)},
        "campaign_config": {"id": campaign, "name": "K", "status": "ACTIVE", "dailyBudget": {"amount": 50.0}},
        **more,
    }


def put(root, day, name, content):
    folder = os.path.join(root, *day.split("-"))
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(content if isinstance(content, str) else json.dumps(content, indent=2))


def put_text(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(content))


def test_pretty_documents_and_unnest(spark, tmp_path):
    root = str(tmp_path)
    put(root, "2024-12-01", "a.json", document(elements=[element(), element("c2")]))
    put(root, "2024-12-01", "b.json", document(campaign="k2", elements=[]))
    put(root, "2024-12-01", "c.json", document(campaign="k3", analytics={}))
    put(root, "2024-12-01", "d.json", document(campaign="k4", campaign_config={}, elements=[element("c4")]))
    docs = raw.read_raw(spark, root)
    assert docs.count() == 4
    rows = raw.explode_elements(docs).orderBy("creative_id").collect()
    assert [(r.campaign_id, r.creative_id) for r in rows] == [("k1", "c1"), ("k1", "c2"), ("k4", "c4")]
    assert rows[0].daily_budget == 50.0 and rows[2].daily_budget is None
    success = metrics.pull_success(docs).first()
    assert (success.successful_pulls, success.failed_pulls) == (4, 0)


def test_latest_pull_by_element_date(spark, tmp_path):
    root = str(tmp_path)

    def span(day):
        d = {"day": day, "month": 12, "year": 2024}
        return {"start": d, "end": d}

    put(root, "2024-12-02", "a.json", document("2024-12-02T00:00:00", elements=[element(clicks=1, dateRange=span(1))]))
    put(root, "2024-12-02", "b.json", document(
        "2024-12-02T06:00:00", elements=[element(clicks=2, dateRange=span(1)), element(clicks=3, dateRange=span(2))]))
    rows = raw.explode_elements(raw.read_raw(spark, root))
    by_element = views.latest_pull(rows, "element_date").orderBy("report_date").collect()
    assert [(r.report_date.day, r.total_clicks) for r in by_element] == [(1, 2), (2, 3)]
    assert [r.total_clicks for r in views.latest_pull(rows).collect()] == [5]


def test_malformed_documents_are_skipped_or_counted(spark, tmp_path):
    root = str(tmp_path)
    put(root, "2024-12-01", "a.json", document(elements=[element()]))
    put(root, "2024-12-01", "b.json", '{"pulled_at": "2024-12-01T0')
    assert raw.read_raw(spark, root).select("campaign_id", "pulled_at").collect() == [
        ("k1", "2024-12-01T06:00:00.000000")
    ]
    kept = raw.read_raw(spark, root, keep_corrupt=True).collect()
    assert sorted(r["_corrupt"] is not None for r in kept) == [False, True]


def test_any_case_keys(spark, tmp_path):
    root = str(tmp_path)
    put(root, "2024-12-01", "a.json", document(elements=[element("Keep:Case \"x\"")]))
    text = json.dumps(document(campaign="K2", elements=[element("C2")]))
    for key in ("pivotValue", "costInUsd", "campaign_id", "analytics"):
        text = text.replace(f'"{key}"', f'"{key.upper()}"')
    put(root, "2024-12-01", "b.json", text)
    rows = raw.explode_elements(raw.read_raw(spark, root, any_case=True)).orderBy("campaign_id").collect()
    assert [(r.campaign_id, r.creative_id, r.cost) for r in rows] == [("K2", "C2", 10.0), ("k1", 'Keep:Case "x"', 10.0)]


def test_old_files_are_not_read(spark, tmp_path):
    root = str(tmp_path)
    put(root, "2024-12-01", "a.json", document())
    put(root, "2024-10-03", "b.json", document(campaign="sixty"))
    put(root, "2024-10-02", "c.json", document(campaign="older"))
    put(root, "undated", "d.json", document(campaign="undated"))
    kept = raw.recent_files(raw.read_raw(spark, root), AS_OF, 60)
    assert sorted(r.campaign_id for r in kept.collect()) == ["k1", "sixty", "undated"]


def test_files_of_old_days_are_not_listed(spark, tmp_path):
    root = tmp_path / "raw"
    for back in range(400):  # half of them in the one layout, half in the other
        day = AS_OF - timedelta(days=back)
        folder = f"{day:%Y/%m/%d}" if back % 2 else f"year={day.year}/month={day.month}/day={day.day}"
        if back >= 70:
            (root / folder).mkdir(parents=True)
            (root / folder / "broken.json").mkdir()  # would be listed as a folder
        else:
            put_text(root / folder / "a.json", document(campaign=f"b{back}"))
    put_text(root / "2023/notes/d.json", document(campaign="no month"))
    put_text(root / "2023/13/45/d.json", document(campaign="no date"))
    put_text(root / "client/2024/12/01/d.json", document(campaign="deeper"))
    put_text(root / "client/2020/12/01/d.json", document(campaign="deeper, old"))
    put_text(root / "beside.json", document(campaign="beside"))
    put_text(root / "_hidden/e.json", document(campaign="hidden"))
    paths = raw.recent_paths(spark, str(root), AS_OF, 60)
    assert len(paths) == 61 + 4
    docs = raw.read_recent(spark, str(root), AS_OF, 60)
    kept = sorted(r.campaign_id for r in docs.collect())
    assert kept == sorted([f"b{b}" for b in range(61)] + ["no month", "no date", "deeper", "beside"])
    whole = raw.recent_files(raw.read_raw(spark, str(root)), AS_OF, 60)
    assert kept == sorted(r.campaign_id for r in whole.collect())
    none = raw.read_recent(spark, str(root / "client/2020"), AS_OF, 60, keep_corrupt=True)
    assert none.isEmpty() and none.schema == raw.RAW_OR_CORRUPT


def test_first_content_wins(spark, tmp_path):
    root = str(tmp_path)
    put(root, "2024-12-01", "a.json", document(elements=[element("c1"), element("c2", creativeContent={"headline": "H2"})]))
    put(root, "2024-12-01", "b.json", document(elements=[element("c1", creativeContent={"headline": "first", "cta": "go"})]))
    put(root, "2024-12-02", "a.json", document(elements=[element("c1", creativeContent={"headline": "second"})]))
    rows = {r.creative_id: r for r in raw.first_content(raw.read_raw(spark, root)).collect()}
    assert rows["c1"].headline == "first" and rows["c1"].combined_text == "first " and rows["c1"].cta == "go"
    assert rows["c2"].headline == "H2"


def test_element_date_and_older_documents(spark, tmp_path):
    root = str(tmp_path / "new")
    span = {"start": {"day": 30, "month": 11, "year": 2024}, "end": {"day": 1, "month": 12, "year": 2024}}
    put(root, "2024-12-01", "a.json", document(elements=[element(dateRange=span), element("c2")]))
    rows = raw.explode_elements(raw.read_raw(spark, root)).orderBy("creative_id").collect()
    assert [r.element_date for r in rows] == [date(2024, 11, 30), None]
    old = str(tmp_path / "old")
    put(old, "2024-12-01", "a.json", {
        "pulled_at": "2024-12-01T12:05:23Z", "campaign_id": "45", "campaign_name": "Q4", "ad_account_id": "1",
        "creatives": [{"creative_id": "93", "creative_name": "A", "status": "ACTIVE",
                       "metrics": {"impressions": 1250, "clicks": 45, "cost_usd": 225.0, "ctr": 0.036},
                       "targeting": {"locations": ["geo"]}, "creative_content": {"headline": "H"}}],
    })
    row = raw.read_creative_documents(spark, old).first()
    assert (row.report_date, row.creative_id, row.impressions, row.cost_usd) == (date(2024, 12, 1), "93", 1250, 225.0)
    assert row.creative_content.headline == "H" and row.targeting.locations == ["geo"]


def test_split_documents_hold_the_same_elements(spark, elements, tmp_path):
    hot = [("2024-12-01", 6, "hot", f"c{i % 40}", i, i // 2, 1.0, 0) for i in range(200)]
    cold = [("2024-12-01", 12, "cold", "c1", 5, 1, 1.0, 0), ("2024-12-02", 6, "hot", "c1", 5, 1, 1.0, 0)]
    rows = elements(hot + cold).repartition(5)
    whole, pieces = raw.raw_documents(rows), raw.raw_documents(rows, pieces=5)
    assert whole.count() == 3 and whole.filter("part IS NOT NULL").isEmpty()
    assert pieces.filter("campaign_id = 'hot' AND day(pulled_at) = 1").count() == 5
    again = raw.raw_documents(rows.repartition(3), pieces=5)
    identity = ["campaign_id", "pulled_at", "part"]
    assert sorted(map(str, again.select(*identity).collect())) == sorted(map(str, pieces.select(*identity).collect()))
    path = str(tmp_path / "raw")
    raw.write_raw(pieces, path)
    back = raw.read_raw(spark, path, multi_line=False)
    columns = ["pulled_ts", "campaign_id", "creative_id", "impressions", "clicks", "cost"]
    a, b = raw.explode_elements(back).select(*columns), rows.select(*columns)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    for report in (reports.missing_data, reports.collection_frequency):
        assert report(back, AS_OF).collect() == report(whole, AS_OF).collect()


def test_written_documents_and_missing_halves(spark, tmp_path):
    path = str(tmp_path / "raw")
    docs = raw.raw_documents(tables.ad_elements(spark, SMALL, date(2001, 6, 30), 7))
    half = docs.limit(1).withColumns(
        {"analytics": F.lit(None).cast(docs.schema["analytics"].dataType), "campaign_id": F.lit("half")}
    )
    raw.write_raw(docs.unionByName(half), path)
    back = raw.read_raw(spark, path, multi_line=False)
    assert back.count() == docs.count() + 1
    assert back.filter("campaign_id = 'half'").first().analytics.elements is None
    with open(next(p for p in _files(path) if '"half"' in open(p).read())) as f:
        line = next(x for x in f if '"half"' in x)
    assert json.loads(line)["analytics"] == {}
    report = reports.missing_data(back, date(2001, 6, 30)).collect()
    assert sum(r.empty_pulls for r in report) == 1
    assert "/year=2001/month=06/day=" in back.select("_metadata.file_path").first()[0]


def _files(path):
    return [os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".json")]


def test_campaign_list_and_low_ctr(spark, elements):
    df = elements([("2024-12-01", 6, c, "x", i, k, 1.0, 0) for c, i, k in
                   (("a", 1000, 4), ("b", 1000, 5), ("c", None, 1), ("d", 0, 1))])
    assert sorted(r.campaign_id for r in raw.only_campaigns(df, " a, ,b").collect()) == ["a", "b"]
    assert raw.only_campaigns(df, " , ").isEmpty()
    assert sorted(r.campaign_id for r in raw.skip_low_ctr(df).collect()) == ["b", "c"]


def test_training_sinks_and_reader(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5), ("b", None)], "id string, x double")
    paths = sinks.write_training_set(df, str(tmp_path), "set", datetime(2024, 1, 2, 3, 4, 5))
    assert paths["parquet"].endswith("run_ts=20240102_030405")
    root = str(tmp_path / "training" / "set")
    assert read_training(spark, root).count() == 4
    assert read_training(spark, root, ("parquet", "csv")).count() == 6
    assert read_training(spark, root, ("parquet", "csv"), distinct=True).count() == 2
    os.makedirs(tmp_path / "none")
    with pytest.raises(ValueError):
        read_training(spark, str(tmp_path / "none"), ("parquet", "csv"))


def test_partitioned_sink_replaces_only_its_days(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(date(2024, 1, 1), 1), (date(2024, 1, 2), 2)]
    schema = "report_date date, x int"
    sinks.write_partitioned(spark.createDataFrame(rows, schema), path)
    for _ in range(2):
        sinks.write_partitioned(spark.createDataFrame([(date(2024, 1, 2), 3)], schema), path)
    assert sorted((r.report_date, r.x) for r in spark.read.parquet(path).collect()) == [
        (date(2024, 1, 1), 1), (date(2024, 1, 2), 3),
    ]


def test_copy_sink_and_catalog(spark, tmp_path):
    df = spark.createDataFrame([("H", "D")], "headline string, description string")
    sinks.write_copy(df, str(tmp_path), datetime(2024, 1, 2), {"product_info": "p"})
    row = spark.read.json(str(tmp_path / "generated_copy" / "latest")).first()
    assert row.headline == "H" and row.metadata.product_info == "p"
    df.createOrReplaceTempView("listed_view")
    listed = {r.table_name: r.table_type for r in sinks.list_tables(spark).collect()}
    assert listed["listed_view"] == "VIEW"


def test_views_drop_unmeasured_elements(spark, elements):
    df = elements([("2024-12-01", 6, "a", "x", None, 3, 1.0, 0), ("2024-12-01", 6, "a", "y", 0, 0, 0.0, 0)])
    rows = views.creative_performance(df).collect()
    assert [(r.creative_id, r.total_impressions, r.ctr_percent, r.avg_cpc) for r in rows] == [("y", 0, None, None)]


def test_latest_pull_keeps_the_last_of_the_day(spark, elements):
    df = elements([("2024-12-01", h, "a", "x", 100 * (h + 1), h, 1.0, 0) for h in (0, 6, 12, 18)]
                  + [("2024-12-01", 18, "a", "x", 1, 1, 1.0, 0)])
    row = views.latest_pull(df).first()
    assert (row.total_impressions, row.total_clicks) == (1901, 19)
    assert views.creative_performance(df).first().total_impressions == 100 * (1 + 7 + 13 + 19) + 1


def test_documents_are_shuffled_narrow_and_written_compressed(spark, tmp_path, elements):
    rows = [("2024-12-01", h, f"k{c % 3}", f"c{c}", 100 * c, c, 0.5 * c, 1) for c in range(40) for h in (6, 12)]
    docs = raw.raw_documents(elements(rows))
    plan = docs._jdf.queryExecution().executedPlan().toString()
    # The elements cross the network once, as they are: no list of nested elements does.
    assert plan.count("Exchange") == 1 and "collect_list" not in plan[plan.index("Exchange"):]
    raw.write_raw(docs, str(tmp_path / "raw"), compression="gzip")
    files = [f for _, _, names in os.walk(tmp_path / "raw") for f in names if f.startswith("part-")]
    assert files and all(f.endswith(".json.gz") for f in files)
    read = raw.read_raw(spark, str(tmp_path / "raw"), multi_line=False)
    columns = ["creative_id", "campaign_id", "pulled_ts", "report_date", "element_date", "impressions", "clicks", "cost", "conversions"]
    found = [tuple(r) for r in raw.explode_elements(read).select(*columns).collect()]
    whole = elements(rows).withColumn("element_date", F.col("report_date")).select(*columns).collect()
    assert read.count() == 6 and sorted(found) == sorted(map(tuple, whole))
