import json
from datetime import date, timedelta

from pyspark.sql import functions as F

from adperf.operators import aggregates, views
from adperf.operators.aggregates import daily_aggregates, weekly_summaries
from adperf.sources import raw, tables
from adperf.streaming import ingest, lifetime
from tests.conftest import SMALL
from tests.test_raw import document, element, put


def same(a, b):
    columns = sorted(a.columns)
    a, b = a.select(*columns), b.select(*columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def expected_tables(raw_path, spark, multi_line=True):
    docs = raw.read_raw(spark, raw_path, multi_line=multi_line).dropDuplicates(["campaign_id", "pulled_at", "part"])
    cp = views.creative_performance(raw.explode_elements(docs))
    return {"creative_performance": cp, "daily": daily_aggregates(cp), "weekly": weekly_summaries(cp)}


def check(store, raw_path, multi_line=True):
    for name, rows in expected_tables(raw_path, store.spark, multi_line).items():
        assert same(store.table(name).drop("period"), rows), name


def test_incremental_equals_full_recompute(spark, tmp_path):
    for unit in ("day", "month"):
        source, progress = str(tmp_path / unit / "raw"), str(tmp_path / unit / "progress")
        store = ingest.Store(spark, str(tmp_path / unit / "store"), unit)
        put(source, "2024-11-29", "a.json", document("2024-11-29T06:00:00", elements=[element(), element("c2")]))
        put(source, "2024-11-30", "a.json", document("2024-11-30T06:00:00", elements=[element(clicks=7)]))
        ingest.run_ingest(store, source, progress)
        check(store, source)
        # A new pull, the next month, a repeated delivery, and a pull that arrives late.
        put(source, "2024-12-01", "a.json", document("2024-12-01T06:00:00", elements=[element(clicks=9)]))
        put(source, "2024-12-01", "again.json", document("2024-11-30T06:00:00", elements=[element(clicks=7)]))
        put(source, "2024-12-01", "late.json", document("2024-11-01T06:00:00", elements=[element(clicks=2)]))
        ingest.run_ingest(store, source, progress)
        check(store, source)
        assert store.elements().count() == 5
        before = store.elements().count()
        ingest.run_ingest(store, source, progress)
        assert store.elements().count() == before


def test_streamed_windows_are_whole(spark, tmp_path):
    """Open windows are there, and rows that come days late, in a later batch, are counted."""
    from datetime import datetime

    from adperf.operators.metrics import event_rollup
    from adperf.streaming import rollup

    folder, out, progress = (str(tmp_path / name) for name in ("events", "out", "progress"))
    times = [datetime(2024, 12, 1, 3), datetime(2024, 12, 5, 13)], [datetime(2024, 12, 1, 4), datetime(2024, 12, 1, 20)], [datetime(2024, 12, 5, 14)]
    for batch in times:
        rows = [(i, ts, i, "click", 0.25, None) for i, ts in enumerate(batch)]
        spark.createDataFrame(rows, rollup.EVENTS).write.mode("append").parquet(folder)
        for _ in range(2):  # the second run finds nothing new
            windows = rollup.run_whole_rollup(rollup.stream_events(spark, folder, "*.parquet"), out, progress)
        whole = event_rollup(tables.pull_metrics_from(spark.read.schema(rollup.EVENTS).parquet(folder)), "6 hours")
        assert same(windows, whole)
    assert sorted(r.executions for r in windows.collect()) == [1, 2, 2]


def test_repeated_batch_leaves_the_same_table(spark, tmp_path):
    store = ingest.Store(spark, str(tmp_path / "store"))
    source = str(tmp_path / "raw")
    put(source, "2024-11-29", "a.json", document("2024-11-29T06:00:00", elements=[element(), element("c2")]))
    docs = raw.read_raw(spark, source)
    for batch in (0, 0, 1):
        ingest.refresh(store, ingest.append_batch(store, docs, batch))
    assert store.elements().count() == 2
    check(store, source)


def test_whole_table_through_the_stream(spark, tmp_path):
    source = str(tmp_path / "raw")
    raw.write_raw(raw.raw_documents(tables.ad_elements(spark, SMALL, date(2001, 6, 30), 60)), source)
    store = ingest.Store(spark, str(tmp_path / "store"), "month")
    ingest.run_ingest(store, source, str(tmp_path / "progress"), multi_line=False, files_per_batch=25)
    assert store.elements().select("batch_id").distinct().count() > 1
    check(store, source, multi_line=False)
    full = views.creative_performance(tables.ad_elements(spark, SMALL, date(2001, 6, 30), 60))
    assert same(store.table("creative_performance").drop("period"), full)


def test_redelivery_within_the_watermark(spark, tmp_path):
    source = str(tmp_path / "raw")
    put(source, "2024-11-29", "a.json", document("2024-11-29T06:00:00", elements=[element()]))
    put(source, "2024-11-29", "b.json", document("2024-11-29T06:00:00", elements=[element()]))
    put(source, "2024-11-29", "c.json", document("2024-11-29T12:00:00", elements=[element()]))
    out = str(tmp_path / "out")
    query = (
        ingest.without_redelivery(ingest.stream_raw(spark, source))
        .select("campaign_id", "pulled_at")
        .writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "progress"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sorted(r.pulled_at for r in spark.read.parquet(out).collect()) == ["2024-11-29T06:00:00", "2024-11-29T12:00:00"]


def test_malformed_documents_do_not_stop_the_stream(spark, tmp_path):
    source = str(tmp_path / "raw")
    put(source, "2024-11-29", "a.json", document("2024-11-29T06:00:00", elements=[element()]))
    put(source, "2024-11-29", "b.json", '{"pulled_at": ')
    put(source, "2024-11-29", "c.json", json.dumps(document("2024-11-29T07:00:00", analytics={})))
    store = ingest.Store(spark, str(tmp_path / "store"))
    ingest.run_ingest(store, source, str(tmp_path / "progress"))
    assert store.elements().agg(F.count("*")).first()[0] == 1


def test_checkpoints_sources_and_unreadable_times(spark, tmp_path):
    """A reset checkpoint and a second source lose nothing; a document without a readable time is kept and counted."""
    store = ingest.Store(spark, str(tmp_path / "store"))
    first, second = str(tmp_path / "first"), str(tmp_path / "second")
    put(first, "2024-11-29", "a.json", document("2024-11-29T06:00:00", elements=[element()]))
    ingest.run_ingest(store, first, str(tmp_path / "p1"))
    put(second, "2024-11-29", "a.json", document("2024-11-29T12:00:00", elements=[element(), element("c2")]))
    put(second, "2024-11-29", "b.json", document("no time", elements=[element("c3")]))
    ingest.run_ingest(store, second, str(tmp_path / "p2"))
    assert store.elements().count() == 4
    put(first, "2024-11-29", "c.json", document("nor here", elements=[element("c4")]))
    ingest.run_ingest(store, first, str(tmp_path / "p3"))  # a new checkpoint reads all of the first source again
    assert store.elements().count() == 5 and store.elements().filter("period IS NULL").count() == 2
    both = raw.read_raw(spark, first).unionByName(raw.read_raw(spark, second))
    assert same(store.table("creative_performance").drop("period"), views.creative_performance(raw.explode_elements(both)))


def test_daily_job_keeps_whole_weeks(spark):
    from adperf.operators.reports import last_days

    as_of = date(2024, 12, 1)
    first = as_of - timedelta(days=180)
    days = spark.range(400).selectExpr("date_sub(DATE'2024-12-01', cast(id as int)) AS report_date")
    kept = last_days(days, as_of, 180 + first.weekday()).agg(F.min("report_date")).first()[0]
    assert kept.weekday() == 0 and kept <= first


def test_nothing_delivered_is_lost(spark, tmp_path):
    """Two documents without a time are both kept; a corrected delivery replaces the first, in any order of batches; unreadable texts are counted."""
    store = ingest.Store(spark, str(tmp_path / "store"))
    docs = [
        (1, document("2024-11-29T06:00:00", elements=[element(impressions=10), element("gone")])),
        (2, document("2024-11-29T06:00:00", elements=[element(impressions=12), element("new")])),
        (1, document("n/a", elements=[element("a")])),
        (1, document("n/a", elements=[element("b")])),
        (1, document(None, campaign=None, elements=[element("c")])),
        (1, document("2024-11-30T06:00:00", elements=[element("only")])),
        (3, document("2024-11-30T06:00:00", elements=[])),
    ]

    def batch(*hours):
        lines = [(f"2024-12-01 0{h}:00:00", json.dumps(d)) for h, d in docs if h in hours]
        lines = spark.createDataFrame(lines, "delivered string, text string")
        parsed = lines.select(F.from_json("text", raw.RAW).alias("d"), F.col("delivered").cast("timestamp").alias("delivered"))
        return parsed.select("d.*", "delivered")

    for i, hours in enumerate([(2,), (1, 2), (1,), (3,), (1, 2)]):  # the correction comes first, then what it corrects
        ingest.refresh(store, ingest.append_batch(store, batch(*hours), i))
    current = {(r.creative_id, r.impressions) for r in store.current().collect()}
    assert current == {("c1", 12), ("new", 100), ("a", 100), ("b", 100), ("c", 100)}
    assert store.current().count() == 5
    performance = store.table("creative_performance")
    assert {(str(r.report_date), r.creative_id, r.total_impressions) for r in performance.collect()} == {
        ("2024-11-29", "c1", 12), ("2024-11-29", "new", 100), ("None", "a", 100), ("None", "b", 100), ("None", "c", 100)}
    assert performance.filter("period = DATE'2024-11-30'").isEmpty()  # its last element was corrected away
    assert same(lifetime.creatives(store), aggregates.creative_metadata(performance.drop("period")))
    assert same(lifetime.campaigns(store), views.campaign_totals(store.current()))


def test_rejects_are_kept_and_counted(spark, tmp_path):
    source = str(tmp_path / "raw")
    put(source, "2024-11-29", "a.json", document("2024-11-29T06:00:00", elements=[element()]))
    put(source, "2024-11-29", "b.json", '{"pulled_at": ')
    put(source, "2024-11-29", "c.json", document("2024-11-29T07:00:00", elements=[element(impressions="many")]))
    store = ingest.Store(spark, str(tmp_path / "store"))
    for progress in ("p1", "p2"):  # the second checkpoint delivers all of it again
        ingest.run_ingest(store, source, str(tmp_path / progress))
    assert sorted((r.reason, r.batches) for r in store.rejects().collect()) == [("mistyped", 1), ("unparsable", 1)]
    assert store.elements().count() == 1
    docs = raw.read_raw(spark, source, keep_corrupt=True)
    assert sorted(r.reason for r in raw.rejects(docs).collect()) == ["mistyped", "unparsable"] and raw.rejects(docs).count() == 2
    assert raw.read_raw(spark, source).count() == 1


def test_lifetimes_follow_corrections(spark, tmp_path, elements):
    """Batches in any order, months apart, with days named by several rows: folded states equal a full recompute."""
    for unit in ("day", "month"):
        store = ingest.Store(spark, str(tmp_path / unit), unit)
        days = [("2024-11-29", 1), ("2024-12-01", 2), ("2024-11-30", 3), ("2023-02-28", 4), ("2024-12-01", 5), ("2024-11-29", 6)]
        for i, (day, n) in enumerate(days):
            rows = [(day, n, f"k{n % 2}", f"c{c}", 100 * n, c + n, 0.25 * n, 1) for c in range(n)]
            ingest.refresh(store, ingest.append_batch(store, raw.raw_documents(elements(rows)), i))
        assert same(lifetime.creatives(store), aggregates.creative_metadata(store.table("creative_performance").drop("period")))
        assert same(lifetime.campaigns(store), views.campaign_totals(store.current()))
        # c0 of k0 has rows on 2023-02-28, 2024-11-29 and 2024-12-01.
        assert {r.days_active for r in lifetime.creatives(store).collect()} == {1, 2, 3}


def test_states_merge_in_any_order(spark, elements):
    rows = [(f"2024-11-{d:02d}", h, f"k{d % 2}", f"c{d % 3}", 10 * d, d, 0.25 * d, 1) for d in range(1, 31) for h in (3, 9)]
    parts = [elements(rows[i::4]) for i in range(4)]  # every day lies in several parts
    days = [lifetime.campaign_states(lifetime.campaign_days(p)) for p in parts]
    whole = lifetime.campaign_lifetimes(lifetime.campaign_states(lifetime.campaign_days(elements(rows))))
    for order in ((0, 1, 2, 3), (3, 1, 0, 2)):
        merged = days[order[0]]
        for i in order[1:]:
            merged = lifetime.merge(merged.unionByName(days[i]), lifetime.CAMPAIGN)
        assert same(lifetime.campaign_lifetimes(merged), whole)


def test_daily_job_from_the_store_equals_the_job_over_all_elements(spark, tmp_path, elements):
    from datetime import datetime

    from adperf.plans import jobs
    from adperf.sources.schema import CONTENT

    as_of, at = date(2024, 12, 1), datetime(2024, 12, 1, 8)
    rows = [
        (str(as_of - timedelta(days=d)), h, f"k{d % 2}", f"c{d % 5}", 200 + d, 20, 2.5, d % 3)
        for d in (0, 1, 3, 9, 29, 30, 31, 45, 95, 200) for h in (6, 12)
    ]
    every = elements(rows)
    store = ingest.Store(spark, str(tmp_path / "store"))
    ingest.refresh(store, ingest.append_batch(store, raw.raw_documents(every), 0))
    content = spark.createDataFrame([], "creative_id string, headline string, description string, cta string, combined_text string")
    metric = {}
    for name, run in (("whole", lambda root: jobs.run_processing(spark, every, content, root, as_of, at)), ("store", lambda root: jobs.run_daily(store, content, root, as_of, at))):
        metric[name] = sorted(map(str, run(str(tmp_path / name)).collect()))
    assert metric["whole"] == metric["store"]
    for table in ("aggregates/daily", "aggregates/weekly", "aggregates/creative_metadata/parquet", "training/bid_optimization/latest"):
        a, b = (spark.read.parquet(str(tmp_path / name / table)) for name in ("whole", "store"))
        assert same(a, b), table


def test_documents_that_come_once_are_not_shuffled(spark, tmp_path, elements):
    rows = [("2024-12-01", h, f"k{c % 3}", f"c{c}", 100 * c, c, 0.5 * c, 1) for c in range(12) for h in (6, 12)]
    docs = ingest.with_identity(raw.raw_documents(elements(rows)), "month")
    docs.write.parquet(str(tmp_path / "once"))
    once = spark.read.parquet(str(tmp_path / "once"))
    assert "Exchange" not in ingest.each_once(once)._jdf.queryExecution().executedPlan().toString()
    repeated = once.unionByName(once.filter("campaign_id = 'k1'"))
    kept = ingest.each_once(repeated)
    assert repeated.count() == 8 and kept.count() == 6
    assert sorted(r.digest for r in kept.collect()) == sorted(r.digest for r in once.collect())
    store = ingest.Store(spark, str(tmp_path / "store"), "month")
    ingest.refresh(store, ingest.append_batch(store, raw.raw_documents(elements(rows)), 0))
    # No version was replaced, so the elements are read as they are.
    assert "Join" not in store.current()._jdf.queryExecution().executedPlan().toString()
    assert store.current().count() == len(rows)


def test_staged_rows_are_bounded(spark, tmp_path):
    """No staged or stored row grows with a document or with a text that cannot be read, and texts come back whole, byte by byte."""
    from pyspark.sql import types as T

    def listed(dtype):
        if isinstance(dtype, T.StructType):
            return any(listed(f.dataType) for f in dtype.fields)
        return isinstance(dtype, (T.ArrayType, T.MapType))

    many = [element(f"c{i}", clicks=i) for i in range(5000)]
    cut = '{"pulled_at": "' + "aé€😀" * 20_000  # pieces end within characters
    mistyped = json.dumps(document("2024-11-30T06:00:00", elements=[*many, element(impressions="many")]))
    texts = [json.dumps(document("2024-11-29T06:00:00", elements=many)), json.dumps(document("2024-11-29T12:00:00", elements=[])), cut, mistyped]
    source = tmp_path / "raw"
    source.mkdir()
    bad = cut.encode() + b"\xff\xfe"  # no UTF-8
    (source / "a.json").write_bytes(b"\n".join([*(t.encode() for t in texts), *(t.encode() for t in texts), bad]))
    store = ingest.Store(spark, str(tmp_path / "store"), "month")
    ingest.run_ingest(store, str(source), str(tmp_path / "p1"), multi_line=False)
    ingest.run_ingest(store, str(source), str(tmp_path / "p2"), multi_line=False)  # the same batch once more
    staged = spark.read.parquet(store.path("staging"))
    assert not any(listed(f.dataType) for f in staged.schema.fields)
    assert staged.count() > 2 * len(many)
    for rows, text in ((staged, "reject.text"), (spark.read.parquet(store.path("rejects")), "text")):
        assert rows.agg(F.max(F.octet_length(text))).first()[0] <= ingest.PIECE
    assert store.elements().count() == len(many) and store.elements().agg(F.sum("clicks")).first()[0] == sum(range(5000))
    assert sorted((r.elements, r.has_analytics) for r in store.deliveries().collect()) == [(0, True), (5000, True)]
    found = store.rejects().select("reason", F.col("text").cast("binary").alias("text"), "batches").collect()
    expected = [("mistyped", mistyped.encode(), 1), ("unparsable", cut.encode(), 1), ("unparsable", bad, 1)]
    assert sorted((r.reason, bytes(r.text), r.batches) for r in found) == sorted(expected)


def test_undated_documents_that_repeat_are_left_out_by_number(spark, tmp_path):
    """Of documents without a readable time that come twice, in one batch and in the next, each element is kept once, without a shuffle."""
    docs = [document("n/a", elements=[element(f"c{i}", clicks=i) for i in range(3)]), document("2024-11-29T06:00:00", elements=[element()])]

    def batch(*numbers):
        lines = spark.createDataFrame([(json.dumps(docs[i]),) for i in numbers], "text string")
        return lines.select(F.from_json("text", raw.RAW).alias("d")).select("d.*")

    path = str(tmp_path / "rows")
    ingest.staged_rows(batch(0, 1, 0, 0), "month").write.parquet(path)
    rows = spark.read.parquet(path)
    heads = rows.filter("head IS NOT NULL").select("copy", "digest", "head.*")
    assert sorted(heads.select("elements", F.col("period").isNull()).collect()) == [(1, False), (3, True), (3, True), (3, True)]
    kept = ingest.each_once(rows, heads)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert sorted(r.creative_id for r in kept.collect()) == ["c0", "c1", "c1", "c2"]
    store = ingest.Store(spark, str(tmp_path / "store"), "month")
    for i, numbers in enumerate([(0, 1, 0, 0), (1, 0)]):
        ingest.refresh(store, ingest.append_batch(store, batch(*numbers), i))
    assert store.elements().count() == 4 and store.current().filter("period IS NULL").agg(F.sum("clicks")).first()[0] == 3
