"""Incremental ingest of raw documents and refresh of the stored aggregates."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.dates import instant, week_start
from ..operators.aggregates import daily_aggregates, weekly_summaries
from ..operators.views import creative_performance, measured
from ..settings import shared_dir
from ..sources.raw import CORRUPT, RAW_OR_CORRUPT, explode_elements, reject_reason
from ..sources.schema import ELEMENT_COLUMNS, RAW
from ..sources.sinks import period_of, with_period, write_partitioned
from . import lifetime

ELEMENTS_SCHEMA = (
    "report_date date, pulled_ts timestamp, campaign_id string, campaign_name string, campaign_status string, "
    "daily_budget double, unit_cost double, creative_id string, impressions bigint, clicks bigint, cost double, "
    "conversions bigint, unique_impressions bigint, element_date date, "
    "content struct<headline: string, description: string, cta: string>, part int, pulled_at string, digest string, "
    "period date, batch_id bigint"
)
DELIVERIES_SCHEMA = (
    "pull string, digest string, delivered timestamp, origin string, campaign_id string, pulled_at string, part int, "
    "run_at string, elements int, has_analytics boolean, has_config boolean, period date, batch_id bigint"
)
REJECTS_SCHEMA = "digest string, reason string, piece int, text string, origin string, delivered timestamp, batch_id bigint"

# Bytes of an unreadable text that one stored row has at most.
PIECE = 16384


class Store:
    """The element table and the tables derived from it, partitioned by day or by month."""

    def __init__(self, spark: SparkSession, root: str, unit: str = "day"):
        self.spark, self.root, self.unit = spark, root.rstrip("/"), unit

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def exists(self, table: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(table))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def _read(self, table: str, schema: str) -> DataFrame:
        if not self.exists(table):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path(table))

    def elements(self) -> DataFrame:
        """The elements of every version of every pull, each version's once."""
        return self._read("elements", ELEMENTS_SCHEMA)

    def deliveries(self) -> DataFrame:
        """One row for each document of each batch, its content's digest and the pull it is a version of included."""
        return self._read("deliveries", DELIVERIES_SCHEMA)

    def rejects(self) -> DataFrame:
        """Texts that could not be read, each once: reason, first delivery, and in how many batches it came."""
        pieces = self._read("rejects", REJECTS_SCHEMA).groupBy("digest", "reason", "batch_id")
        ordered = F.transform(F.array_sort(F.collect_list(F.struct("piece", "text"))), lambda p: p["text"])
        sent = [F.min("delivered").alias("delivered"), F.min("origin").alias("origin")]
        rows = pieces.agg(*sent, F.array_join(ordered, "").alias("text"))
        return rows.groupBy("digest", "reason", "text").agg(*sent, F.count("*").alias("batches"))

    def pulls(self, periods: list[date | None] | None = None) -> DataFrame:
        """The version that holds of every pull, or of every pull of ``periods``: the one delivered last, of two at one time the
        larger digest."""
        rows = self.deliveries() if periods is None else self.deliveries().filter(one_of("period", periods))
        once = rows.groupBy("period", "pull", "digest").agg(F.max("delivered").alias("delivered"), F.min("batch_id").alias("batch_id"))
        return once.groupBy("period", "pull").agg(F.max_by("digest", F.struct("delivered", "digest")).alias("digest"), F.count("*").alias("versions"))

    def current(self, periods: list[date | None] | None = None) -> DataFrame:
        """The elements of the versions that hold. Versions that a later delivery replaced are taken out by their digests:
        few, and none in most periods, so the elements are not shuffled for it. The digests are found when this is called."""
        rows, sent = self.elements(), self.deliveries()
        if periods is not None:
            rows, sent = rows.filter(one_of("period", periods)), sent.filter(one_of("period", periods))
        holds = self.pulls(periods).filter("versions > 1").select("pull", F.col("digest").alias("holds"))
        return without(rows, noted(sent.join(holds, "pull").filter("digest <> holds").select("digest").distinct()))

    def periods_of_months(self, months: list[date]) -> list[date]:
        """The periods that some months hold: themselves or their days."""
        if self.unit == "month":
            return months
        last = [(m + timedelta(days=32)).replace(day=1) for m in months]
        return [m + timedelta(days=i) for m, end in zip(months, last) for i in range((end - m).days)]

    def drop_periods(self, table: str, periods: list[date | None]) -> None:
        """Removes partitions that have no rows any more."""
        for p in periods:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path(table)}/period={p or '__HIVE_DEFAULT_PARTITION__'}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def after(self, period: date) -> date:
        """The first day after the period."""
        if self.unit == "day":
            return period + timedelta(days=1)
        return (period + timedelta(days=32)).replace(day=1)


def one_of(column: str, days: list[date | None]) -> Column:
    """``column IN (days)`` as one expression, which prunes partitions; None stands for NULL."""
    named = ", ".join(f"DATE '{d}'" for d in days if d is not None)
    tests = [f"{column} IN ({named})"] * bool(named) + [f"{column} IS NULL"] * (None in days)
    return F.expr(" OR ".join(tests) or "false")


def noted(digests: DataFrame) -> DataFrame | None:
    """Distinct digests, or numbers of documents, written once; None if there are none. What joins them with documents or elements knows
    their size before it starts, so the larger side is shuffled only where they are too many to be sent to every task."""
    path = shared_dir(digests.sparkSession, "digests")
    digests.write.parquet(path)
    kept = digests.sparkSession.read.schema(digests.schema).parquet(path)
    return None if kept.isEmpty() else kept


def without(rows: DataFrame, digests: DataFrame | None) -> DataFrame:
    return rows if digests is None else rows.join(digests, digests.columns, "left_anti")


def each_once(documents: DataFrame, heads: DataFrame | None = None) -> DataFrame:
    """One document of each digest; only documents that come more than once are compared as a whole.

    Documents of several rows each, numbered by ``copy``, need their ``heads``, one row (``digest``, ``copy``) per document: the
    document of the smallest number stays, and no more than heads are compared.
    """
    if heads is not None:
        first = heads.groupBy("digest").agg(F.min("copy").alias("first"), F.count("*").alias("n")).filter("n > 1")
        return without(documents, noted(heads.join(first, "digest").filter("copy <> first").select("copy")))
    again = noted(documents.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select("digest"))
    if again is None:
        return documents
    return without(documents, again).unionByName(documents.join(again, "digest", "left_semi").dropDuplicates(["digest"]))


def stream_raw(spark: SparkSession, path: str, multi_line: bool = True, files_per_batch: int | None = None) -> DataFrame:
    """New raw documents below ``path`` as a stream, with the file each came in (``origin``) and that file's time (``delivered``).

    A text that is no such document comes with its text in ``_corrupt``.
    """
    reader = (
        spark.readStream.schema(RAW_OR_CORRUPT)
        .option("multiLine", multi_line)
        .option("recursiveFileLookup", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    file = F.col("_metadata")
    return reader.json(path).select(
        "*", file["file_path"].alias("origin"), file["file_modification_time"].alias("delivered")
    )


def without_redelivery(raw_stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """Drops documents delivered again within ``delay``; state is bounded by the watermark.

    For metric streams. It also drops documents later than the watermark, so the element table
    (see ``append_batch``) recognises repeats by what it has stored instead.
    """
    if CORRUPT in raw_stream.columns:
        raw_stream = raw_stream.filter(F.col(CORRUPT).isNull())
    timed = raw_stream.withColumn("pulled_ts", instant("pulled_at")).withWatermark("pulled_ts", delay)
    return timed.dropDuplicatesWithinWatermark(["campaign_id", "pulled_at", "part"])


def touched_periods(rows: DataFrame) -> list[date | None]:
    """Periods of staged rows, None for unreadable times; at most one value per calendar day reaches the driver."""
    found = [r[0] for r in rows.select("period").distinct().collect()]
    return sorted(p for p in found if p is not None) + [None] * (None in found)


def with_identity(documents: DataFrame, unit: str) -> DataFrame:
    """Documents with ``digest`` (of their content), ``pull`` (what they are a version of) and ``period``.

    Documents of one campaign, time and part are versions of one pull. Without a readable time or a campaign nothing says
    that two documents belong together, so each content is a pull of its own. ``origin``, ``delivered`` and
    ``_corrupt`` are NULL where the source has none.
    """
    extra = {"origin": "string", "delivered": "timestamp", CORRUPT: "string"}
    rows = documents.withColumns({c: F.lit(None).cast(t) for c, t in extra.items() if c not in documents.columns})
    rows = rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in RAW if f.name not in rows.columns})
    content = F.when(F.col(CORRUPT).isNull(), F.to_json(F.struct(*RAW.names))).otherwise(F.col(CORRUPT))
    pulled = instant("pulled_at")
    named = F.concat_ws("\x1f", "campaign_id", pulled.cast("string"), F.coalesce(F.col("part").cast("string"), F.lit("-")))
    rows = rows.select(*RAW.names, CORRUPT, "origin", "delivered", F.sha2(content.cast("binary"), 256).alias("digest"))
    known = F.col("campaign_id").isNotNull() & pulled.isNotNull()
    return rows.withColumns({"pull": F.when(known, named).otherwise(F.col("digest")), "period": period_of(F.to_date(pulled), unit)})


def staged_rows(documents: DataFrame, unit: str) -> DataFrame:
    """Documents as rows of bounded size, whatever a document's: a row per element, per piece of an unreadable text, or for all of a
    document without elements.

    A reader of nested columns holds thousands of rows at once, so whole documents would need memory by their size. ``copy`` numbers the
    documents, ``head`` describes one in its first row, ``reject`` is a piece of a text that could not be read, and
    ``place`` that of an element. The other columns are the element's.
    """
    docs = with_identity(documents, unit).withColumn("copy", F.monotonically_increasing_id())
    bad = F.col(CORRUPT).isNotNull()

    def cut(text: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.octet_length(text) - 1, F.lit(0)), F.lit(PIECE))
        return F.transform(starts, lambda i: F.substring(text, i + 1, F.lit(PIECE)))

    # The text is bound once, as an array of one, since a cast of its own for each piece would copy all of it. Pieces are cut
    # by bytes, so that joining them gives any text back as it was.
    pieces = F.flatten(F.transform(F.array(F.col(CORRUPT).cast("binary")), cut))
    head = F.struct(
        bad.alias("rejected"), "pull", "campaign_id", "pulled_at", "part", F.col("date_range.end").alias("run_at"),
        F.coalesce(F.size("analytics.elements"), F.lit(0)).alias("elements"),
        F.col("analytics.elements").isNotNull().alias("has_analytics"), F.col("campaign_config.id").isNotNull().alias("has_config"),
        "period", "origin", "delivered",
    )
    # Before the rows are made, so that a document is described and its text looked into once, not once a row.
    docs = docs.select(
        "copy", "digest", "pulled_at", "campaign_id", "campaign_config", "part", "origin", "delivered", head.alias("head"),
        F.when(~bad, F.col("analytics")).alias("analytics"), F.when(bad, reject_reason(CORRUPT)).alias("reason"),
        F.when(bad, pieces).alias("pieces"),
    )
    docs = docs.select("*", F.posexplode_outer("pieces").alias("piece", "text")).drop("pieces")
    reject = F.struct("reason", "piece", F.col("text").cast("string").alias("text"), "origin", "delivered")
    docs = docs.withColumn("reject", F.when(F.col("reason").isNotNull(), reject))
    rows = explode_elements(docs, "copy", "digest", "head", "reject", numbered=True)
    first = (F.coalesce("place", F.lit(0)) == 0) & (F.coalesce("reject.piece", F.lit(0)) == 0)
    return rows.withColumn("head", F.when(first, F.col("head")))


def _write_batch(rows: DataFrame, path: str, key: int, *partitions: str) -> None:
    """Replaces the batch's own partitions."""
    rows = rows.withColumn("batch_id", F.lit(key).cast("bigint"))
    out = rows.hint("rebalance", *partitions) if partitions else rows
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partitions, "batch_id").parquet(path)


def append_batch(store: Store, documents: DataFrame, batch_id: int) -> list[date | None]:
    """Adds the batch's documents; returns the periods it touches.

    A document is known by its content. One that came before is noted as delivered again and its elements are not stored a second
    time; another content for the same campaign, time and part is a new version of the pull, and the version delivered last
    holds, whatever the order of the batches. Texts that cannot be read go to the table of rejects.

    The batch is parsed once into a staging table of its own name. Its rows go to partitions named by a hash over its
    documents, not by ``batch_id``: a batch that is run again replaces its own partitions, and neither a new
    checkpoint nor a second source, whose numbers start again, can replace those of another batch. It compares with the
    elements of other batches only. A document whose time cannot be read is kept, with the NULL period as its partition. One batch is
    added at a time.
    """
    parsed = staged_rows(documents, store.unit)
    staging = f"{store.path('staging')}/batch={batch_id}"
    parsed.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(staging)
    staged = store.spark.read.schema(parsed.schema).parquet(staging)
    heads = staged.filter("head IS NOT NULL").select("copy", "digest", "head.*")
    key = heads.select("digest").distinct().agg(F.bit_xor(F.xxhash64("digest"))).first()[0]
    if key is None:
        return []
    bad = staged.filter("reject IS NOT NULL").select("copy", "digest", "reject.*")
    _write_batch(each_once(bad, heads.filter("rejected")).drop("copy"), store.path("rejects"), key)
    good = heads.filter("NOT rejected")
    periods = touched_periods(good)
    if not periods:
        return []
    last = good.groupBy("digest").agg(F.max("delivered").alias("delivered"), F.min("origin").alias("origin"))
    described = good.drop("copy", "rejected", "origin", "delivered").dropDuplicates(["digest"])  # equal digests are equal documents
    sent = described.join(last, "digest").select("pull", "digest", "delivered", "origin", *described.columns[2:])
    columns = [*ELEMENT_COLUMNS, "element_date", "content", "part", "pulled_at", "digest"]
    rows = staged.filter("place IS NOT NULL").select("copy", *columns)
    if store.exists("elements"):
        others = store.elements().filter(one_of("period", periods) & (F.col("batch_id") != key)).select("digest").distinct()
        stored = noted(good.select("copy", "digest").join(others, "digest", "left_semi").select("copy"))
        rows, good = without(rows, stored), without(good, stored)
    rows = with_period(each_once(rows, good), "report_date", store.unit)
    _write_batch(rows.select(*columns, "period"), store.path("elements"), key, "period")
    # Last, so that a version holds only once its elements are stored.
    _write_batch(sent, store.path("deliveries"), key, "period")
    return periods


def _replace(store: Store, rows: DataFrame, table: str, periods: list[date | None], left: list[date | None]) -> None:
    """Replaces the partitions ``periods`` of a table by ``rows``, of which ``left`` have some."""
    write_partitioned(rows, store.path(table), "period")
    store.drop_periods(table, [p for p in periods if p not in left])


def refresh(store: Store, periods: list[date | None]) -> None:
    """Recomputes the daily views of ``periods``, the weeks they reach into and the lifetime state; replaces only those.

    Only the partitions of these periods are read from the element table; weeks are built from the
    stored daily view. A period whose last element a correction took away loses its rows.
    """
    if not periods:
        return
    days = store.current(periods)
    left = touched_periods(measured(days))
    performance = with_period(creative_performance(days), "report_date", store.unit)
    _replace(store, performance, "creative_performance", periods, left)
    daily = store.table("creative_performance")
    touched = daily_aggregates(daily.filter(one_of("period", periods)))
    _replace(store, with_period(touched, "report_date", store.unit), "daily", periods, left)
    weeks, weekly_periods = _weeks(store, daily, periods)
    _replace(store, weeks, "weekly", weekly_periods, touched_periods(weeks))
    lifetime.refresh(store, days, periods, left)


def _weeks(store: Store, daily: DataFrame, periods: list[date | None]) -> tuple[DataFrame, list[date | None]]:
    """Whole weekly partitions for every week that has a day in ``periods``, and their names; days without a date are one NULL week."""
    undated = [None] * (None in periods)
    periods = [p for p in periods if p is not None]

    def start_of(day: date) -> date:
        return day if store.unit == "day" else day.replace(day=1)

    def monday(day: date) -> date:
        return day - timedelta(days=day.weekday())

    mondays = set()
    for p in periods:
        m = monday(p)
        while m < store.after(p):
            mondays.add(m)
            m += timedelta(days=7)
    weekly_periods = sorted({start_of(m) for m in mondays})
    # A weekly partition holds all weeks starting in it, so it needs the days up to six after its end.
    needed = set()
    for p in weekly_periods:
        end = store.after(p) + timedelta(days=6)
        day = p
        while day < end:
            needed.add(start_of(day))
            day += timedelta(days=1)
    rows = daily.filter(one_of("period", sorted(needed) + undated))
    in_week = one_of("week_period", weekly_periods + undated)
    rows = rows.withColumn("week_period", period_of(week_start("report_date"), store.unit)).filter(in_week)
    return with_period(weekly_summaries(rows), "week_start", store.unit), weekly_periods + undated


def run_ingest(
    store: Store, raw_path: str, checkpoint: str, multi_line: bool = True, files_per_batch: int | None = None
) -> None:
    """Processes the documents that arrived since the last run, then stops."""

    def process(batch: DataFrame, batch_id: int) -> None:
        refresh(store, append_batch(store, batch, batch_id))

    query = (
        stream_raw(store.spark, raw_path, multi_line, files_per_batch)
        .writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
