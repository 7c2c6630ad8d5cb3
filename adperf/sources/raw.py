"""Reading and writing the raw pull documents."""

from __future__ import annotations

import re
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.dates import instant, iso_text
from ..functions.text import combined_text
from .schema import CONTENT, CREATIVE_DOCUMENT, RAW, TARGETING

PATH_DATE = r"/(\d{4})/(\d{1,2})/(\d{1,2})/[^/]+$"
HIVE_DATE = r"/year=(\d{4})/month=(\d{1,2})/day=(\d{1,2})/[^/]+$"


CORRUPT = "_corrupt"
RAW_OR_CORRUPT = T.StructType(RAW.fields + [T.StructField(CORRUPT, T.StringType(), True)])


def reject_reason(text: str) -> Column:
    """Why a text is no raw document: ``unparsable`` where it is no JSON, ``mistyped`` where a field has another type."""
    return F.when(F.try_parse_json(text).isNull(), F.lit("unparsable")).otherwise(F.lit("mistyped"))


def _swap_case_twins(dtype: T.DataType, lower: bool) -> T.DataType:
    """The type with all field names in lower case (``lower``) or as declared."""
    if isinstance(dtype, T.StructType):
        return T.StructType(
            [
                T.StructField(f.name.lower() if lower else f.name, _swap_case_twins(f.dataType, lower), True)
                for f in dtype.fields
            ]
        )
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_swap_case_twins(dtype.elementType, lower), True)
    return dtype


def read_raw(
    spark: SparkSession, path, *, multi_line: bool = True, keep_corrupt: bool = False, any_case: bool = False
) -> DataFrame:
    """Raw documents below ``path``; malformed documents are skipped.

    ``multi_line`` reads one pretty-printed document per file, otherwise one document per line.
    ``keep_corrupt`` keeps rejects, with their text in ``_corrupt``, so that they can be counted (see ``rejects``).
    ``any_case`` accepts field names in any letter case; it changes nothing else: the same documents stay and go.
    """
    if any_case:
        docs = _read_any_case(spark, path, multi_line)
    else:
        reader = spark.read.schema(RAW_OR_CORRUPT).option("multiLine", multi_line).option("recursiveFileLookup", True)
        docs = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path)
        # Only fields that are read can show a document to be malformed, so all of them are: whichever columns a query needs,
        # the same documents stay and go.
        beside = F.left(F.xxhash64(*RAW.names).cast("string"), F.lit(0))
        docs = docs.withColumn(CORRUPT, F.concat(CORRUPT, beside))
    if keep_corrupt:
        return docs
    return docs.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def _read_any_case(spark: SparkSession, path, multi_line: bool) -> DataFrame:
    """Lower-cases the keys in the text before parsing with the lower-case twin of the schema."""
    text = spark.read.option("recursiveFileLookup", True).text(path, wholetext=multi_line)
    text = text.filter(F.trim("value") != "")  # a blank line is no document, as for the JSON reader
    twin = _swap_case_twins(RAW, lower=True)
    twin = T.StructType(twin.fields + [T.StructField(CORRUPT, T.StringType(), True)])
    parsed = F.from_json(lower_keys(F.col("value")), twin, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    doc = text.select("value", parsed.cast(RAW_OR_CORRUPT).alias("doc"))
    corrupt = F.when(F.col(f"doc.{CORRUPT}").isNotNull(), F.col("value")).alias(CORRUPT)
    return doc.select(*(F.col("doc")[name].alias(name) for name in RAW.names), corrupt)


def rejects(docs: DataFrame) -> DataFrame:
    """Text and reason of the rejects of ``read_raw(..., keep_corrupt=True)``."""
    bad = docs.filter(F.col(CORRUPT).isNotNull())
    return bad.select(F.col(CORRUPT).alias("text"), reject_reason(CORRUPT).alias("reason"))


def lower_keys(json_text: Column) -> Column:
    """JSON text with its keys in lower case; string values are left alone.

    The text is cut into string tokens and the text between them, and a string followed by a
    colon is a key.
    """
    token = r'(?s)"(?:[^"\\]|\\.)*+"\s*:?|[^"]+'
    tokens = F.regexp_extract_all(json_text, F.lit(token), F.lit(0))
    lowered = F.transform(tokens, lambda t: F.when(t.rlike(r'(?s)^".*:$'), F.lower(t)).otherwise(t))
    return F.array_join(lowered, "")


def read_creative_documents(spark: SparkSession, path) -> DataFrame:
    """The older document shape, one row per creative."""
    docs = (
        spark.read.schema(CREATIVE_DOCUMENT)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("mode", "DROPMALFORMED")
        .json(path)
    )
    rows = docs.select(
        "pulled_at", "campaign_id", "campaign_name", "ad_account_id", F.explode("creatives").alias("creative")
    )
    return rows.select(
        F.to_date(instant("pulled_at")).alias("report_date"),
        instant("pulled_at").alias("pulled_ts"),
        "campaign_id",
        "campaign_name",
        "ad_account_id",
        "creative.creative_id",
        "creative.creative_name",
        F.col("creative.status").alias("creative_status"),
        "creative.metrics.*",
        "creative.targeting",
        "creative.creative_content",
    )


def path_date(path_column="_metadata.file_path") -> Column:
    """The date in ``.../YYYY/MM/DD/file`` or ``.../year=/month=/day=/file``; NULL if there is none."""
    path = F.col(path_column) if isinstance(path_column, str) else path_column

    def dated(pattern: str) -> Column:
        y, m, d = (F.regexp_extract(path, pattern, i) for i in (1, 2, 3))
        return F.when(path.rlike(pattern), F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0"))).try_cast("date")

    return F.coalesce(dated(PATH_DATE), dated(HIVE_DATE))


def recent_files(df: DataFrame, as_of: date, days: int = 60) -> DataFrame:
    """Rows of files at most ``days`` old by their path; files without a date in the path stay.

    The predicate reads file metadata only, so Spark drops old files before opening them.
    """
    d = path_date()
    return df.filter((F.datediff(F.lit(as_of), d) <= days) | d.isNull())


def _folder_date(names: list[str]) -> date | None:
    """The date the last three folder names form, as ``path_date`` reads it."""
    place = "/" + "/".join(names) + "/file"
    found = re.search(PATH_DATE, place) or re.search(HIVE_DATE, place)
    try:
        return found and date(*map(int, found.groups()))
    except ValueError:
        return None


def recent_paths(spark: SparkSession, path: str, as_of: date, days: int = 60) -> list[str]:
    """What below ``path`` may hold files at most ``days`` old: day folders of the window, and files and folders without a date.

    The names of folders are listed, at most 13 listings a year of dated folders, but never the files of a day folder:
    the reader lists those of the days returned, in parallel. All that lies below a day's folder has that day. What
    ``recent_files`` keeps is here; it may keep less.
    """
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    oldest = as_of - timedelta(days=days)
    wanted, todo = [], [(root, [])]
    while todo:
        folder, names = todo.pop()
        files, below = [], []
        for entry in fs.listStatus(folder):
            name = entry.getPath().getName()
            if name.startswith(".") or (name.startswith("_") and "=" not in name):
                continue  # no data: the reader leaves these out as well
            (below if entry.isDirectory() else files).append((entry.getPath(), [*names[-2:], name]))
        if not below and files:
            wanted.append(folder.toString())
            continue
        wanted += [place.toString() for place, _ in files]
        for place, its_names in below:
            day = _folder_date(its_names)
            if day is None:
                todo.append((place, its_names))
            elif day >= oldest:
                wanted.append(place.toString())
    return sorted(wanted)


def read_recent(spark: SparkSession, path: str, as_of: date, days: int = 60, **options) -> DataFrame:
    """``recent_files`` of ``read_raw`` without listing the files of older days."""
    paths = recent_paths(spark, path, as_of, days)
    if not paths:
        return spark.createDataFrame([], RAW_OR_CORRUPT if options.get("keep_corrupt") else RAW)
    return recent_files(read_raw(spark, paths, **options), as_of, days)


def only_campaigns(df: DataFrame, campaign_ids: str) -> DataFrame:
    """Keeps the campaigns of a comma-separated list; blanks are ignored, an empty list keeps none."""
    ids = [part.strip() for part in campaign_ids.split(",") if part.strip()]
    return df.filter(F.col("campaign_id").isin(ids))


def skip_low_ctr(elements: DataFrame, min_ctr: float = 0.5) -> DataFrame:
    """Drops elements with a CTR below ``min_ctr`` percent; absent clicks count as 0, impressions as 1."""
    clicks = F.coalesce(F.col("clicks"), F.lit(0))
    shown = F.nullif(F.coalesce(F.col("impressions"), F.lit(1)).cast("double"), F.lit(0.0))
    ctr = clicks / shown * F.lit(100.0)
    return elements.filter(F.coalesce(ctr >= F.lit(min_ctr), F.lit(False)))


def element_day(which: str) -> Column:
    """A day of the element's own date range."""
    d = F.col(f"elem.dateRange.{which}")
    return F.try_to_date(F.concat_ws("-", d["year"], d["month"], d["day"]), "y-M-d")


def explode_elements(raw: DataFrame, *kept: str, numbered: bool = False) -> DataFrame:
    """One row per element of every document, with the document's columns ``kept``; documents without elements give no rows.

    With ``numbered`` rows have their ``place`` in the document, and a document without elements gives one row without a place.
    """
    config = "campaign_config"
    part = F.col("part") if "part" in raw.columns else F.lit(None).cast("int").alias("part")
    found = "analytics.elements"
    elem = F.posexplode_outer(found).alias("place", "elem") if numbered else F.explode(found).alias("elem")
    rows = raw.select("pulled_at", "campaign_id", config, part, *kept, elem)
    pulled = instant("pulled_at")
    return rows.select(
        F.to_date(pulled).alias("report_date"),
        pulled.alias("pulled_ts"),
        "campaign_id",
        F.col(f"{config}.name").alias("campaign_name"),
        F.col(f"{config}.status").alias("campaign_status"),
        F.col(f"{config}.dailyBudget.amount").alias("daily_budget"),
        F.col(f"{config}.unitCost.amount").alias("unit_cost"),
        F.col("elem.pivotValue").alias("creative_id"),
        F.col("elem.impressions").alias("impressions"),
        F.col("elem.clicks").alias("clicks"),
        F.col("elem.costInUsd").alias("cost"),
        F.col("elem.externalWebsiteConversions").alias("conversions"),
        F.col("elem.approximateUniqueImpressions").alias("unique_impressions"),
        element_day("start").alias("element_date"),
        F.col("elem.creativeContent").alias("content"),
        "part",
        "pulled_at",
        *kept,
        *["place"] * numbered,
    )


def raw_documents(elements: DataFrame, pieces: int = 1) -> DataFrame:
    """Elements back into one document per (campaign, pull).

    With ``pieces`` above 1 every pull, whatever its size, is split into that many documents by a hash of the creative id;
    ``part`` numbers them. It depends on the element alone, so another partitioning or a later run gives the same
    pieces, and exploding them gives the same elements as one document. Choose it so that the largest pull's share fits
    one task; every count of pulls goes by (campaign, pull).
    """
    keys = ["pulled_ts", "campaign_id", "campaign_name", "campaign_status", "daily_budget", "unit_cost"]
    part = F.pmod(F.xxhash64("creative_id"), F.lit(pieces)).cast("int") if pieces > 1 else F.lit(None).cast("int")
    measures = ["report_date", "impressions", "clicks", "cost", "conversions", "unique_impressions"]
    content = ["content"] if "content" in elements.columns else []
    element = F.struct("creative_id", *measures, *content).alias("element")
    # Elements cross the network once and narrow; each task then groups its own share, not the whole span of keys. Their copies of a
    # pull's columns compress so well that shares joined by their shuffled bytes would not fit a task's sort buffer.
    parts = int(elements.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = elements.select(*keys, part.alias("part"), element).repartition(parts, "pulled_ts", "campaign_id", *["part"] * (pieces > 1))
    gathered = dealt.groupBy(*keys, "part").agg(F.collect_list("element").alias("elements"))

    def document(e: Column) -> Column:
        day = F.struct(
            F.dayofmonth(e["report_date"]).alias("day"),
            F.month(e["report_date"]).alias("month"),
            F.year(e["report_date"]).alias("year"),
        )
        return F.struct(
            e["creative_id"].alias("pivotValue"),
            F.struct(day.alias("start"), day.alias("end")).alias("dateRange"),
            e["impressions"].alias("impressions"),
            e["clicks"].alias("clicks"),
            e["cost"].alias("costInUsd"),
            e["conversions"].alias("externalWebsiteConversions"),
            e["unique_impressions"].alias("approximateUniqueImpressions"),
            (e["content"] if content else F.lit(None).cast(CONTENT)).alias("creativeContent"),
        )

    grouped = gathered.withColumn("elements", F.transform("elements", document))
    usd = F.lit("USD").alias("currencyCode")
    return grouped.select(
        iso_text("pulled_ts").alias("pulled_at"),
        "campaign_id",
        F.struct(
            iso_text(F.col("pulled_ts") - F.expr("INTERVAL 1 DAY")).alias("start"), iso_text("pulled_ts").alias("end")
        ).alias("date_range"),
        F.struct("elements").alias("analytics"),
        F.struct(
            F.col("campaign_id").alias("id"),
            F.col("campaign_name").alias("name"),
            F.col("campaign_status").alias("status"),
            F.struct(F.col("daily_budget").alias("amount"), usd).alias("dailyBudget"),
            F.struct(F.col("unit_cost").alias("amount"), usd).alias("unitCost"),
            F.lit(None).cast(TARGETING).alias("targeting"),
        ).alias("campaign_config"),
        "part",
    )


def write_raw(documents: DataFrame, path: str, mode: str = "append", compression: str = "none") -> None:
    """One document per line below ``year=/month=/day=``; halves that are missing become ``{}``.

    The rebalance lets Spark split days that are large and merge days that are small. Most of a document is field names: with
    ``compression`` (``gzip``) files are many times smaller. One such file is read by one task, and the rebalance bounds its size.
    """
    pulled = instant("pulled_at")
    halves = documents.withColumns(
        {
            half: F.coalesce(half, F.from_json(F.lit("{}"), documents.schema[half].dataType))
            for half in ("analytics", "campaign_config")
        }
    )
    dated = halves.withColumns(
        {
            "year": F.year(pulled),
            "month": F.lpad(F.month(pulled).cast("string"), 2, "0"),
            "day": F.lpad(F.dayofmonth(pulled).cast("string"), 2, "0"),
        }
    )
    dated.hint("rebalance", "year", "month", "day").write.mode(mode).partitionBy("year", "month", "day").json(path, compression=compression)


def first_content(raw: DataFrame) -> DataFrame:
    """The content a creative had in the first file, by path, that carries any."""
    rows = raw.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.posexplode("analytics.elements").alias("position", "elem"),
    ).select(
        F.coalesce("elem.pivotValue", F.lit("")).alias("creative_id"),
        F.struct("file_path", "position").alias("place"),
        F.col("elem.creativeContent").alias("content"),
    )
    return pick_first_content(rows)


def pick_first_content(rows: DataFrame) -> DataFrame:
    """``creative_id, place, content`` rows to one content row per creative, smallest place first."""
    first = (
        rows.filter(F.col("content").isNotNull())
        .groupBy("creative_id")
        .agg(F.min_by("content", "place").alias("content"))
    )
    empty = F.lit("")
    return first.select(
        "creative_id",
        F.coalesce("content.headline", empty).alias("headline"),
        F.coalesce("content.description", empty).alias("description"),
        F.coalesce("content.cta", empty).alias("cta"),
        combined_text("content.headline", "content.description").alias("combined_text"),
    )
