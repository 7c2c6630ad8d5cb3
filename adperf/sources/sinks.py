"""Output tables: training sets, aggregates, action log, generated copy."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def write_training_set(df: DataFrame, root: str, dataset: str, at: datetime) -> dict[str, str]:
    """Parquet and CSV below a run stamp, and a ``latest`` copy of the Parquet that replaces the old one."""
    stamp = at.strftime("%Y%m%d_%H%M%S")
    base = f"{root}/training/{dataset}"
    paths = {
        "parquet": f"{base}/parquet/run_ts={stamp}",
        "csv": f"{base}/csv/run_ts={stamp}",
        "latest": f"{base}/latest",
    }
    df.write.mode("overwrite").parquet(paths["parquet"])
    # The set is computed once; the other two copies are read from the first.
    written = df.sparkSession.read.schema(df.schema).parquet(paths["parquet"])
    # Quotes are doubled, so that texts with quotes, commas and line breaks come back whole.
    written.write.mode("overwrite").option("header", True).option("escape", '"').csv(paths["csv"])
    written.write.mode("overwrite").parquet(paths["latest"])
    return paths


def period_of(day, unit: str) -> Column:
    """The partition a day belongs to: the day itself or the first day of its month."""
    day = F.col(day) if isinstance(day, str) else day
    return day if unit == "day" else F.trunc(day, unit)


def with_period(df: DataFrame, day: str, unit: str) -> DataFrame:
    """Adds the partition column: days for large volumes, months where a day would be a tiny file."""
    return df.withColumn("period", period_of(day, unit))


def write_partitioned(df: DataFrame, path: str, key: str = "report_date") -> None:
    """Replaces only the partitions present in ``df``; a repeated write leaves the same table.

    Rebalancing by the key gives each day few files and splits a day that is too large for one.
    """
    (
        df.hint("rebalance", key)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(key)
        .parquet(path)
    )


def write_creative_metadata(df: DataFrame, root: str) -> dict[str, str]:
    paths = {"parquet": f"{root}/creative_metadata/parquet", "json": f"{root}/creative_metadata/json"}
    df.write.mode("overwrite").parquet(paths["parquet"])
    df.sparkSession.read.schema(df.schema).parquet(paths["parquet"]).write.mode("overwrite").json(paths["json"])
    return paths


def export_table(df: DataFrame, table: str, path: str) -> None:
    """Stores a query as an external Parquet table of the catalog."""
    df.write.format("parquet").mode("overwrite").option("path", path).saveAsTable(table)


def append_actions(actions: DataFrame, path: str) -> None:
    """Appends to the action log, JSON lines by day and run; a run that is repeated replaces its own rows."""
    stamped = actions.withColumns(
        {"date": F.date_format("timestamp", "yyyy-MM-dd"), "run_ts": F.date_format("timestamp", "yyyyMMdd_HHmmss")}
    )
    (
        stamped.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date", "run_ts")
        .json(path)
    )


def write_copy(variations: DataFrame, root: str, generated_at: datetime, metadata: dict[str, str]) -> None:
    """Generated copy as one JSON line per variation, stamped, and as ``latest``."""
    rows = variations.withColumns(
        {
            "generated_at": F.lit(generated_at),
            "metadata": F.create_map(*[F.lit(x) for kv in metadata.items() for x in kv])
            if metadata
            else F.lit(None).cast("map<string,string>"),
        }
    )
    stamp = generated_at.strftime("%Y%m%d_%H%M%S")
    for target in (f"run_ts={stamp}", "latest"):
        rows.write.mode("overwrite").json(f"{root}/generated_copy/{target}")


def list_tables(spark: SparkSession, database: str = "default") -> DataFrame:
    """Name and kind of every table and view of the database."""
    return spark.sql(f"SHOW TABLES IN {database}").select(
        F.col("tableName").alias("table_name"),
        F.when(F.col("isTemporary"), "VIEW").otherwise("TABLE").alias("table_type"),
    )

