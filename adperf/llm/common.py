"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adperf.settings import shared_dir

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


_held: dict = {}


def only_one(key, make):
    """``make()`` for a key, kept by this Python worker until another key is asked for: workers serve many stages, and
    their word tables must not add up."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A test table. Python workers can import this package afterwards, wherever the driver was started."""
    environment = spark.sparkContext.environment
    if PACKAGE_ROOT not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [PACKAGE_ROOT, environment.get("PYTHONPATH", "")]))
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below ``spark.checkpoint.dir`` and read again: cuts the lineage, and a lost
    executor loses nothing of it. Each call writes a folder of its own; the cluster's retention removes it."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BITS_EACH, MOST_BITS = 16, 1 << 27  # of the bitmap that thins a scan: for each wanted id, and in all (16 MB)


def possibly_wanted(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """The rows whose ``column`` can be among the ids of ``wanted`` (id), and a few others.

    A bitmap marks the hashes of the wanted ids and is broadcast; its size is bounded whatever the input, so a scan is thinned
    before its rows are shuffled for an exact join. Beyond MOST_BITS / BITS_EACH ids more other rows pass, and cost work only.
    """
    bits = min(MOST_BITS, max(1 << 15, wanted.count() * BITS_EACH))

    def place(c):
        return F.pmod(F.xxhash64(c), F.lit(bits).cast("long"))

    marks = wanted.select(place("id").alias("place")).groupBy(F.bitmap_bucket_number("place").alias("__bucket"))
    marks = marks.agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("__marks"))  # 4 KB a row, bits / 32768 rows
    found = rows.withColumn("__place", place(column))
    found = found.join(F.broadcast(marks), F.bitmap_bucket_number("__place") == F.col("__bucket"))
    position = F.bitmap_bit_position("__place")
    octet = F.conv(F.hex(F.substring("__marks", F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return found.filter(F.getbit(octet, (position % 8).cast("int")) == 1).select(*rows.columns)


def whole_text(df: DataFrame) -> Column:
    """The text column as a string, empty where it is NULL or the table has none."""
    return F.coalesce(F.col("text").cast("string"), F.lit("")) if "text" in df.columns else F.lit("")


def ascii_lower(column: Column) -> Column:
    """A-Z lower-cased, all other characters as they are."""
    return F.translate(column, UPPER, LOWER)


def id_fold(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; NULL ids count as the text ``null``."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("null")).cast("binary")) % modulus
