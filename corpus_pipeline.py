"""The corpus pipeline: from ``documents`` to packed token windows.

Each stage works on all rows that the one before kept. All but the last return the columns of ``documents``; a stage's result is
written as Parquet and read again before the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adperf.llm import langid, mixing, odd_sketch, packing, toxicity
from adperf.llm.common import read, stored
from adperf.llm.queries import vocabulary


SHARED = 80  # hundredths of their shingles that two near copies have in common at least


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models reject go."""
    return toxicity.drop_toxic(docs, read(spark, sf_dir, "labels"))


def drop_unidentified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no known language go."""
    return langid.drop_unidentified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return odd_sketch.drop_near_duplicates(docs, percent=SHARED)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out until the sources have their target shares, in shuffled order."""
    return mixing.mix(docs, mixing.WEIGHTS).select(*docs.columns)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in token windows."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unidentified),
    ("near_dedup", drop_near_duplicates),
    ("source_mix", mix_sources),
    ("packing", pack_windows),
]

# The learned stages cannot be stated in SQL; tests/llm checks each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
