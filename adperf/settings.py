"""Thresholds, session settings and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass
from datetime import date

from pyspark.sql import SparkSession

# Reference dates of the test tables: inside the dense range of lineitem and the last day of events.
AS_OF = date(2001, 6, 30)
EVENTS_AS_OF = date(2024, 1, 30)


@dataclass(frozen=True)
class Thresholds:
    """Decision thresholds; every rule takes them from here, never from literals."""

    min_ctr: float = 1.0
    top_ctr: float = 3.0
    max_cpc: float = 8.0
    min_sample: int = 100
    bid_change: float = 0.50
    target_ctr: float = 2.0
    max_cpa: float = 100.0

    @classmethod
    def from_env(cls, env=os.environ) -> "Thresholds":
        """Defaults overridden by MIN_CTR_THRESHOLD, TOP_PERFORMER_THRESHOLD, MAX_CPC, ..."""
        return cls(
            min_ctr=float(env.get("MIN_CTR_THRESHOLD", cls.min_ctr)),
            top_ctr=float(env.get("TOP_PERFORMER_THRESHOLD", cls.top_ctr)),
            max_cpc=float(env.get("MAX_CPC", cls.max_cpc)),
            min_sample=int(env.get("MIN_SAMPLE_SIZE", cls.min_sample)),
            bid_change=float(env.get("BID_CHANGE_THRESHOLD", cls.bid_change)),
        )


# Bytes of a shuffle that one task takes at least and, where rows may go to any task, at most. Advertising rows take many times as much
# in a sort buffer as compressed (50 times on repeated rows), so Spark's 64 MB would be spilled.
SHARE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def configure(spark: SparkSession) -> SparkSession:
    """Session settings the results depend on; all can be set at run time."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    if spark.conf.get(SHARE, None) in (None, "67108864b", "64MB", "64m"):  # Spark's default
        spark.conf.set(SHARE, "16m")
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new directory below the folder the cluster shares (``spark.checkpoint.dir``).

    Only a local session may go without that setting: there the driver's temporary folder is
    visible to every task.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = os.path.join(tempfile.gettempdir(), "adperf")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Iterative fits cut their lineage by checkpoints; the cluster's folder is used where one is set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(
            spark.conf.get("spark.checkpoint.dir", None) or shared_dir(spark, "checkpoints")
        )
