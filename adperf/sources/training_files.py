"""Reading training sets back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import AnalysisException


def read_training(spark: SparkSession, path: str, formats=("parquet",), distinct: bool = False) -> DataFrame:
    """Every file of the given formats below ``path``, put together by column name.

    CSV files take the types of the formats named before them, else Spark infers them.
    ``distinct`` removes the copies a set has when it was stored in more than one format.
    """
    parts = []
    for fmt in formats:
        reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", f"*.{fmt}")
        if fmt == "csv":
            reader = reader.option("header", True).option("multiLine", True).option("escape", '"')
            reader = reader.schema(parts[0].schema) if parts else reader.option("inferSchema", True)
        try:
            part = reader.format(fmt).load(path)
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                continue
            raise
        if part.columns:
            parts.append(part)
    if not parts:
        raise ValueError(f"no training files below {path}")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out.dropDuplicates() if distinct else out
