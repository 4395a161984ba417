"""Results as JSON, one document per line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_json(result: DataFrame) -> DataFrame:
    """Each row as one JSON document in column ``value``."""
    return result.select(F.to_json(F.struct(*result.columns)).alias("value"))


def write_json(result: DataFrame, path: str, mode: str = "overwrite") -> None:
    result.write.mode(mode).json(path)
