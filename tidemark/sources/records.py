"""Export as JSON records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_records(df: DataFrame) -> DataFrame:
    """One JSON text per row; null fields stay."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("record"))


def export_records(df: DataFrame, path: str) -> None:
    """Write JSON lines in parallel; null fields stay."""
    df.write.json(path, ignoreNullFields=False)
