"""Extracts from source objects to landing folders, driven by a high-water mark."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def full_extract(df: DataFrame) -> DataFrame:
    """Every row and column of the source object."""
    return df


def incremental_extract(df: DataFrame, watermark_column: str, last_watermark: Any) -> DataFrame:
    """Rows above the mark. The bare comparison is pushed into the Parquet or JDBC scan."""
    if last_watermark is None:
        return full_extract(df)
    mark = F.lit(last_watermark).cast(df.schema[watermark_column].dataType)
    return df.filter(F.col(watermark_column) > mark)


def extracted_mark(extracted: DataFrame, watermark_column: str) -> DataFrame:
    """The highest value of the extract as text; NULL for an empty extract."""
    return extracted.agg(F.max(watermark_column).cast("string").alias("new_watermark"))


def _is_object(system: str, name: str):
    return (F.col("source_system") == system) & (F.col("source_object") == name)


def advance_watermark(state: DataFrame, system: str, name: str, new_mark: str | None) -> DataFrame:
    """Extract state with the mark moved up. Full loads and empty extracts leave it as it is."""
    moves = _is_object(system, name) & (F.col("load_type") == "incremental") & F.lit(new_mark).isNotNull()
    return state.withColumn("last_watermark", F.when(moves, F.lit(new_mark)).otherwise(F.col("last_watermark")))


def set_watermark(state: DataFrame, system: str, name: str, value: str | None) -> DataFrame:
    """Extract state with the mark set by hand; NULL makes the next extract a full one."""
    chosen = _is_object(system, name)
    return state.withColumn(
        "last_watermark", F.when(chosen, F.lit(value).cast("string")).otherwise(F.col("last_watermark")))
