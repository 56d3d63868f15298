"""Standardising, typing and enriching."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import schema
from strata.functions.dates import period_of
from strata.functions.text import blank_to_null, source_batch_nr


def existing(df: DataFrame, columns: Iterable[str]) -> list[str]:
    """The listed columns that the frame has, in the listed order."""
    present = set(df.columns)
    return [c for c in columns if c in present]


def _map_strings(df: DataFrame, change) -> DataFrame:
    return df.select([
        change(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields
    ])


def trim_strings(df: DataFrame) -> DataFrame:
    return _map_strings(df, F.trim)


def nullify_empty_strings(df: DataFrame) -> DataFrame:
    """Empty and all-space strings become NULL; other values stay as they are."""
    return _map_strings(df, blank_to_null)


def upper_cols(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.upper(c) for c in existing(df, columns)})


def align_columns(df: DataFrame, mapping: Mapping[str, str], target: T.StructType = schema.LANDING) -> DataFrame:
    """Rename source-specific columns, add missing ones as NULL and keep unknown ones at the end."""
    named = df.withColumnsRenamed(dict(mapping))
    have = set(named.columns)
    wanted = [
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.fields
    ]
    names = {f.name for f in target.fields}
    return named.select(*wanted, *[F.col(c) for c in named.columns if c not in names])


def conform(df: DataFrame, target: T.StructType) -> DataFrame:
    """Exactly the target's columns, in its order and types; missing ones are NULL."""
    have = set(df.columns)
    return df.select([
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.fields
    ])


def standardize(df: DataFrame) -> DataFrame:
    """Trim every string and put categories in upper case."""
    return upper_cols(trim_strings(df), ["category"])


def cast_columns(df: DataFrame, types: Mapping[str, str] = schema.TYPED_COLUMNS) -> DataFrame:
    """Tolerant cast: a value that does not parse becomes NULL. Split such rows off beforehand."""
    return df.withColumns({c: F.col(c).try_cast(types[c]) for c in existing(df, types)})


def drop_if_exists(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.drop(*columns)


def derive_period(df: DataFrame, column: str = "forecast_date", apply_concat: bool = True) -> DataFrame:
    """Add ``period``. A frame without the column is returned unchanged."""
    if column not in df.columns:
        return df
    value = period_of(F.col(column)) if apply_concat else F.col(column)
    return df.withColumn("period", value)


def _ts(value: datetime) -> Column:
    return F.lit(value).cast("timestamp")


def enrich_bronze(
    df: DataFrame, *, batch_id: str, load_job_nr: str, frequency: str, run_ts: datetime
) -> DataFrame:
    return df.withColumns({
        "_ingestion_ts": _ts(run_ts),
        "_update_ts": _ts(run_ts),
        "_source_batch_nr": source_batch_nr(F.col("_file_name")),
        "_frequency": F.lit(frequency),
        "_load_job_nr": F.lit(load_job_nr),
        "_batch_id": F.lit(batch_id),
        "_load_date": F.lit(run_ts.date()),
    })


def enrich_silver(df: DataFrame, *, batch_id: str, run_ts: datetime) -> DataFrame:
    """Silver columns on, Bronze-only columns off."""
    kept = drop_if_exists(df, ["_source_batch_nr", "_load_job_nr", "_load_date"])
    return kept.withColumns({
        "_ingestion_date": F.to_date("_ingestion_ts"),
        "_silver_load_ts": _ts(run_ts),
        "_batch_id": F.lit(batch_id),
    })


def enrich_gold(df: DataFrame, *, batch_id: str, run_ts: datetime) -> DataFrame:
    return df.withColumns({"_gold_load_ts": _ts(run_ts), "_batch_id": F.lit(batch_id)})


def current_batch(df: DataFrame, batch_id: str) -> DataFrame:
    return df.filter(F.col("_batch_id") == batch_id)


def active_versions(df: DataFrame) -> DataFrame:
    """Open versions. The partition column is named so that closed partitions are not read."""
    return df.filter(F.col("effective_to").isNull() & F.col("is_active"))
