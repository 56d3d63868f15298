"""The registered queries: name, Spark function and, where SQL can say it, its DuckDB twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Dates and times as text and decimals as doubles, which both engines print alike."""
    def plain(field: T.StructField):
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return col.cast("string").alias(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return col.cast("double").alias(field.name)
        return col

    return df.select([plain(f) for f in df.schema.fields])


def query(sql: str | None = None, name: str | None = None):
    """Register a function as a query under its own name."""
    def add(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = lambda spark, sf_dir: portable(fn(spark, sf_dir))
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return add
