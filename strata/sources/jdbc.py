"""JDBC scans and appends, for configuration, logs and extracts kept in a database."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class SplitBy:
    """Read a table in parallel by ranges of a numeric, date or timestamp column."""

    column: str
    lower: str
    upper: str
    partitions: int


@dataclass(frozen=True)
class Database:
    url: str
    properties: dict[str, str] = field(default_factory=dict)


def read_options(database: Database, table: str, split: SplitBy | None = None,
                 fetch_size: int = 10_000) -> dict[str, str]:
    options = {"url": database.url, "dbtable": table, "fetchsize": str(fetch_size), **database.properties}
    if split is not None:
        options.update(partitionColumn=split.column, lowerBound=split.lower, upperBound=split.upper,
                       numPartitions=str(split.partitions))
    return options


def read_jdbc(spark: SparkSession, database: Database, table: str, split: SplitBy | None = None) -> DataFrame:
    """Filters and columns applied to the result are pushed to the database by Spark."""
    return spark.read.format("jdbc").options(**read_options(database, table, split)).load()


def append_jdbc(df: DataFrame, database: Database, table: str) -> None:
    df.write.jdbc(url=database.url, table=table, mode="append", properties=database.properties)
