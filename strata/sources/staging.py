"""Intermediate rows of a batch, in the shared folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import shared_dir


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def staging_path(spark: SparkSession, *parts: str) -> str:
    return "/".join([shared_dir(spark), "strata-staging", *parts])


def fingerprint(rows: DataFrame, columns: Sequence[str]) -> str:
    """Count and order-free hash of the rows' ``columns``: tells whether a merge was made from them."""
    found = rows.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("h")).first()
    return f"{found.n}-{found.h or 0}"


def stage_rows(df: DataFrame, path: str) -> DataFrame:
    """Rows that several steps read, computed and written once."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_staged(spark: SparkSession, path: str) -> None:
    """Remove one batch's staged rows after its commit."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
