"""Landing-file scans."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.text import landing_name, plain_path


def resolve_path(configured: str | None, override: str | None = None) -> str:
    """The explicit path if there is one, else the configured one."""
    path = override or configured
    if not path:
        raise ValueError("no source path configured or given")
    return path


def with_file_name(df: DataFrame) -> DataFrame:
    """Add ``_file_name``. Call it directly on a file scan, where the metadata column exists."""
    return df.withColumn("_file_name", landing_name(plain_path(F.col("_metadata.file_path"))))


def read_delimited(spark: SparkSession, path: str, sep: str = "|", header: bool = True,
                   schema: str | None = None) -> DataFrame:
    """Delimited text with every column as STRING."""
    reader = spark.read.options(sep=sep, header=header, quote='"', escape='"', inferSchema=False)
    if schema is not None:
        reader = reader.schema(schema)
    return with_file_name(reader.csv(path))


def read_parquet_as_strings(spark: SparkSession, path: str) -> DataFrame:
    """Parquet with every column cast to STRING; extra columns of newer files are kept."""
    df = spark.read.option("mergeSchema", True).parquet(path)
    names = df.columns
    return with_file_name(df).select(*[F.col(c).cast("string").alias(c) for c in names], "_file_name")


def read_landing(spark: SparkSession, path: str, file_format: str, sep: str = "|", header: bool = True) -> DataFrame:
    if file_format.lower() == "parquet":
        return read_parquet_as_strings(spark, path)
    return read_delimited(spark, path, sep, header)


def read_landed_files(spark: SparkSession, paths: list[str], file_format: str, sep: str = "|", header: bool = True) -> DataFrame:
    """Certain landing files, with the columns and types that they have; all as STRING. Delimited files of one call
    must have one header, else the read fails rather than put values under wrong names."""
    exact = [re.sub(r"([\\\\*?\[\]{}])", r"\\\1", p) for p in paths]
    if file_format.lower() == "parquet":
        df = spark.read.option("mergeSchema", True).parquet(*exact)
    else:
        df = spark.read.options(sep=sep, header=header, quote='"', escape='"', inferSchema=False, enforceSchema=False).csv(exact)
    return with_file_name(df).select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns], "_file_name")


def has_source(spark: SparkSession, path: str, file_format: str = "parquet", sep: str = "|",
               header: bool = True) -> bool:
    """False when the folder is missing, holds no file, or its files hold no row."""
    try:
        return not read_landing(spark, path, file_format, sep, header).isEmpty()
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
