"""Configuration rows: data subjects and extract objects."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import schema


def active_configuration(metadata: DataFrame, data_subject: str) -> DataFrame:
    return metadata.filter((F.col("data_subject") == data_subject) & F.col("is_active"))


def get_pipeline_metadata(metadata: DataFrame, data_subject: str) -> dict[str, Any]:
    """The active row of a subject. ``metadata`` may be a table or a JDBC scan; the filter is pushed down."""
    row = active_configuration(metadata, data_subject).first()
    if row is None:
        raise LookupError(f"no active configuration for data subject {data_subject!r}")
    return row.asDict()


def default_subjects(spark: SparkSession, source_root: str = "forecast") -> DataFrame:
    """One subject per frequency."""
    files = {"daily": 8, "weekly": 8, "monthly": 4, "quarterly": 4}
    rows = [
        dict(
            data_subject=f"fc_{frequency}", source_system="forecast", frequency=frequency,
            source_path=f"{source_root}/{frequency}", landing_container="landing", bronze_table="bronze",
            silver_table="silver", gold_table="fact", file_format="parquet", delimiter="|", has_header=True,
            null_check_columns=",".join(schema.BUSINESS_KEY), partition_column="forecast_date",
            apply_concat=True, group_columns="_file_name", metric_columns=",".join(schema.METRICS),
            num_partitions=n, is_active=True,
        )
        for frequency, n in files.items()
    ]
    return spark.createDataFrame([tuple(r[f.name] for f in schema.PIPELINE_METADATA.fields) for r in rows],
                                 schema.PIPELINE_METADATA)
