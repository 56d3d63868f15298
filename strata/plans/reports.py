"""The monitoring reports as temporary views over a database's logs, for use from SQL."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from strata.operators import monitor, quality
from strata.schema import table_name

VIEWS = ["vw_latest_pipeline_runs", "vw_daily_load_summary", "vw_dq_summary", "vw_aggregated_audit"]


def register_views(spark: SparkSession, database: str, as_of: Column | None = None) -> None:
    """Create or replace the views; ``as_of`` defaults to the time of each query."""
    runs = monitor.with_status_updates(spark.table(table_name(database, "pipeline_audit")))
    checks = spark.table(table_name(database, "data_quality_log"))
    subjects = spark.table(table_name(database, "pipeline_metadata"))
    now = F.current_timestamp() if as_of is None else as_of
    reports = [
        monitor.latest_runs(runs, now), monitor.daily_load_summary(runs), quality.dq_summary(checks),
        monitor.aggregated_audit(runs, subjects),
    ]
    for name, report in zip(VIEWS, reports):
        report.createOrReplaceTempView(name)
