"""Run log, audit entries and data-quality log."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import schema
from strata.operators import quality
from strata.sources.jdbc import Database, append_jdbc
from strata.sources.sinks import append_rows, write_slice

Sink = str | tuple[Database, str]


def _frame(spark: SparkSession, struct: T.StructType, **values) -> DataFrame:
    """One row made of literals."""
    columns = [F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in struct.fields]
    return spark.range(1, numPartitions=1).select(columns)


def append_to(df: DataFrame, sink: Sink) -> None:
    """Append to a layer table (by name) or to a database table."""
    if isinstance(sink, str):
        append_rows(df, sink)
    else:
        append_jdbc(df, *sink)


def _now() -> datetime:
    return datetime.now(timezone.utc)


def write_audit_entry(spark: SparkSession, sink: Sink, *, batch_id: str, application_id: str | None = None,
                      object_name: str, data_layer: str, job_status: str, source_row_count: int | None = 0,
                      target_row_count: int | None = 0, error_record_count: int | None = 0,
                      source_system: str | None = None, data_subject: str | None = None,
                      file_name: str | None = None, load_job_number: str | None = None, job_start_ts: datetime | None = None,
                      job_end_ts: datetime | None = None, error_message: str | None = None) -> None:
    """One audit row. Missing times default to now; the duration is in whole seconds."""
    now = _now()
    start, end = job_start_ts or now, job_end_ts or now
    append_to(_frame(
        spark, schema.PIPELINE_AUDIT, batch_id=batch_id, application_id=application_id, object_name=object_name,
        data_layer=data_layer, job_start_ts=start, job_end_ts=end, job_status=job_status,
        source_row_count=source_row_count, target_row_count=target_row_count,
        error_record_count=error_record_count, job_duration_sec=int((end - start).total_seconds()),
        source_system=source_system, data_subject=data_subject, file_name=file_name,
        load_job_number=load_job_number, created_by=application_id, error_message=error_message, created_ts=now, updated_ts=now,
    ), sink)


def mark_audit_failed(spark: SparkSession, sink: Sink, *, error_message: str | None = None, **entry) -> None:
    """A FAILED audit row that keeps the message."""
    write_audit_entry(spark, sink, job_status="FAILED", error_message=error_message, **entry)


def log_no_data(spark: SparkSession, sink: Sink, **entry) -> None:
    write_audit_entry(spark, sink, data_layer="LANDING", job_status="NO_DATA", **entry)


def update_audit_status(spark: SparkSession, table: str, *, batch_id: str, object_name: str, data_layer: str,
                        job_status: str, source_row_count: int | None = None, target_row_count: int | None = None,
                        error_record_count: int | None = None, job_end_ts: datetime | None = None) -> None:
    """Append a newer status for an entry; ``merge_status_updates`` resolves it. NULL keeps the old count."""
    entry = (F.col("batch_id") == batch_id) & (F.col("object_name") == object_name) & (
        F.col("data_layer") == data_layer)
    first = spark.table(table).filter(entry).agg(F.min("job_start_ts").alias("start")).first()
    if first.start is None:
        raise LookupError(f"no audit entry for {batch_id}, {object_name}, {data_layer}")
    now = _now()
    end = job_end_ts or now
    append_rows(_frame(
        spark, schema.PIPELINE_AUDIT, batch_id=batch_id, object_name=object_name, data_layer=data_layer,
        job_start_ts=None, job_end_ts=end, job_status=job_status, source_row_count=source_row_count,
        target_row_count=target_row_count, error_record_count=error_record_count, created_ts=now, updated_ts=now,
    ), table)


def write_job_log(spark: SparkSession, sink: Sink, *, batch_id: str, layer: str, status: str, insert_time: datetime,
                  records_inserted: int = 0, records_updated: int = 0, source_system: str | None = None,
                  data_subject: str | None = None, error_message: str | None = None) -> None:
    append_to(_frame(
        spark, schema.JOB_LOG, batch_id=batch_id, insert_time=insert_time, layer=layer, status=status,
        records_inserted=records_inserted, records_updated=records_updated, source_system=source_system,
        data_subject=data_subject, error_message=error_message,
    ), sink)


def log_dq_results(spark: SparkSession, sink: Sink, *, batch_id: str, table_name: str, check_type: str,
                   column_name: str, records_checked: int, records_failed: int, created_ts: datetime | None = None,
                   error_message: str | None = None) -> None:
    """One data-quality row: PASSED when nothing failed."""
    append_to(_frame(
        spark, schema.DQ_LOG, batch_id=batch_id, table_name=table_name, check_type=check_type,
        column_name=column_name, records_checked=records_checked, records_failed=records_failed,
        check_status="PASSED" if records_failed == 0 else "FAILED", error_message=error_message,
        created_ts=created_ts or _now(),
    ), sink)


def log_dq_counts(counts: DataFrame, sink: Sink, *, batch_id: str, table_name: str, created_ts: datetime,
                  data_subject: str | None = None) -> None:
    """All rule counts of a layer in one write. In a layer table a repeat replaces the counts of its subject,
    batch and table."""
    rows = quality.dq_log_rows(counts, batch_id=batch_id, table_name=table_name, created_ts=created_ts)
    if isinstance(sink, str):
        write_slice(rows.withColumn("data_subject", F.lit(data_subject).cast("string")).coalesce(1), sink)
    else:
        append_to(rows, sink)


@dataclass(frozen=True)
class Loaded:
    """What the job log says of a loaded layer: its day and the rows it wrote."""

    day: date
    inserted: int


def loaded_layers(spark: SparkSession, table: str, batch_id: str, data_subject: str) -> dict[str, Loaded]:
    """The layers this batch has a successful entry for, by name. The job log is the commit marker."""
    spark.catalog.refreshTable(table)  # sessions beside this one may have written to it
    done = spark.table(table).filter(
        (F.col("batch_id") == batch_id) & (F.col("data_subject") == data_subject) & (F.col("status") == "SUCCESS"))
    newest = done.groupBy("layer").agg(
        F.to_date(F.max("insert_time")).alias("day"), F.max_by("records_inserted", "insert_time").alias("inserted"))
    return {row.layer: Loaded(row.day, row.inserted) for row in newest.collect()}
