"""Layer schemas, keys and the fixed values the data model prescribes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# The common source columns, in the order of the data model.
SOURCE_COLUMNS = [
    "product_id", "location_id", "forecast_date", "forecast_qty", "revenue_amount", "customer_id",
    "channel", "category", "sub_category", "region", "country", "currency", "uom",
]

# Keys, metrics and allowlists.
BUSINESS_KEY = ["product_id", "location_id", "forecast_date"]
MATCH_KEY = [*BUSINESS_KEY, "_frequency"]
FACT_KEY = ["product_id", "location_id", "forecast_date", "channel", "_frequency"]
METRICS = ["forecast_qty", "revenue_amount"]
VALID_CATEGORIES = ["SERVER", "STORAGE", "COMPUTE", "NETWORKING", "PRIVATE_CLOUD", "SUPERCOMPUTING", "AI"]
VALID_CURRENCIES = ["USD", "EUR", "GBP", "JPY", "INR", "SGD", "AED", "BRL"]
FAIL_REASONS = ["NULL_PK", "TYPE_ERROR"]
LAYERS = ["BRONZE", "SILVER", "GOLD", "AGGR_AUDIT"]

# Columns whose change opens a new version in Silver.
TRACKED = ["forecast_qty", "revenue_amount", "customer_id", "channel", "category", "sub_category",
           "region", "country", "currency", "uom"]

TYPED_COLUMNS = {
    "forecast_date": "date",
    "forecast_qty": "decimal(18,4)",
    "revenue_amount": "decimal(18,2)",
}


_TYPES = {
    "string": T.StringType(), "date": T.DateType(), "timestamp": T.TimestampType(), "bigint": T.LongType(),
    "int": T.IntegerType(), "double": T.DoubleType(), "boolean": T.BooleanType(),
    "array<string>": T.ArrayType(T.StringType()),
    "decimal(18,4)": T.DecimalType(18, 4), "decimal(18,2)": T.DecimalType(18, 2),
    "decimal(28,4)": T.DecimalType(28, 4), "decimal(28,2)": T.DecimalType(28, 2),
}


def _fields(columns: str) -> T.StructType:
    """A struct from ``name type, name type``; needs no session, so schemas load at import."""
    pairs = [column.split(" ") for column in columns.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


_STRINGS = ", ".join(f"{name} string" for name in SOURCE_COLUMNS)
_TYPED = ", ".join(f"{name} {TYPED_COLUMNS.get(name, 'string')}" for name in SOURCE_COLUMNS)

LANDING = _fields(_STRINGS)

BRONZE = _fields(
    f"{_STRINGS}, _file_name string, _ingestion_ts timestamp, _update_ts timestamp, "
    "_source_batch_nr string, _load_job_nr string, _batch_id string, _frequency string, _load_date date"
)

QUARANTINE = _fields(
    f"{_STRINGS}, _file_name string, _ingestion_ts timestamp, _frequency string, "
    "_batch_id string, _dq_fail_reason string"
)

SILVER = _fields(
    f"{_TYPED}, _file_name string, _ingestion_ts timestamp, _update_ts timestamp, _ingestion_date date, "
    "_silver_load_ts timestamp, _batch_id string, _dq_flags array<string>, effective_from date, "
    "is_active boolean, _frequency string, period string, effective_to date"
)

PERIOD_AGG = _fields(
    "category string, region string, period string, _frequency string, no_of_records bigint, "
    "forecast_qty decimal(28,4), revenue_amount decimal(28,2), _silver_load_ts timestamp, _batch_id string"
)

FACT = _fields(
    f"product_key bigint, location_key bigint, time_key bigint, {_TYPED}, _file_name string, "
    "_ingestion_ts timestamp, _update_ts timestamp, _gold_load_ts timestamp, _batch_id string, "
    "period string, _frequency string"
)

FACT_ARCHIVE = _fields(
    f"product_key bigint, location_key bigint, time_key bigint, {_TYPED}, _file_name string, "
    "_ingestion_ts timestamp, _update_ts timestamp, _gold_load_ts timestamp, _batch_id string, "
    "_archived_ts timestamp, period string, _frequency string"
)

SILVER_ARCHIVE = _fields(
    f"{_TYPED}, _file_name string, _ingestion_ts timestamp, _update_ts timestamp, _ingestion_date date, "
    "_silver_load_ts timestamp, _dq_flags array<string>, effective_from date, is_active boolean, "
    "effective_to date, period string, _archived_ts timestamp, _frequency string, _batch_id string"
)

DIM_PRODUCT = _fields(
    "product_key bigint, product_id string, category string, sub_category string, product_name string, "
    "is_active boolean, effective_from date, _load_ts timestamp, effective_to date"
)

DIM_LOCATION = _fields(
    "location_key bigint, location_id string, region string, country string, city string, "
    "is_active boolean, effective_from date, _load_ts timestamp, effective_to date"
)

DIM_TIME = _fields(
    "time_key bigint, date_key date, year int, quarter int, month int, month_name string, "
    "week_of_year int, day_of_week int, day_name string, is_weekend boolean, fiscal_year int, "
    "fiscal_quarter int, period string"
)

KPI = _fields(
    "file_name string, period string, category string, region string, _frequency string, "
    "no_of_records bigint, keyfigure string, total_qty_amount double, load_date timestamp, "
    "ins_gmt_ts timestamp, ld_jb_nr string, data_subject string, _batch_id string"
)

JOB_LOG = _fields(
    "batch_id string, insert_time timestamp, layer string, status string, records_inserted bigint, "
    "records_updated bigint, source_system string, data_subject string, error_message string"
)

PIPELINE_AUDIT = _fields(
    "batch_id string, application_id string, object_name string, data_layer string, "
    "job_start_ts timestamp, job_end_ts timestamp, job_status string, source_row_count bigint, "
    "target_row_count bigint, error_record_count bigint, job_duration_sec int, source_system string, "
    "data_subject string, file_name string, load_job_number string, created_by string, error_message string, "
    "created_ts timestamp, updated_ts timestamp"
)

DQ_LOG = _fields(
    "batch_id string, table_name string, check_type string, column_name string, records_checked bigint, "
    "records_failed bigint, check_status string, error_message string, created_ts timestamp"
)

PIPELINE_METADATA = _fields(
    "data_subject string, source_system string, frequency string, source_path string, "
    "landing_container string, bronze_table string, silver_table string, gold_table string, "
    "file_format string, delimiter string, has_header boolean, null_check_columns string, "
    "partition_column string, apply_concat boolean, group_columns string, metric_columns string, "
    "num_partitions int, is_active boolean"
)

EXTRACT_METADATA = _fields(
    "source_system string, connector string, source_schema string, source_object string, "
    "landing_path string, data_subject string, load_type string, watermark_column string, "
    "last_watermark string, is_active boolean"
)


def _fields_of(struct: T.StructType, more: str) -> T.StructType:
    return T.StructType([*struct.fields, *_fields(more).fields])


@dataclass(frozen=True)
class Table:
    schema: T.StructType
    partitions: tuple[str, ...] = ()


# Open versions live in the effective_to IS NULL partition and closed ones in that of their closing
# day, so a merge reads and rewrites open slices and leaves older history untouched. Tables written
# once per run carry the batch in the partition, which makes a repeated write replace itself.
TABLES: dict[str, Table] = {
    "bronze": Table(BRONZE, ("_frequency", "_load_date", "_batch_id")),
    "bronze_stream": Table(BRONZE, ("_frequency", "_batch_id")),
    "quarantine": Table(QUARANTINE, ("_frequency", "_batch_id", "_dq_fail_reason")),
    "silver": Table(SILVER, ("_frequency", "period", "effective_to")),
    "silver_archive": Table(SILVER_ARCHIVE, ("_frequency", "_batch_id")),
    "period_agg": Table(PERIOD_AGG, ("_frequency", "_batch_id")),
    "fact": Table(FACT, ("period", "_frequency")),
    "fact_archive": Table(FACT_ARCHIVE, ("period", "_frequency")),
    "dim_product": Table(DIM_PRODUCT, ("effective_to",)),
    "dim_location": Table(DIM_LOCATION, ("effective_to",)),
    "dim_time": Table(DIM_TIME),
    "kpi": Table(KPI, ("data_subject", "_batch_id")),
    "job_log": Table(JOB_LOG),
    "pipeline_audit": Table(PIPELINE_AUDIT),
    "data_quality_log": Table(_fields_of(DQ_LOG, "data_subject string"), ("data_subject", "batch_id", "table_name")),
    "pipeline_metadata": Table(PIPELINE_METADATA),
    "extract_metadata": Table(EXTRACT_METADATA),
}


def table_name(database: str, name: str) -> str:
    return f"{database}.{name}"


def ensure_tables(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create the database and every layer table from its declared schema; existing ones stay."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
    for name, table in TABLES.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema.fields)
        parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in table.partitions)})" if table.partitions else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table_name(database, name)} ({columns}) USING PARQUET{parts}")
