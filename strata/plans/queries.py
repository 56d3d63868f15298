"""Operator queries over the driver's tables."""

from __future__ import annotations

import functools
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import fixture, schema
from strata.functions.keys import surrogate_key
from strata.functions.text import is_blank, source_batch_nr
from strata.operators import clean, dedup, kpi, monitor, quality, scd2, star
from strata.plans.oracle import (
    CASTABLE, FIRST_DAY, KEY, KEYS_PRESENT, SECOND_DAY, STALE_MARK, differs, matches, real, strings, text,
    with_parts,
)
from strata.plans.registry import query
from strata.sources import config, extract
from strata.session import work_path
from strata.sources.files import with_file_name
from strata.sources.staging import stage_rows

SRC_ID = "_src_orderkey, _src_linenumber, _src_partkey, _src_suppkey"
SRC_IDS = SRC_ID.split(", ")
ID_COLUMNS = [*SRC_IDS, "_frequency", "_batch_id"]
ID_SQL = ", ".join(ID_COLUMNS)
BATCH_KEY = ["_batch_id", *schema.MATCH_KEY]
FIRST, SECOND = date.fromisoformat(FIRST_DAY), date.fromisoformat(SECOND_DAY)
FIRST_TS, SECOND_TS = datetime(1998, 7, 1, 6), datetime(1998, 12, 1, 6)
QTY = "forecast_qty"
REV = "revenue_amount"


def as_of() -> F.Column:
    return F.lit(fixture.AS_OF).cast("timestamp_ntz")


def standardized(spark: SparkSession, sf: str) -> DataFrame:
    return clean.nullify_empty_strings(clean.standardize(fixture.forecast_src(spark, sf)))


def valid_rows(spark: SparkSession, sf: str) -> DataFrame:
    return quality.validate_not_null(standardized(spark, sf), schema.BUSINESS_KEY)[0]


def castable_rows(spark: SparkSession, sf: str) -> DataFrame:
    return quality.validate_data_types(valid_rows(spark, sf), schema.TYPED_COLUMNS)[0]


def _typed(df: DataFrame) -> DataFrame:
    return clean.derive_period(clean.cast_columns(df))


def clean_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Survivors per batch, typed, with their period."""
    return _typed(dedup.dedup_latest(castable_rows(spark, sf), BATCH_KEY, fixture.LATEST_ORDER))


def batch_one(spark: SparkSession, sf: str) -> DataFrame:
    return clean.current_batch(clean_rows(spark, sf), "b1")


def batch_two(spark: SparkSession, sf: str) -> DataFrame:
    """What an extract with a stale mark delivers: the second batch, and recent rows once more."""
    again = extract.incremental_extract(castable_rows(spark, sf), "_ingestion_ts", STALE_MARK)
    return _typed(dedup.dedup_latest(again, schema.MATCH_KEY, fixture.LATEST_ORDER))


def silver_history(spark: SparkSession, sf: str) -> DataFrame:
    opened = scd2.open_all(batch_one(spark, sf), FIRST)
    return scd2.scd2_merge(opened, batch_two(spark, sf), schema.MATCH_KEY, schema.TRACKED, SECOND)


def _dimension(current: DataFrame | None, batch: DataFrame, kind: str, day: date, ts: datetime) -> DataFrame:
    struct, merge = {
        "product": (schema.DIM_PRODUCT, star.merge_dim_product),
        "location": (schema.DIM_LOCATION, star.merge_dim_location),
    }[kind]
    if current is None:
        current = batch.sparkSession.createDataFrame([], struct)
    return merge(current, batch, day, ts)


def _history_of(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    one = _dimension(None, batch_one(spark, sf), kind, FIRST, FIRST_TS)
    return _dimension(one, batch_two(spark, sf), kind, SECOND, SECOND_TS)


# ---------------------------------------------------------------- minimum slice


@query(with_parts(
    "SELECT period, category, region, _frequency, count(*) AS no_of_records, 'forecast_qty' AS keyfigure,"
    " CAST(sum(forecast_qty) AS DOUBLE) AS total_qty_amount FROM batch1 GROUP BY period, category, region, _frequency"
    " UNION ALL SELECT period, category, region, _frequency, count(*), 'revenue_amount',"
    " CAST(sum(revenue_amount) AS DOUBLE) FROM batch1 GROUP BY period, category, region, _frequency", "batch1"))
def kpi_by_period(spark, sf):
    return kpi.kpi_rows(batch_one(spark, sf), kpi.PERIOD_GROUP, schema.METRICS).drop("load_date")


# ---------------------------------------------------------------- projections


@query(with_parts(f"SELECT {strings()}, {ID_SQL} FROM std", "std"))
def bronze_standardize(spark, sf):
    return clean.standardize(fixture.forecast_src(spark, sf)).select(*schema.SOURCE_COLUMNS, *ID_COLUMNS)


@query(
    "SELECT CAST(l_orderkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS location_id,"
    " CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS forecast_date,"
    " CAST(CAST(l_quantity AS DECIMAL(18,4)) AS VARCHAR) AS forecast_qty, CAST(NULL AS VARCHAR) AS revenue_amount,"
    " CAST(NULL AS VARCHAR) AS customer_id, l_returnflag AS channel, CAST(NULL AS VARCHAR) AS category,"
    " CAST(NULL AS VARCHAR) AS sub_category, CAST(NULL AS VARCHAR) AS region, CAST(NULL AS VARCHAR) AS country,"
    " CAST(NULL AS VARCHAR) AS currency, CAST(NULL AS VARCHAR) AS uom, l_linenumber FROM lineitem")
def align_sources(spark, sf):
    source = fixture.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_suppkey", F.to_date("l_shipdate").alias("l_shipdate"),
        F.col("l_quantity").cast("decimal(18,4)").alias("l_quantity"), "l_returnflag", "l_linenumber")
    return clean.align_columns(source, {
        "l_orderkey": "product_id", "l_suppkey": "location_id", "l_shipdate": "forecast_date",
        "l_quantity": "forecast_qty", "l_returnflag": "channel",
    })


@query(with_parts(
    "SELECT _file_name, regexp_extract(_file_name, '.*_(\\d{12})\\.(?:csv|parquet)$', 1) AS batch_nr,"
    " count(*) AS n FROM src GROUP BY ALL", "src"))
def batch_number(spark, sf):
    rows = fixture.forecast_src(spark, sf).withColumn("batch_nr", source_batch_nr(F.col("_file_name")))
    return rows.groupBy("_file_name", "batch_nr").agg(F.count(F.lit(1)).alias("n"))


@query(with_parts(
    f"SELECT {strings()}, _file_name, '1998-07-01 06:00:00' AS _ingestion_ts, '1998-07-01 06:00:00' AS _update_ts,"
    " regexp_extract(_file_name, '.*_(\\d{12})\\.(?:csv|parquet)$', 1) AS _source_batch_nr,"
    " 'daily' AS _frequency, 'job-1' AS _load_job_nr, 'run-1' AS _batch_id, '1998-07-01' AS _load_date,"
    f" {SRC_ID} FROM src", "src"))
def bronze_enrich(spark, sf):
    return clean.enrich_bronze(fixture.forecast_src(spark, sf), batch_id="run-1", load_job_nr="job-1",
                               frequency="daily", run_ts=FIRST_TS)


@query(with_parts(
    "SELECT " + ", ".join(
        f"CASE WHEN trim({c}) = '' THEN NULL ELSE {c} END AS {c}" for c in schema.SOURCE_COLUMNS)
    + f", {ID_SQL} FROM src", "src"))
def nullify_empty(spark, sf):
    return clean.nullify_empty_strings(fixture.forecast_src(spark, sf)).select(*schema.SOURCE_COLUMNS, *ID_COLUMNS)


@query(with_parts(
    f"SELECT {strings(skip=('forecast_date', QTY, REV))}, CAST(CAST(forecast_date AS DATE) AS VARCHAR) AS"
    f" forecast_date, CAST(CAST({QTY} AS DECIMAL(18,4)) AS DOUBLE) AS {QTY},"
    f" CAST(CAST({REV} AS DECIMAL(18,2)) AS DOUBLE) AS {REV}, {ID_SQL} FROM castable", "castable"))
def cast_silver(spark, sf):
    return clean.cast_columns(castable_rows(spark, sf)).select(*schema.SOURCE_COLUMNS, *ID_COLUMNS)


@query(with_parts(
    f"SELECT product_id, {SRC_ID}, _frequency, 'run-1' AS _batch_id,"
    " CAST(CAST(_ingestion_ts AS DATE) AS VARCHAR) AS _ingestion_date, '1998-07-01 06:00:00' AS _silver_load_ts"
    " FROM castable", "castable"))
def silver_enrich(spark, sf):
    bronze_only = castable_rows(spark, sf).withColumns({"_source_batch_nr": F.lit("x"), "_load_job_nr": F.lit("y")})
    rows = clean.enrich_silver(bronze_only, batch_id="run-1", run_ts=FIRST_TS)
    return rows.drop(*[c for c in schema.SOURCE_COLUMNS if c != "product_id"], "_file_name", "_ingestion_ts")


@query(with_parts(
    f"SELECT product_id, {SRC_ID}, period, '1998-07-01 06:00:00' AS _gold_load_ts, 'run-1' AS _batch_id"
    " FROM clean", "clean"))
def gold_enrich(spark, sf):
    rows = clean.enrich_gold(clean_rows(spark, sf), batch_id="run-1", run_ts=FIRST_TS)
    return rows.select("product_id", *SRC_IDS, "period", "_gold_load_ts", "_batch_id")


@query(with_parts(
    f"SELECT {SRC_ID}, forecast_date, substr(forecast_date, 1, 7) || '-01' AS period FROM nul", "nul"))
def period_derive(spark, sf):
    return clean.derive_period(standardized(spark, sf)).select(*SRC_IDS, "forecast_date", "period")


@query(with_parts(f"SELECT {SRC_ID}, forecast_date, forecast_date AS period FROM nul", "nul"))
def period_plain(spark, sf):
    rows = clean.derive_period(standardized(spark, sf), apply_concat=False)
    return rows.select(*SRC_IDS, "forecast_date", "period")


# ---------------------------------------------------------------- filters


@query(with_parts("SELECT * REPLACE (CAST(_ingestion_ts AS VARCHAR) AS _ingestion_ts) FROM src"
                  " WHERE _batch_id = 'b2'", "src"))
def current_batch(spark, sf):
    return clean.current_batch(fixture.forecast_src(spark, sf), "b2")


@query(with_parts(
    f"SELECT {KEY}, {real(QTY, REV)}, CAST(effective_from AS VARCHAR) AS effective_from FROM history"
    " WHERE is_active".replace("forecast_date,", "CAST(forecast_date AS VARCHAR) AS forecast_date,", 1), "history"))
def active_versions(spark, sf):
    return clean.active_versions(silver_history(spark, sf)).select(*schema.MATCH_KEY, QTY, REV, "effective_from")


@query(with_parts(
    f"SELECT {ID_SQL}, CAST(_ingestion_ts AS VARCHAR) AS _ingestion_ts FROM src"
    " WHERE CAST(_ingestion_ts AS DATE) = DATE '1998-06-15'", "src"))
def loaded_today(spark, sf):
    return kpi.loaded_on(fixture.forecast_src(spark, sf), datetime(1998, 6, 15, 9)).select(
        *ID_COLUMNS, "_ingestion_ts")


# ---------------------------------------------------------------- data quality


@query(with_parts(f"SELECT {strings()}, {ID_SQL} FROM src WHERE {KEYS_PRESENT}", "src"))
def not_null_valid(spark, sf):
    return quality.validate_not_null(fixture.forecast_src(spark, sf), schema.BUSINESS_KEY)[0].select(
        *schema.SOURCE_COLUMNS, *ID_COLUMNS)


@query(with_parts(f"SELECT {strings()}, {ID_SQL} FROM src WHERE NOT coalesce({KEYS_PRESENT}, false)", "src"))
def not_null_invalid(spark, sf):
    return quality.validate_not_null(fixture.forecast_src(spark, sf), schema.BUSINESS_KEY)[1].select(
        *schema.SOURCE_COLUMNS, *ID_COLUMNS)


@query(with_parts(f"SELECT {strings()}, {ID_SQL} FROM valid WHERE {CASTABLE}", "valid"))
def type_valid(spark, sf):
    return castable_rows(spark, sf).select(*schema.SOURCE_COLUMNS, *ID_COLUMNS)


@query(with_parts(f"SELECT {strings()}, {ID_SQL} FROM valid WHERE NOT ({CASTABLE})", "valid"))
def type_invalid(spark, sf):
    return quality.validate_data_types(valid_rows(spark, sf), schema.TYPED_COLUMNS)[1].select(
        *schema.SOURCE_COLUMNS, *ID_COLUMNS)


_ASC = ", ".join(f"{c} ASC NULLS FIRST" for c in fixture.LATEST_ORDER)
_DESC = ", ".join(f"{c} DESC NULLS LAST" for c in fixture.LATEST_ORDER)


def _ranked_sql(order: str, keep: str) -> str:
    return with_parts(
        f"SELECT {strings()}, {ID_SQL} FROM (SELECT *, row_number() OVER (PARTITION BY _batch_id, {KEY}"
        f" ORDER BY {order}) AS rn FROM valid) WHERE rn {keep}", "valid")


@query(_ranked_sql(_ASC, "= 1"))
def dedup_first(spark, sf):
    rows, _ = quality_duplicates(valid_rows(spark, sf), "first")
    return rows.select(*schema.SOURCE_COLUMNS, *ID_COLUMNS)


@query(_ranked_sql(_DESC, "= 1"))
def dedup_latest(spark, sf):
    return dedup.dedup_latest(valid_rows(spark, sf), BATCH_KEY, fixture.LATEST_ORDER).select(
        *schema.SOURCE_COLUMNS, *ID_COLUMNS)


@query(_ranked_sql(_DESC, "> 1"))
def duplicates(spark, sf):
    _, rest = quality_duplicates(valid_rows(spark, sf), "latest")
    return rest.select(*schema.SOURCE_COLUMNS, *ID_COLUMNS)


@query(_ranked_sql(_ASC, "> 1"))
def duplicates_after_first(spark, sf):
    _, rest = quality_duplicates(valid_rows(spark, sf), "first")
    return rest.select(*schema.SOURCE_COLUMNS, *ID_COLUMNS)


def quality_duplicates(df: DataFrame, keep: str) -> tuple[DataFrame, DataFrame]:
    return dedup.validate_duplicates(df, BATCH_KEY, fixture.LATEST_ORDER, keep)


@query(with_parts(
    "SELECT reason AS _dq_fail_reason, _batch_id, _frequency, count(*) AS n FROM ("
    f"SELECT 'NULL_PK' AS reason, _batch_id, _frequency FROM nul WHERE NOT coalesce({KEYS_PRESENT}, false)"
    f" UNION ALL SELECT 'TYPE_ERROR', _batch_id, _frequency FROM valid WHERE NOT ({CASTABLE})) GROUP BY ALL",
    "valid"))
def quarantine_by_reason(spark, sf):
    valid, no_key = quality.validate_not_null(standardized(spark, sf), schema.BUSINESS_KEY)
    _, no_type = quality.validate_data_types(valid, schema.TYPED_COLUMNS)
    rejected = quality.quarantine(no_key, "NULL_PK").unionByName(quality.quarantine(no_type, "TYPE_ERROR"))
    return rejected.groupBy("_dq_fail_reason", "_batch_id", "_frequency").agg(F.count(F.lit(1)).alias("n"))


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


_CATEGORIES, _CURRENCIES = _quoted(schema.VALID_CATEGORIES), _quoted(schema.VALID_CURRENCIES)
_RULES_SQL = {
    "CATEGORY_VALIDATION": ("category", f"category NOT IN ({_CATEGORIES})"),
    "CURRENCY_VALIDATION": ("currency", f"currency NOT IN ({_CURRENCIES})"),
    "RANGE_CHECK": ("forecast_qty", "forecast_qty < 0"),
}


def _rule_sql(check: str) -> str:
    column, bad = _RULES_SQL[check]
    return (f"SELECT '{check}' AS check_type, '{column}' AS column_name, count(*) AS records_checked,"
            f" count(*) FILTER (WHERE {bad}) AS records_failed FROM clean")


def _one_rule(spark: SparkSession, sf: str, index: int) -> DataFrame:
    return quality.count_violations(clean_rows(spark, sf), [quality.business_rules()[index]])


@query(with_parts(_rule_sql("CATEGORY_VALIDATION"), "clean"))
def allowed_category(spark, sf):
    return _one_rule(spark, sf, 0)


@query(with_parts(_rule_sql("CURRENCY_VALIDATION"), "clean"))
def allowed_currency(spark, sf):
    return _one_rule(spark, sf, 1)


@query(with_parts(_rule_sql("RANGE_CHECK"), "clean"))
def negative_qty(spark, sf):
    return _one_rule(spark, sf, 2)


@query(with_parts(
    "SELECT " + SRC_ID + ", concat_ws(',', " + ", ".join(
        f"CASE WHEN {bad} THEN '{check}' END" for check, (_, bad) in _RULES_SQL.items())
    + ") AS dq_flags FROM clean", "clean"))
def dq_flags(spark, sf):
    flagged = quality.flag_violations(clean_rows(spark, sf), quality.business_rules())
    return flagged.select(*SRC_IDS, F.concat_ws(",", "_dq_flags").alias("dq_flags"))


@query(with_parts(
    "SELECT *, CASE WHEN records_failed = 0 THEN 'PASSED' ELSE 'FAILED' END AS check_status, 'run-1' AS batch_id,"
    " 'silver' AS table_name, CAST(NULL AS VARCHAR) AS error_message, '1998-07-01 06:00:00' AS created_ts FROM ("
    + " UNION ALL ".join(_rule_sql(c) for c in _RULES_SQL) + ")", "clean"))
def dq_log(spark, sf):
    counts = quality.count_violations(clean_rows(spark, sf), quality.business_rules())
    return quality.dq_log_rows(counts, batch_id="run-1", table_name="silver", created_ts=FIRST_TS)


_RATE = ("CAST(CAST(CASE WHEN sum(records_checked) > 0 THEN (1.0 - CAST(sum(records_failed) AS DOUBLE)"
         " / sum(records_checked)) * 100 ELSE 100 END AS DECIMAL(5,2)) AS DOUBLE) AS pass_rate_pct")


@query(with_parts(
    "SELECT CAST(CAST(created_ts AS DATE) AS VARCHAR) AS check_date, table_name, check_type,"
    " CAST(sum(records_checked) AS BIGINT) AS total_checked, CAST(sum(records_failed) AS BIGINT) AS total_failed,"
    f" {_RATE} FROM dq GROUP BY CAST(created_ts AS DATE), table_name, check_type", "dq"))
def dq_summary(spark, sf):
    return quality.dq_summary(fixture.dq_log(spark, sf))


@query(with_parts(
    "SELECT batch_id, table_name, check_type, CAST(sum(records_checked) AS BIGINT) AS records_checked,"
    " CAST(sum(records_failed) AS BIGINT) AS records_failed,"
    f" CAST(sum(records_checked) - sum(records_failed) AS BIGINT) AS records_passed, {_RATE}"
    " FROM dq GROUP BY batch_id, table_name, check_type", "dq"))
def dq_by_batch(spark, sf):
    return quality.dq_by_batch(fixture.dq_log(spark, sf))


@query(with_parts(
    "SELECT batch_id, table_name, check_type, column_name, CAST(records_checked AS BIGINT) AS records_checked,"
    " CAST(records_failed AS BIGINT) AS records_failed FROM dq"
    " WHERE 1.0 - CAST(records_failed AS DOUBLE) / records_checked < 0.95", "dq"))
def threshold_gate(spark, sf):
    return quality.below_threshold(fixture.dq_log(spark, sf), 0.95).drop("check_status", "created_ts")


@query(with_parts(
    "SELECT batch_id, count(*) FILTER (WHERE source_row_count <> target_row_count + error_record_count) AS"
    " unbalanced_layers, CAST(sum(target_row_count) FILTER (WHERE data_layer = 'SILVER') AS BIGINT) AS silver_rows,"
    " CAST(sum(target_row_count) FILTER (WHERE data_layer = 'GOLD') AS BIGINT) AS gold_rows,"
    " silver_rows = gold_rows AS gold_matches_silver FROM audit GROUP BY batch_id", "audit"))
def reconcile_layers(spark, sf):
    return monitor.reconcile(fixture.audit_log(spark, sf))


@query(with_parts(f"SELECT {KEY}, count(*) AS cnt FROM valid GROUP BY {KEY} HAVING count(*) > 1", "valid"))
def duplicate_keys(spark, sf):
    return quality.duplicate_keys(valid_rows(spark, sf))


@query(with_parts(
    "SELECT category, count(*) AS n FROM src WHERE category <> upper(category) GROUP BY category", "src"))
def mixed_case(spark, sf):
    return quality.mixed_case(fixture.forecast_src(spark, sf)).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


@query(with_parts(
    "SELECT 'mixed_case' AS assertion, count(*) AS violations FROM clean WHERE category <> upper(category)"
    f" UNION ALL SELECT 'duplicate_key', count(*) FROM (SELECT 1 FROM clean GROUP BY _batch_id, {KEY}"
    " HAVING count(*) > 1) UNION ALL SELECT 'null_key', count(*) FROM clean WHERE product_id IS NULL"
    " OR location_id IS NULL OR forecast_date IS NULL UNION ALL SELECT 'bad_currency_kept', count(*)"
    " FROM clean WHERE currency = 'XX'", "clean"))
def silver_assertions(spark, sf):
    rows = clean_rows(spark, sf)
    counts = {
        "mixed_case": F.col("category") != F.upper("category"),
        "null_key": functools.reduce(Column.__or__, [F.col(c).isNull() for c in schema.BUSINESS_KEY]),
        "bad_currency_kept": F.col("currency") == "XX",
    }
    # One pass: rows per key first, which tells duplicate keys, then all sums.
    per_key = rows.groupBy(*BATCH_KEY).agg(F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(name) for name, c in counts.items()])
    totals = per_key.agg(F.count_if(F.col("n") > 1).alias("duplicate_key"), *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in counts])
    return totals.unpivot([], ["mixed_case", "duplicate_key", "null_key", "bad_currency_kept"], "assertion", "violations")


@query(
    "SELECT CAST(max(o_orderdate) AS VARCHAR) AS last_load_ts,"
    f" max(o_orderdate) < TIMESTAMP '{fixture.AS_OF}' - INTERVAL 24 HOUR AS is_stale FROM orders")
def freshness(spark, sf):
    return monitor.freshness(fixture.table(spark, sf, "orders"), "o_orderdate", 24, as_of())


@query(with_parts(
    "SELECT object_name, batch_id, CAST(job_start_ts AS VARCHAR) AS job_start_ts, target_row_count, previous_rows"
    " FROM (SELECT *, lag(target_row_count) OVER (PARTITION BY object_name ORDER BY job_start_ts, batch_id) AS"
    " previous_rows FROM audit) WHERE target_row_count < previous_rows * 0.8", "audit"))
def volume_drop(spark, sf):
    return monitor.volume_drop(fixture.audit_log(spark, sf), 20).select(
        "object_name", "batch_id", "job_start_ts", "target_row_count", "previous_rows")


# ---------------------------------------------------------------- aggregates and reshape


@query(with_parts(
    "SELECT period, category, region, _frequency, count(*) AS no_of_records,"
    f" CAST(sum({QTY}) AS DOUBLE) AS {QTY}, CAST(sum({REV}) AS DOUBLE) AS {REV} FROM clean"
    " GROUP BY period, category, region, _frequency", "clean"))
def period_agg(spark, sf):
    return kpi.period_aggregate(clean_rows(spark, sf))


def _by_file_sql(metric: str) -> str:
    return (f"SELECT _file_name AS file_name, count(*) AS no_of_records, CAST(max(_ingestion_ts) AS VARCHAR) AS"
            f" load_date, '{metric}' AS keyfigure, CAST(sum({metric}) AS DOUBLE) AS total_qty_amount"
            " FROM clean GROUP BY _file_name")


@query(with_parts(f"{_by_file_sql(QTY)} UNION ALL {_by_file_sql(REV)}", "clean"))
def kpi_by_file(spark, sf):
    return kpi.kpi_rows(clean_rows(spark, sf), ["_file_name"], [*schema.METRICS, "no_such_metric"])


@query(with_parts(
    "SELECT _file_name AS file_name, count(*) AS no_of_records, CAST(max(_ingestion_ts) AS VARCHAR) AS load_date,"
    " '' AS keyfigure, CAST(NULL AS DOUBLE) AS total_qty_amount, 'fc_daily' AS data_subject, 'job-1' AS ld_jb_nr,"
    " 'run-1' AS _batch_id, '1998-07-01 06:00:00' AS ins_gmt_ts FROM clean GROUP BY _file_name", "clean"))
def kpi_count_only(spark, sf):
    rows = kpi.kpi_rows(clean_rows(spark, sf), ["_file_name"], kpi.parse_list(""))
    return kpi.stamp_kpi(rows, data_subject="fc_daily", ld_jb_nr="job-1", batch_id="run-1", ins_ts=FIRST_TS)


@query(with_parts(
    f"SELECT 'forecast_qty' AS keyfigure, CAST(sum({QTY}) AS DOUBLE) AS total_qty_amount FROM clean"
    f" UNION ALL SELECT 'revenue_amount', CAST(sum({REV}) AS DOUBLE) FROM clean", "clean"))
def keyfigure_total(spark, sf):
    # The total per key figure comes from the per-file rows; the decimals are whole cents and units.
    rows = kpi.kpi_rows(clean_rows(spark, sf), ["_file_name"], schema.METRICS)
    exact = rows.withColumn("total_qty_amount", F.col("total_qty_amount").cast("decimal(28,4)"))
    return kpi.keyfigure_total(exact)


@query(with_parts(
    "SELECT 'category' AS attribute, category AS member, count(*) AS n FROM clean GROUP BY category UNION ALL"
    " SELECT 'currency', currency, count(*) FROM clean GROUP BY currency UNION ALL"
    " SELECT 'channel', channel, count(*) FROM clean GROUP BY channel", "clean"))
def distinct_values(spark, sf):
    pairs = clean_rows(spark, sf).unpivot([], ["category", "currency", "channel"], "attribute", "member")
    return pairs.groupBy("attribute", "member").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- extracts


@query(
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate,"
    f" o_orderpriority FROM orders WHERE o_orderdate > TIMESTAMP '{STALE_MARK}'")
def incremental_extract(spark, sf):
    return extract.incremental_extract(fixture.table(spark, sf, "orders"), "o_orderdate", STALE_MARK)


@query(
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate,"
    " o_orderpriority FROM orders")
def full_extract(spark, sf):
    return extract.full_extract(fixture.table(spark, sf, "orders"))


@query(
    "SELECT 'above mark' AS extract, CAST(max(o_orderdate) AS VARCHAR) AS new_watermark, count(*) AS n FROM orders"
    f" WHERE o_orderdate > TIMESTAMP '{STALE_MARK}' UNION ALL SELECT 'second run', CAST(NULL AS VARCHAR),"
    " count(*) FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders)")
def watermark_advance(spark, sf):
    orders = fixture.table(spark, sf, "orders")
    first = extract.incremental_extract(orders, "o_orderdate", STALE_MARK)
    mark = extract.extracted_mark(first, "o_orderdate").first().new_watermark
    second = extract.incremental_extract(orders, "o_orderdate", mark)

    def report(name: str, rows: DataFrame) -> DataFrame:
        return rows.agg(F.max("o_orderdate").cast("string").alias("new_watermark"), F.count(F.lit(1)).alias("n")
                        ).withColumn("extract", F.lit(name))

    return report("above mark", first).unionByName(report("second run", second))


@query(
    "SELECT 'lineitem.parquet' AS _file_name, count(*) AS n FROM lineitem UNION ALL"
    " SELECT 'orders.parquet', count(*) FROM orders")
def file_provenance(spark, sf):
    def count(name: str) -> DataFrame:
        return with_file_name(fixture.table(spark, sf, name)).groupBy("_file_name").agg(F.count(F.lit(1)).alias("n"))

    return count("lineitem").unionByName(count("orders"))


# ---------------------------------------------------------------- history, dimensions, fact

_VERSION_SQL = (
    "product_id, location_id, CAST(forecast_date AS VARCHAR) AS forecast_date, _frequency, customer_id, channel,"
    f" category, sub_category, region, country, currency, {real(QTY, REV)},"
    f" {text('effective_from', 'effective_to')}, is_active"
)
_VERSION_COLUMNS = [*schema.MATCH_KEY, "customer_id", "channel", "category", "sub_category", "region", "country",
                    "currency", QTY, REV, "effective_from", "effective_to", "is_active"]


@query(with_parts(f"SELECT {_VERSION_SQL} FROM history", "history"))
def scd2_silver(spark, sf):
    return silver_history(spark, sf).select(*_VERSION_COLUMNS)


@query(with_parts(f"SELECT {_VERSION_SQL} FROM history", "history"))
def scd2_repeat(spark, sf):
    """Merging the second batch a second time, a day later, changes nothing."""
    later = date(1998, 12, 2)
    merged = scd2.scd2_merge(
        silver_history(spark, sf), batch_two(spark, sf), schema.MATCH_KEY, schema.TRACKED, later)
    return merged.select(*_VERSION_COLUMNS)


@query(with_parts(
    f"SELECT 'CHANGED' AS action, count(*) AS n FROM batch1 a JOIN batch2 b ON {matches('a', 'b')}"
    f" WHERE {differs('a', 'b')} UNION ALL SELECT 'SAME', count(*) FROM batch1 a JOIN batch2 b ON"
    f" {matches('a', 'b')} WHERE NOT {differs('a', 'b')} UNION ALL SELECT 'NEW', count(*) FROM batch2 b"
    f" WHERE NOT EXISTS (SELECT 1 FROM batch1 a WHERE {matches('a', 'b')}) UNION ALL SELECT 'ABSENT', count(*)"
    f" FROM batch1 a WHERE NOT EXISTS (SELECT 1 FROM batch2 b WHERE {matches('a', 'b')})", "batch1", "batch2"))
def scd2_actions(spark, sf):
    opened = scd2.open_all(batch_one(spark, sf), FIRST)
    return scd2.scd2_actions(opened, batch_two(spark, sf), schema.MATCH_KEY, schema.TRACKED)


@query(with_parts(
    "SELECT 'versions' AS measure, count(*) AS n FROM history UNION ALL SELECT 'keys', count(*) FROM"
    f" (SELECT DISTINCT {KEY} FROM history) UNION ALL SELECT 'violations', 0", "history"))
def scd2_invariants(spark, sf):
    per_key = scd2.scd2_key_report(silver_history(spark, sf), schema.MATCH_KEY)
    totals = per_key.agg(
        F.sum("versions").alias("versions"), F.count(F.lit(1)).alias("keys"),
        F.sum(F.size("problems")).alias("violations"))
    return totals.unpivot([], ["versions", "keys", "violations"], "measure", "n")


@query(with_parts(
    f"SELECT product_key, product_id, category, sub_category, is_active, {text('effective_from', 'effective_to')}"
    " FROM dim_product", "dim_product"))
def dim_product(spark, sf):
    return _history_of(spark, sf, "product").drop("product_name", "_load_ts")


@query(with_parts(
    f"SELECT location_key, location_id, region, country, is_active, {text('effective_from', 'effective_to')}"
    " FROM dim_location", "dim_location"))
def dim_location(spark, sf):
    return _history_of(spark, sf, "location").drop("city", "_load_ts")


def _dim_time_sql(source: str, month_shift: int = 0) -> str:
    fiscal = f"(d + INTERVAL {month_shift} MONTH)"
    return (
        "SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS time_key, CAST(d AS VARCHAR) AS date_key,"
        " CAST(year(d) AS INT) AS year, CAST(quarter(d) AS INT) AS quarter, CAST(month(d) AS INT) AS month,"
        " monthname(d) AS month_name, CAST(weekofyear(d) AS INT) AS week_of_year,"
        " CAST(isodow(d) AS INT) AS day_of_week, dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend,"
        f" CAST(year({fiscal}) AS INT) AS fiscal_year, CAST(quarter({fiscal}) AS INT) AS fiscal_quarter,"
        f" strftime(d, '%Y-%m') || '-01' AS period FROM ({source})"
    )


@query(_dim_time_sql("SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem"))
def dim_time(spark, sf):
    return star.build_dim_time(fixture.table(spark, sf, "lineitem"), "l_shipdate")


@query(_dim_time_sql("SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderdate IS NOT NULL", 6))
def dim_time_fiscal_july(spark, sf):
    return star.build_dim_time(fixture.table(spark, sf, "orders"), "o_orderdate", fiscal_start_month=7)


@query(_dim_time_sql(
    "SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem EXCEPT SELECT CAST(o_orderdate AS DATE) FROM orders"))
def dim_time_missing(spark, sf):
    held = star.build_dim_time(fixture.table(spark, sf, "orders"), "o_orderdate")
    return star.missing_dates(star.build_dim_time(fixture.table(spark, sf, "lineitem"), "l_shipdate"), held)


_FACT_SQL = (
    "product_key, location_key, time_key, product_id, location_id, CAST(forecast_date AS VARCHAR) AS forecast_date,"
    f" customer_id, channel, category, region, currency, period, _frequency, {real(QTY, REV)}"
)
_FACT_COLUMNS = ["product_key", "location_key", "time_key", "product_id", "location_id", "forecast_date",
                 "customer_id", "channel", "category", "region", "currency", "period", "_frequency", QTY, REV]


def stored_batches(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Both cleaned batches, written once, as dimensions, calendar and fact each read them."""
    root = work_path(spark, "batches")
    return stage_rows(batch_one(spark, sf), f"{root}/one"), stage_rows(batch_two(spark, sf), f"{root}/two")


def all_facts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(facts, products, locations) after both batches: the second adds the keys that the fact does not hold."""
    one, two = stored_batches(spark, sf)
    dims = {}
    for kind in ("product", "location"):
        first = _dimension(None, one, kind, FIRST, FIRST_TS)
        dims[kind] = first, stage_rows(_dimension(first, two, kind, SECOND, SECOND_TS), work_path(spark, f"dim-{kind}"))
    calendar = star.build_dim_time(one.select("forecast_date").unionByName(two.select("forecast_date")))
    facts = star.build_fact(one, dims["product"][0], dims["location"][0], calendar)
    added = star.new_fact_rows(star.build_fact(two, dims["product"][1], dims["location"][1], calendar), one)
    return facts.unionByName(added), dims["product"][1], dims["location"][1]


@query(with_parts(f"SELECT {_FACT_SQL} FROM facts", "facts"))
def fact_build(spark, sf):
    return all_facts(spark, sf)[0].select(*_FACT_COLUMNS)


@query(with_parts(
    "SELECT count(*) AS fact_rows, count_if(product_id NOT IN (SELECT product_id FROM prod1)) AS no_product,"
    " count_if(location_id NOT IN (SELECT location_id FROM loc1 WHERE location_id NOT LIKE '%3')) AS no_location,"
    " count_if(forecast_date NOT IN (SELECT forecast_date FROM batch1 WHERE day(forecast_date) <> 13)) AS no_time"
    " FROM (SELECT * FROM batch1 UNION ALL BY NAME SELECT * FROM batch2)", "batch1", "batch2", "prod1", "loc1"))
def fact_unmatched(spark, sf):
    """Both batches against the first one's products, a part of its locations, and a calendar that lacks each 13th."""
    one, two = stored_batches(spark, sf)
    products = _dimension(None, one, "product", FIRST, FIRST_TS)
    locations = _dimension(None, one, "location", FIRST, FIRST_TS).filter("location_id NOT LIKE '%3'")
    calendar = star.build_dim_time(one.filter("day(forecast_date) <> 13"))
    return star.unmatched_keys(star.build_fact(one.unionByName(two), products, locations, calendar))


@query(with_parts(
    "SELECT " + ", ".join(["product_id", "location_id", "CAST(forecast_date AS VARCHAR) AS forecast_date", "channel",
                           "_frequency", real(QTY, REV)])
    + " FROM batch2 b WHERE NOT EXISTS (SELECT 1 FROM batch1 a WHERE " + matches("a", "b")
    + " AND a.channel = b.channel)", "batch1", "batch2"))
def fact_insert_only(spark, sf):
    rows = star.new_fact_rows(batch_two(spark, sf), batch_one(spark, sf))
    return rows.select(*schema.FACT_KEY, QTY, REV)


@query(with_parts(
    "SELECT p.category AS dim_category, p.sub_category AS dim_sub_category, l.region AS dim_region,"
    " l.country AS dim_country, f.period, f._frequency, count(*) AS n,"
    f" CAST(sum(f.{QTY}) AS DOUBLE) AS {QTY} FROM facts f JOIN dim_product p ON f.product_key = p.product_key"
    " JOIN dim_location l ON f.location_key = l.location_key GROUP BY ALL", "facts"))
def star_join(spark, sf):
    return star.star_join(*all_facts(spark, sf)).groupBy(
        "dim_category", "dim_sub_category", "dim_region", "dim_country", "period", "_frequency"
    ).agg(F.count(F.lit(1)).alias("n"), F.sum(QTY).alias(QTY))


@query(with_parts(
    f"SELECT {', '.join('c.' + i for i in SRC_IDS)}, CAST(c.forecast_date AS VARCHAR) AS forecast_date,"
    " p.product_key, p.category AS version_category FROM clean c LEFT JOIN dim_product p"
    " ON c.product_id = p.product_id AND p.effective_from <= c.forecast_date"
    " AND (p.effective_to IS NULL OR c.forecast_date < p.effective_to)", "clean", "dim_product"))
def as_of_join(spark, sf):
    history = stage_rows(_history_of(spark, sf, "product"), work_path(spark, "as-of"))  # read by both sides of the sweep
    versions = history.withColumn("version_category", F.col("category"))
    facts = stage_rows(clean_rows(spark, sf).select(*SRC_IDS, "product_id", "forecast_date"), work_path(spark, "as-of-facts"))
    rows = scd2.lookup_as_of(facts, versions, "product_id", "forecast_date", ["product_key", "version_category"])
    return rows.select(*SRC_IDS, "forecast_date", "product_key", "version_category")


@query(
    "SELECT p_partkey, CAST('0x' || substr(md5(concat_ws('|', CAST(p_partkey AS VARCHAR), p_brand)), 1, 15) AS BIGINT)"
    " AS part_key FROM part")
def surrogate_keys(spark, sf):
    parts = fixture.table(spark, sf, "part")
    return parts.select("p_partkey", surrogate_key(F.col("p_partkey"), F.col("p_brand")).alias("part_key"))


# ---------------------------------------------------------------- run log


@query(with_parts(
    "SELECT _batch_id, count(*) AS n FROM (SELECT concat('b', CAST(CAST(floor(l_orderkey / 4.0) AS BIGINT) AS"
    " VARCHAR)) AS _batch_id FROM lineitem) WHERE _batch_id NOT IN (SELECT DISTINCT batch_id FROM audit"
    " WHERE data_layer = 'BRONZE' AND job_status = 'SUCCESS') GROUP BY _batch_id", "audit"))
def batch_guard(spark, sf):
    """Rows per batch that Bronze has not loaded, each line belonging to its order's batch."""
    log = fixture.audit_log(spark, sf).withColumnsRenamed({"data_layer": "layer", "job_status": "status"})
    lines = fixture.table(spark, sf, "lineitem").select(
        F.concat(F.lit("b"), F.floor(F.col("l_orderkey") / 4).cast("string")).alias("_batch_id"))
    rows = monitor.batches_not_loaded(lines, log, "BRONZE")
    return rows.groupBy("_batch_id").agg(F.count(F.lit(1)).alias("n"))


_RUN_SQL = (
    "batch_id, object_name, data_layer, job_status, CAST(source_row_count AS BIGINT) AS source_row_count,"
    " CAST(target_row_count AS BIGINT) AS target_row_count, CAST(error_record_count AS BIGINT) AS"
    f" error_record_count, job_duration_sec, {text('job_start_ts', 'job_end_ts')}, source_system"
)
_SINCE = f"TIMESTAMP '{fixture.AS_OF}' - INTERVAL {{}} DAY"


@query(with_parts(f"SELECT {_RUN_SQL} FROM audit WHERE job_start_ts >= {_SINCE.format(7)}", "audit"))
def latest_runs(spark, sf):
    return monitor.latest_runs(fixture.audit_log(spark, sf), as_of())


@query(with_parts(
    "SELECT CAST(CAST(job_start_ts AS DATE) AS VARCHAR) AS load_date, data_layer, count(*) AS total_jobs,"
    " count(*) FILTER (WHERE job_status = 'SUCCESS') AS success_count,"
    " count(*) FILTER (WHERE job_status = 'FAILED') AS failed_count,"
    " CAST(sum(source_row_count) AS BIGINT) AS total_source_rows,"
    " CAST(sum(target_row_count) AS BIGINT) AS total_target_rows,"
    " CAST(sum(error_record_count) AS BIGINT) AS total_error_rows,"
    " CAST(sum(job_duration_sec) AS DOUBLE) / count(*) AS avg_duration_sec"
    " FROM audit GROUP BY CAST(job_start_ts AS DATE), data_layer", "audit"))
def daily_load_summary(spark, sf):
    return monitor.daily_load_summary(fixture.audit_log(spark, sf))


@query(with_parts(
    "SELECT batch_id, data_subject, object_name AS table_name, data_layer, job_status,"
    " CAST(target_row_count AS BIGINT) AS target_row_count, job_duration_sec,"
    " 'forecast_qty,revenue_amount' AS keyfigures FROM audit WHERE data_layer = 'GOLD'", "audit"))
def aggregated_audit(spark, sf):
    active = config.default_subjects(spark).filter("is_active")
    return monitor.aggregated_audit(fixture.audit_log(spark, sf), active).select(
        "batch_id", "data_subject", "table_name", "data_layer", "job_status", "target_row_count",
        "job_duration_sec", "keyfigures")


@query(with_parts(
    f"SELECT {_RUN_SQL}, data_subject FROM audit WHERE job_status = 'FAILED' AND job_start_ts >= {_SINCE.format(7)}",
    "audit"))
def failed_runs(spark, sf):
    return monitor.failed_runs(fixture.audit_log(spark, sf), as_of())


@query(with_parts(
    f"SELECT {_RUN_SQL}, data_subject FROM audit WHERE CAST(job_start_ts AS DATE) = CAST(TIMESTAMP"
    f" '{fixture.AS_OF}' AS DATE)", "audit"))
def runs_today(spark, sf):
    return monitor.runs_today(fixture.audit_log(spark, sf), as_of())


@query(with_parts(f"SELECT {_RUN_SQL}, data_subject FROM audit WHERE batch_id = 'b1000'", "audit"))
def batch_layers(spark, sf):
    return monitor.batch_layers(fixture.audit_log(spark, sf), "b1000")


@query(with_parts(
    f"SELECT {_RUN_SQL}, data_subject FROM (SELECT *, row_number() OVER (PARTITION BY object_name, data_layer"
    " ORDER BY job_end_ts DESC, job_start_ts DESC, batch_id DESC) AS rn FROM audit) WHERE rn = 1", "audit"))
def latest_status(spark, sf):
    return monitor.latest_status(fixture.audit_log(spark, sf))


@query(with_parts(
    "SELECT batch_id, object_name, data_layer, CAST(job_start_ts AS VARCHAR) AS job_start_ts,"
    " CAST(job_end_ts + INTERVAL 1 HOUR AS VARCHAR) AS job_end_ts, 'SUCCESS' AS job_status,"
    " CAST(source_row_count AS BIGINT) AS source_row_count, CAST(target_row_count + 1 AS BIGINT) AS target_row_count,"
    " CAST(error_record_count AS BIGINT) AS error_record_count,"
    " CAST(job_duration_sec + 3600 AS BIGINT) AS job_duration_sec FROM audit", "audit"))
def status_update(spark, sf):
    """Every entry gets a later status that leaves two of its counts as they were."""
    log = fixture.audit_log(spark, sf).withColumn("updated_ts", F.col("job_end_ts"))
    log = log.drop("job_duration_sec", "source_system", "data_subject")
    later = F.col("job_end_ts") + F.expr("INTERVAL 1 HOUR")
    updates = log.withColumns({
        "updated_ts": later, "job_end_ts": later, "job_status": F.lit("SUCCESS"),
        "target_row_count": F.col("target_row_count") + 1, "job_start_ts": F.lit(None).cast("timestamp_ntz"),
        "source_row_count": F.lit(None).cast("bigint"), "error_record_count": F.lit(None).cast("bigint"),
    })
    return monitor.merge_status_updates(log.unionByName(updates))


@query(with_parts(
    "SELECT batch_id, CAST(count(DISTINCT data_layer) AS INT) AS layers,"
    " count(*) FILTER (WHERE job_status <> 'SUCCESS') AS not_successful,"
    " count(DISTINCT data_layer) = 4 AND count(*) FILTER (WHERE job_status <> 'SUCCESS') = 0 AS is_complete"
    " FROM audit GROUP BY batch_id", "audit"))
def batch_complete(spark, sf):
    return monitor.batch_complete(fixture.audit_log(spark, sf))


@query(with_parts(
    "SELECT CAST(CAST(job_start_ts AS DATE) AS VARCHAR) AS load_date, data_layer,"
    " CAST(sum(target_row_count) AS BIGINT) AS rows_loaded FROM audit WHERE job_status = 'SUCCESS'"
    f" AND job_start_ts >= {_SINCE.format(30)} GROUP BY CAST(job_start_ts AS DATE), data_layer", "audit"))
def volume_trend(spark, sf):
    return monitor.volume_trend(fixture.audit_log(spark, sf), as_of())


@query(with_parts(
    f"SELECT {strings()}, {ID_SQL}, 'NULL_PK' AS _dq_fail_reason FROM nul"
    f" WHERE _batch_id = 'b1' AND NOT coalesce({KEYS_PRESENT}, false)"
    f" ORDER BY _ingestion_ts DESC, {SRC_ID} LIMIT 100", "nul"))
def quarantine_sample(spark, sf):
    rejected = quality.quarantine(
        quality.validate_not_null(standardized(spark, sf), schema.BUSINESS_KEY)[1], "NULL_PK")
    newest = [F.col("_ingestion_ts").desc(), *[F.col(c) for c in SRC_IDS]]
    return monitor.quarantine_sample(rejected, "b1", newest).select(
        *schema.SOURCE_COLUMNS, *ID_COLUMNS, "_dq_fail_reason")


@query(with_parts(
    "SELECT column_name, count(*) AS n FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name FROM src WHERE {c} IS NULL OR trim({c}) = ''" for c in schema.SOURCE_COLUMNS)
    + ") GROUP BY column_name", "src"))
def blank_counts(spark, sf):
    rules = [quality.Rule("NULL_CHECK", c, is_blank(F.col(c))) for c in schema.SOURCE_COLUMNS]
    counts = quality.count_violations(fixture.forecast_src(spark, sf), rules)
    return counts.filter("records_failed > 0").select("column_name", F.col("records_failed").alias("n"))
