"""Queries that go through tables, files and streams: sinks, layer jobs and streaming ingest."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import suppress
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import fixture, schema
from strata.operators import clean, monitor
from strata.operators.quality import QualityGateError, validate_data_types
from strata.operators.scd2 import open_all, scd2_violations
from strata.plans.bronze import load_bronze
from strata.plans.contract import contract_differences
from strata.plans.extract import extract_to_landing
from strata.plans.gold import archive_facts_before
from strata.plans.oracle import FIRST_DAY, SECOND_DAY, STALE_MARK, matches, real, strings, text, with_parts
from strata.plans.queries import (
    ID_COLUMNS, ID_SQL, QTY, REV, SRC_ID, SRC_IDS, all_facts, batch_one, batch_two, clean_rows,
    valid_rows,
)
from strata.plans.registry import query
from strata.plans.run import Job, Run
from strata.plans.silver import bronze_batch, silver_rows
from strata.plans.subject import run_steps, run_subject
from strata.sources import extract, sinks
from strata.sources.config import default_subjects, get_pipeline_metadata
from strata.sources.files import has_source, read_delimited, read_parquet_as_strings
from strata.sources.staging import stage_rows
from strata.sources.versions import write_version
from strata.streaming.ingest import create_key_table, land_new_keys, landing_files, stream_layers
from strata.session import work_path

FREQUENCIES = ["daily", "weekly", "monthly", "quarterly"]
RUNS = {
    "run-1": datetime(1998, 7, 1, 6, tzinfo=timezone.utc),
    "run-2": datetime(1998, 12, 1, 6, tzinfo=timezone.utc),
}
_SRC_COLUMNS = [*schema.SOURCE_COLUMNS, *ID_COLUMNS]


def new_database(spark: SparkSession) -> str:
    name = f"strata_{uuid.uuid4().hex[:10]}"
    schema.ensure_tables(spark, name, work_path(spark, name))
    sinks.replace_small(default_subjects(spark), f"{name}.pipeline_metadata")
    return name


def landing_rows(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """What each run's extract delivers: the first batch, then everything above a stale mark.

    Views of the stored forecast rows: what lands is filtered by its scan, and neither copied nor shuffled before.
    """
    src = fixture.forecast_src(spark, sf)
    rows = src.select(*schema.SOURCE_COLUMNS, F.col("_ingestion_ts").alias("changed_on"), "_frequency", "_batch_id")
    return {
        "run-1": rows.filter("_batch_id = 'b1'").drop("_batch_id"),
        "run-2": rows.filter(F.col("changed_on") > F.lit(STALE_MARK).cast("timestamp_ntz")).drop("_batch_id"),
    }


def land(rows: DataFrame, frequency: str, folder: str, run: str) -> str:
    path = f"{folder}/fc_{frequency}_{RUNS[run]:%Y%m%d%H%M}.parquet"
    rows.filter(F.col("_frequency") == frequency).drop("_frequency").write.mode("overwrite").parquet(path)
    return path


def load_subject(spark: SparkSession, frequency: str, landed: dict[str, DataFrame], root: str) -> str:
    """Both runs of one subject in a database of its own; returns the database."""
    database = new_database(spark)
    for run in landed:
        path = f"{root}/{frequency}/fc_{frequency}_{RUNS[run]:%Y%m%d%H%M}.parquet"
        run_subject(spark, database, f"fc_{frequency}", Run(run, RUNS[run], run), path, newest_by=["changed_on"],
                    archive_root=f"{root}/archive")
    return database


_LOADED: dict[tuple[str, str], tuple[list[str], str]] = {}


def loaded(spark: SparkSession, sf: str) -> tuple[list[str], str]:
    """(databases, archive folder) after both runs of the four subjects; loaded once per session.

    The subjects have sessions and databases of their own and run side by side.
    """
    key = (spark.sparkContext.applicationId, sf)
    if key not in _LOADED:
        root = work_path(spark, "landing")
        landed = landing_rows(spark, sf)
        for run, rows in landed.items():
            for frequency in FREQUENCIES:
                land(rows, frequency, f"{root}/{frequency}", run)
        with ThreadPoolExecutor(len(FREQUENCIES)) as pool:
            jobs = [pool.submit(load_subject, spark.newSession(), f, landed, root) for f in FREQUENCIES]
            _LOADED[key] = ([job.result() for job in jobs], f"{root}/archive")
    return _LOADED[key]


def layer(spark: SparkSession, sf: str, name: str) -> DataFrame:
    tables = [spark.table(f"{database}.{name}") for database in loaded(spark, sf)[0]]
    return reduce(DataFrame.unionByName, tables)


# ---------------------------------------------------------------- layer jobs

_BRONZE_SQL = f"SELECT {strings()}, changed_on, _frequency, '{{0}}' AS _batch_id, '{{1}}' AS _load_date FROM {{2}}"


@query(with_parts(
    _BRONZE_SQL.format("run-1", "1998-07-01", "bronze1") + " UNION ALL "
    + _BRONZE_SQL.format("run-2", "1998-12-01", "bronze2"), "bronze1", "bronze2"))
def run_bronze(spark, sf):
    return layer(spark, sf, "bronze").select(
        *schema.SOURCE_COLUMNS, "changed_on", "_frequency", "_batch_id", "_load_date")


def _rejected(run: str, number: int) -> str:
    keys = " AND ".join(f"{c} IS NOT NULL AND {c} <> ''" for c in schema.BUSINESS_KEY)
    cols = strings()
    return (
        f"SELECT {cols}, _frequency, '{run}' AS _batch_id, 'NULL_PK' AS _dq_fail_reason FROM landed{number}"
        f" WHERE NOT coalesce({keys}, false) UNION ALL"
        f" SELECT {', '.join(f'NULLIF({c}, {chr(39) * 2})' for c in schema.SOURCE_COLUMNS)}, _frequency, '{run}',"
        f" 'TYPE_ERROR' FROM bronze{number} WHERE TRY_CAST(forecast_date AS DATE) IS NULL"
    )


@query(with_parts(f"{_rejected('run-1', 1)} UNION ALL {_rejected('run-2', 2)}", "bronze1", "bronze2"))
def run_quarantine(spark, sf):
    return layer(spark, sf, "quarantine").select(
        *schema.SOURCE_COLUMNS, "_frequency", "_batch_id", "_dq_fail_reason")


_VERSIONS = (
    f"{strings(skip=('forecast_date', QTY, REV))}, CAST(forecast_date AS VARCHAR) AS forecast_date, {real(QTY, REV)},"
    f" _frequency, period, is_active, {text('effective_from', 'effective_to')}"
)
_VERSION_COLUMNS = [*schema.SOURCE_COLUMNS, "_frequency", "period", "is_active", "effective_from", "effective_to"]


@query(with_parts(f"SELECT {_VERSIONS} FROM run_history", "run_history"))
def run_silver(spark, sf):
    return layer(spark, sf, "silver").select(*_VERSION_COLUMNS)


def _totals(source: str, run: str) -> str:
    return (
        f"SELECT category, region, period, _frequency, '{run}' AS _batch_id, count(*) AS no_of_records,"
        f" CAST(sum({QTY}) AS DOUBLE) AS {QTY}, CAST(sum({REV}) AS DOUBLE) AS {REV} FROM {source}"
        " GROUP BY category, region, period, _frequency"
    )


@query(with_parts(f"{_totals('silver1', 'run-1')} UNION ALL {_totals('silver2', 'run-2')}", "silver1", "silver2"))
def run_period_agg(spark, sf):
    return layer(spark, sf, "period_agg").drop("_silver_load_ts")


@query(with_parts(
    f"SELECT {strings(skip=('forecast_date', QTY, REV))}, CAST(forecast_date AS VARCHAR) AS forecast_date,"
    f" {real(QTY, REV)}, period, _frequency, _batch_id, CAST(strftime(forecast_date, '%Y%m%d') AS BIGINT) AS time_key,"
    " true AS has_keys FROM run_fact", "run_fact"))
def run_fact(spark, sf):
    facts = layer(spark, sf, "fact")
    keyed = F.col("product_key").isNotNull() & F.col("location_key").isNotNull()
    return facts.withColumn("has_keys", keyed).select(
        *schema.SOURCE_COLUMNS, "period", "_frequency", "_batch_id", "time_key", "has_keys")


@query(with_parts(
    "SELECT CAST(forecast_date AS VARCHAR) AS date_key, count(DISTINCT _frequency) AS n FROM run_fact"
    " GROUP BY forecast_date", "run_fact"))
def run_dim_time(spark, sf):
    return layer(spark, sf, "dim_time").groupBy("date_key").agg(F.count(F.lit(1)).alias("n"))


@query(with_parts(
    "SELECT 'dim_product' AS dimension, product_id AS member, count(DISTINCT _frequency) AS open_versions"
    " FROM run_fact GROUP BY product_id UNION ALL"
    " SELECT 'dim_location', location_id, count(DISTINCT _frequency) FROM run_fact GROUP BY location_id", "run_fact"))
def run_dimensions(spark, sf):
    """Open versions per member: one in each subject's dimension that has it."""
    def members(name: str, key: str) -> DataFrame:
        counts = layer(spark, sf, name).groupBy(F.col(key).alias("member")).agg(
            F.count_if("is_active").alias("open_versions"))
        return counts.select(F.lit(name).alias("dimension"), "member", "open_versions")

    return members("dim_product", "product_id").unionByName(members("dim_location", "location_id"))


@query(
    "SELECT 'silver' AS table_name, CAST(0 AS BIGINT) AS violations UNION ALL SELECT 'dim_product', 0"
    " UNION ALL SELECT 'dim_location', 0")
def run_invariants(spark, sf):
    keys = {"silver": schema.MATCH_KEY, "dim_product": ["product_id"], "dim_location": ["location_id"]}
    found = [
        scd2_violations(spark.table(f"{database}.{name}"), key).select(F.lit(name).alias("table_name"))
        for name, key in keys.items() for database in loaded(spark, sf)[0]
    ]
    names = spark.createDataFrame([(name,) for name in keys], "table_name string")
    marked = reduce(DataFrame.unionByName, found).withColumn("one", F.lit(1))
    return names.join(marked, "table_name", "left").groupBy("table_name").agg(F.count("one").alias("violations"))


def _key_figures(metric: str) -> str:
    total = f"count(*) AS no_of_records, '{metric}' AS keyfigure, CAST(sum({metric}) AS DOUBLE) AS total_qty_amount"
    return (
        f"SELECT 'fc_' || _frequency || '_' || stamp || '.parquet' AS file_name, CAST(NULL AS VARCHAR) AS period,"
        " CAST(NULL AS VARCHAR) AS category, CAST(NULL AS VARCHAR) AS region, CAST(NULL AS VARCHAR) AS frequency,"
        f" 'fc_' || _frequency AS data_subject, _batch_id, {total} FROM run_fact"
        " GROUP BY _frequency, stamp, _batch_id UNION ALL"
        f" SELECT NULL, period, category, region, _frequency, 'fc_' || _frequency, _batch_id, {total} FROM run_fact"
        " GROUP BY period, category, region, _frequency, _batch_id"
    )


@query(with_parts(f"{_key_figures(QTY)} UNION ALL {_key_figures(REV)}", "run_fact"))
def run_kpi(spark, sf):
    return layer(spark, sf, "kpi").withColumnRenamed("_frequency", "frequency").drop(
        "load_date", "ins_gmt_ts", "ld_jb_nr")


def _log_line(layer_name: str, run: str, inserted: str, updated: str, source: str) -> str:
    return (f"SELECT '{run}' AS batch_id, 'fc_' || _frequency AS data_subject, '{layer_name}' AS layer,"
            f" 'SUCCESS' AS status, CAST({inserted} AS BIGINT) AS records_inserted,"
            f" CAST({updated} AS BIGINT) AS records_updated FROM {source} GROUP BY _frequency")


_GROUPS = "count(DISTINCT (period, category, region)) * 2 + 2"


@query(with_parts(" UNION ALL ".join([
    _log_line("BRONZE", "run-1", "count(*)", "0", "bronze1"),
    _log_line("BRONZE", "run-2", "count(*)", "0", "bronze2"),
    _log_line("SILVER", "run-1", "count(*)", "0", "silver1"),
    _log_line("SILVER", "run-2", "count_if(is_new)", "count_if(NOT is_new)", "opened2"),
    _log_line("GOLD", "run-1", "count(*)", "0", "silver1"),
    _log_line("GOLD", "run-2", "count(*)", "0", "fact2"),
    _log_line("AGGR_AUDIT", "run-1", _GROUPS, "0", "silver1"),
    _log_line("AGGR_AUDIT", "run-2", _GROUPS, "0", "fact2"),
]), "bronze1", "bronze2", "fact2"))
def run_job_log(spark, sf):
    return layer(spark, sf, "job_log").select(
        "batch_id", "data_subject", "layer", "status", "records_inserted", "records_updated")


def _dq_line(run: str, number: int) -> str:
    head = f"'{run}' AS batch_id, _frequency"
    keys = " AND ".join(f"{c} IS NOT NULL AND {c} <> ''" for c in schema.BUSINESS_KEY)
    complete = f"count_if(coalesce({keys}, false))"
    categories = ", ".join(f"'{c}'" for c in schema.VALID_CATEGORIES)
    currencies = ", ".join(f"'{c}'" for c in schema.VALID_CURRENCIES)
    rules = {"CATEGORY_VALIDATION": f"category NOT IN ({categories})",
             "CURRENCY_VALIDATION": f"currency NOT IN ({currencies})", "RANGE_CHECK": "forecast_qty < 0"}
    lines = [
        f"SELECT {head}, 'NULL_CHECK' AS check_type, count(*) AS checked, count(*) - {complete} AS failed"
        f" FROM landed{number} GROUP BY _frequency",
        f"SELECT {head}, 'DUPLICATE_CHECK', {complete}, {complete} - (SELECT count(*) FROM bronze{number} b"
        f" WHERE b._frequency = l._frequency) FROM landed{number} l GROUP BY _frequency",
        f"SELECT {head}, 'FORMAT_CHECK', count(*), count_if(TRY_CAST(forecast_date AS DATE) IS NULL)"
        f" FROM bronze{number} GROUP BY _frequency",
        f"SELECT {head}, 'DUPLICATE_CHECK', count(*), 0 FROM silver{number} GROUP BY _frequency",
        *[f"SELECT {head}, '{check}', count(*), count_if({bad}) FROM silver{number} GROUP BY _frequency"
          for check, bad in rules.items()],
    ]
    return " UNION ALL ".join(lines)


@query(with_parts(
    "SELECT batch_id, check_type, CAST(sum(checked) AS BIGINT) AS records_checked,"
    f" CAST(sum(failed) AS BIGINT) AS records_failed FROM ({_dq_line('run-1', 1)} UNION ALL {_dq_line('run-2', 2)})"
    " GROUP BY batch_id, check_type", "silver1", "silver2"))
def run_dq_log(spark, sf):
    return layer(spark, sf, "data_quality_log").groupBy("batch_id", "check_type").agg(
        F.sum("records_checked").alias("records_checked"), F.sum("records_failed").alias("records_failed"))


@query(with_parts(
    "SELECT 'fc_' || _frequency AS data_subject, 'run-1' AS load_job_nr, count(*) AS n FROM landed1"
    " GROUP BY _frequency UNION ALL SELECT 'fc_' || _frequency, 'run-2', count(*) FROM landed2 GROUP BY _frequency",
    "landed1", "landed2"))
def archive_batch(spark, sf):
    """Rows kept per archived batch, found by its folder."""
    archive = loaded(spark, sf)[1]
    parts = F.split(F.col("_metadata.file_path"), "/")
    rows = spark.read.parquet(f"{archive}/*/*").select(
        F.element_at(parts, -3).alias("data_subject"), F.element_at(parts, -2).alias("load_job_nr"))
    return rows.groupBy("data_subject", "load_job_nr").agg(F.count(F.lit(1)).alias("n"))


@query(with_parts(
    "SELECT period, _frequency, 'run-1' AS _batch_id, count(*) AS n FROM silver1 GROUP BY ALL UNION ALL"
    " SELECT period, _frequency, 'run-2', count(*) FROM opened2 GROUP BY ALL", "silver1", "opened2"))
def archive_silver(spark, sf):
    return layer(spark, sf, "silver_archive").groupBy("period", "_frequency", "_batch_id").agg(
        F.count(F.lit(1)).alias("n"))


def _audit_line(layer_name: str, run: str, source_rows: str, target: str, errors: str, source: str) -> str:
    counts = ", ".join(f"CAST({n} AS BIGINT) AS {c}" for c, n in (
        ("source_row_count", source_rows), ("target_row_count", target), ("error_record_count", errors)))
    return (f"SELECT '{run}' AS batch_id, 'fc_' || t._frequency AS data_subject, '{layer_name}' AS data_layer, 'SUCCESS' AS job_status,"
            f" {counts} FROM {source} t GROUP BY t._frequency")


def _of(source: str) -> str:
    return f"(SELECT count(*) FROM {source} o WHERE o._frequency = t._frequency)"


@query(with_parts(" UNION ALL ".join([
    _audit_line("BRONZE", "run-1", "count(*)", _of("bronze1"), f"count(*) - {_of('bronze1')}", "landed1"),
    _audit_line("BRONZE", "run-2", "count(*)", _of("bronze2"), f"count(*) - {_of('bronze2')}", "landed2"),
    _audit_line("SILVER", "run-1", "count(*)", _of("silver1"), f"count(*) - {_of('silver1')}", "bronze1"),
    _audit_line("SILVER", "run-2", "count(*)", _of("opened2"), f"count(*) - {_of('silver2')}", "bronze2"),
    _audit_line("GOLD", "run-1", "count(*)", "count(*)", "0", "silver1"),
    _audit_line("GOLD", "run-2", "count(*)", _of("fact2"), "0", "opened2"),
    _audit_line("AGGR_AUDIT", "run-1", "count(*)", _GROUPS, "0", "silver1"),
    _audit_line("AGGR_AUDIT", "run-2", "count(*)", _GROUPS, "0", "fact2"),
]), "landed1", "landed2", "fact2", "bronze1", "bronze2"))
def run_audit(spark, sf):
    """The audit entries of both runs."""
    return layer(spark, sf, "pipeline_audit").select(
        "batch_id", "data_subject", "data_layer", "job_status", "source_row_count", "target_row_count", "error_record_count")


@query(with_parts(
    "SELECT 'fc_' || _frequency AS data_subject, 'BRONZE' AS data_layer, 'SUCCESS' AS job_status, count(*) AS source_row_count,"
    " false AS has_message FROM landed1 GROUP BY _frequency"
    " UNION ALL SELECT DISTINCT 'fc_' || _frequency, 'SILVER', 'FAILED', 0, true FROM landed1", "landed1"))
def failed_runs_logged(spark, sf):
    """The first run behind a gate that wants every row to pass: Silver fails, its entry keeps the message."""
    database, root = new_database(spark), work_path(spark, "failing")
    rows = landing_rows(spark, sf)["run-1"]
    for frequency in FREQUENCIES:
        path = land(rows, frequency, f"{root}/{frequency}", "run-1")
        with suppress(QualityGateError):
            run_subject(spark, database, f"fc_{frequency}", Run("run-1", RUNS["run-1"], "run-1"), path, newest_by=["changed_on"], threshold=1.0)
    return spark.table(f"{database}.pipeline_audit").select(
        "data_subject", "data_layer", "job_status", "source_row_count",
        F.coalesce(F.col("error_message").startswith("QualityGateError: pass rate under 1.0"), F.lit(False)).alias("has_message"))


@query(with_parts(
    "SELECT 'fc_' || _frequency AS data_subject, 'landed' AS probe, count(*) > 0 AS has_rows, CAST(NULL AS VARCHAR) AS job_status"
    " FROM landed1 GROUP BY _frequency UNION ALL SELECT 'fc_' || _frequency, 'no rows',"
    " count_if(_frequency = 'none') > 0, 'NO_DATA' FROM landed1 GROUP BY _frequency"
    " UNION ALL SELECT 'fc_' || _frequency, 'no folder', false, 'NO_DATA' FROM landed1 GROUP BY _frequency", "landed1"))
def landing_probe(spark, sf):
    """What a run finds before it starts: rows, an extract without rows, or no folder; the last two are logged as NO_DATA."""
    database, root = new_database(spark), work_path(spark, "probe")
    rows, found = landing_rows(spark, sf)["run-1"], []
    for frequency in FREQUENCIES:
        places = {"landed": land(rows, frequency, f"{root}/{frequency}", "run-1"),
                  "no rows": land(rows.filter("_frequency = 'none'").withColumn("_frequency", F.lit(frequency)), frequency, f"{root}/none/{frequency}", "run-1"),
                  "no folder": f"{root}/nowhere/{frequency}"}
        for probe, path in places.items():
            found.append((f"fc_{frequency}", probe, path, has_source(spark, path)))
            if probe != "landed":
                run_subject(spark, database, f"fc_{frequency}", Run(probe, RUNS["run-1"], probe), path)
    probes = spark.createDataFrame(found, "data_subject string, probe string, object_name string, has_rows boolean")
    logged = spark.table(f"{database}.pipeline_audit").filter("data_layer = 'LANDING'").select("data_subject", "object_name", "job_status")
    return probes.join(logged, ["data_subject", "object_name"], "left").drop("object_name")


_ADDED = ("bronze", "silver", "fact", "silver_archive")  # tables that take a column which the source has newly added


@query(with_parts(
    "SELECT t AS table_name, 'changed_on' AS column_name, 'extra' AS problem, CAST(NULL AS VARCHAR) AS expected, 'string' AS found,"
    f" count(DISTINCT _frequency) AS n FROM src, unnest([{', '.join(repr(t) for t in _ADDED)}]) u(t) GROUP BY t"
    " UNION ALL SELECT 'fact', 'uom', 'missing', 'string', NULL, count(DISTINCT region) FROM src WHERE region = 'EUROPE'"
    " UNION ALL SELECT 'fact', 'forecast_qty', 'type', 'decimal(18,4)', 'double', count(DISTINCT region) FROM src WHERE region = 'EUROPE'"
    " UNION ALL SELECT 'fact', NULL, 'partition', 'period,_frequency', '_frequency,period', count(DISTINCT region) FROM src"
    " WHERE region = 'EUROPE'", "src"))
def schema_contract(spark, sf):
    """The loaded layers of all subjects against the model, and a fact that was made by other means."""
    other = new_database(spark)
    columns = layer(spark, sf, "fact").drop("uom", "changed_on").withColumn(QTY, F.col(QTY).cast("double")).filter("region = 'EUROPE'").limit(1)
    spark.sql(f"DROP TABLE {other}.fact")
    columns.write.partitionBy("_frequency", "period").saveAsTable(f"{other}.fact")
    found = [contract_differences(spark, database) for database in loaded(spark, sf)[0]]
    rows = reduce(DataFrame.unionByName, [*found, contract_differences(spark, other, "fact")])
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- extracts and run log


def _extract_state(spark: SparkSession, mark: str | None) -> DataFrame:
    rows = [("erp", "files", "sales", "orders", "orders", "fc_daily", "incremental", "o_orderdate", mark, True),
            ("erp", "files", "sales", "part", "part", "fc_daily", "full", None, None, True)]
    return spark.createDataFrame(rows, schema.EXTRACT_METADATA)


@query(
    f"SELECT 'stale' AS mark, count(*) AS n FROM orders WHERE o_orderdate > TIMESTAMP '{STALE_MARK}'"
    " UNION ALL SELECT 'newest', count(*) FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders)"
    " UNION ALL SELECT 'none', count(*) FROM orders")
def watermark_set(spark, sf):
    """Extracts after the mark was set by hand: to a day, to the newest value, and to none, which makes it a full one."""
    orders = fixture.table(spark, sf, "orders")
    newest = extract.extracted_mark(orders, "o_orderdate").first().new_watermark
    counts = []
    for name, value in (("stale", STALE_MARK), ("newest", newest), ("none", None)):
        state = extract.set_watermark(_extract_state(spark, "1900-01-01 00:00:00"), "erp", "orders", value)
        mark = state.filter("source_object = 'orders'").first().last_watermark
        counts.append(extract.incremental_extract(orders, "o_orderdate", mark).agg(F.count(F.lit(1)).alias("n")).withColumn("mark", F.lit(name)))
    return reduce(DataFrame.unionByName, counts)


@query(
    "SELECT 'run-1' AS run, 'orders' AS object, count(*) AS n, CAST(max(o_orderdate) AS VARCHAR) AS watermark FROM orders"
    f" WHERE o_orderdate > TIMESTAMP '{STALE_MARK}' UNION ALL SELECT 'run-2', 'orders', 0, CAST(max(o_orderdate) AS VARCHAR) FROM orders"
    " UNION ALL SELECT 'run-1', 'part', count(*), NULL FROM part UNION ALL SELECT 'run-2', 'part', count(*), NULL FROM part")
def extract_landing(spark, sf):
    """Two runs of an incremental and a full extract: landed rows by file, and the mark after each run."""
    database, root = new_database(spark), work_path(spark, "extracts")
    state = f"{database}.extract_metadata"
    sinks.replace_small(_extract_state(spark, STALE_MARK), state)
    found = []
    for run in RUNS:
        for name in ("orders", "part"):
            result = extract_to_landing(spark, state, fixture.table(spark, sf, name), "erp", name, root, Run(run, RUNS[run], run))
            found.append((run, name, result.path, result.watermark))
    counts = [
        spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n")).select(F.lit(run).alias("run"), F.lit(name).alias("object"), "n", F.lit(mark).cast("string").alias("watermark"))
        for run, name, path, mark in found]
    return reduce(DataFrame.unionByName, counts)


@query(with_parts(
    "SELECT batch_id, object_name, data_layer, job_status, CAST(job_end_ts AS VARCHAR) AS job_end_ts FROM audit"
    " WHERE data_layer = 'GOLD' ORDER BY audit.job_end_ts DESC NULLS LAST, audit.job_start_ts DESC NULLS LAST, batch_id DESC, object_name DESC LIMIT 1", "audit"))
def newest_entry(spark, sf):
    found = monitor.newest_entry(fixture.audit_log(spark, sf), "GOLD")
    return found.select("batch_id", "object_name", "data_layer", "job_status", "job_end_ts")


# ---------------------------------------------------------------- scans and sinks, round trips

_SRC_SQL = f"SELECT {strings()}, {ID_SQL} FROM src"


@query(with_parts(
    "SELECT " + ", ".join(f"NULLIF({c}, '') AS {c}" for c in schema.SOURCE_COLUMNS)
    + ", 'fc_199812010600.csv' AS _file_name FROM src", "src"))
def delimited_scan(spark, sf):
    path = f"{work_path(spark, 'csv')}/fc_199812010600.csv"
    rows = fixture.forecast_src(spark, sf).select(*schema.SOURCE_COLUMNS)
    rows.write.options(sep="|", header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return read_delimited(spark, path)


@query(with_parts(
    f"SELECT {strings()}, {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in SRC_IDS)},"
    " CAST(_ingestion_ts AS VARCHAR) AS _ingestion_ts, 'fc_199812010600.parquet' AS _file_name FROM src", "src"))
def parquet_scan(spark, sf):
    path = f"{work_path(spark, 'parquet')}/fc_199812010600.parquet"
    fixture.forecast_src(spark, sf).select(*schema.SOURCE_COLUMNS, *SRC_IDS, "_ingestion_ts").write.parquet(path)
    return read_parquet_as_strings(spark, path)


@query(with_parts(_SRC_SQL, "src"))
def overwrite_idempotent(spark, sf):
    path = work_path(spark, "overwrite")
    rows = fixture.forecast_src(spark, sf).select(*_SRC_COLUMNS)
    sinks.write_overwrite(rows, path)
    sinks.write_overwrite(rows, path)
    return spark.read.parquet(path)


@query(with_parts(
    f"SELECT {strings()}, {ID_SQL}, CAST(NULL AS VARCHAR) AS revision FROM src WHERE _batch_id = 'b1'"
    f" UNION ALL SELECT {strings()}, {ID_SQL}, 'r2' FROM src WHERE _batch_id = 'b2'", "src"))
def append_evolve(spark, sf):
    path = work_path(spark, "append")
    rows = fixture.forecast_src(spark, sf).select(*_SRC_COLUMNS)
    sinks.write_append(clean.current_batch(rows, "b1"), path)
    sinks.write_append(clean.current_batch(rows, "b2").withColumn("revision", F.lit("r2")), path)
    return sinks.read_evolved(spark, path)


@query(with_parts(
    f"SELECT {strings()}, {ID_SQL}, 1 AS version FROM src WHERE _batch_id = 'b1' UNION ALL"
    f" SELECT {strings()}, {ID_SQL}, 2 FROM src WHERE _batch_id = 'b2'", "src"))
def slice_overwrite(spark, sf):
    """The second write holds one batch's slices only; the other batch's slices stay."""
    table = f"{new_database(spark)}.sliced"
    rows = fixture.forecast_src(spark, sf).select(*schema.SOURCE_COLUMNS, *SRC_IDS, "_frequency", "_batch_id")
    versioned = rows.withColumn("version", F.lit(1))
    types = {f.name: f.dataType.simpleString() for f in versioned.schema.fields}
    columns = ", ".join(f"`{n}` {t}" for n, t in types.items())
    spark.sql(f"CREATE TABLE {table} ({columns}) USING PARQUET PARTITIONED BY (`_frequency`, `_batch_id`)")
    sinks.write_slice(versioned, table, scanned=True)
    sinks.write_slice(clean.current_batch(versioned, "b2").withColumn("version", F.lit(2)), table, scanned=True)
    return spark.table(table)


@query(with_parts(
    f"SELECT {SRC_ID}, product_id, CAST({QTY} AS DOUBLE) AS {QTY}, period, _frequency FROM clean", "clean"))
def partitioned_overwrite(spark, sf):
    path = work_path(spark, "partitioned")
    rows = stage_rows(clean_rows(spark, sf).select(*SRC_IDS, "product_id", QTY, "period", "_frequency"), work_path(spark, "clean"))
    sinks.write_partitioned(rows.withColumn(QTY, F.col(QTY) * 2), path, ["period", "_frequency"])
    sinks.write_partitioned(rows, path, ["period", "_frequency"])
    period = F.col("period").cast("string")
    return spark.read.option("basePath", path).parquet(path).withColumn("period", period)


@query(with_parts(
    "SELECT CASE WHEN period < '1996-07-01' THEN 'archive' ELSE 'fact' END AS place, period, _frequency,"
    f" count(*) AS n, CAST(sum({QTY}) AS DOUBLE) AS {QTY} FROM facts GROUP BY ALL", "facts"))
def archive_partitions(spark, sf):
    database = new_database(spark)
    job = Job(database, get_pipeline_metadata(spark.table(f"{database}.pipeline_metadata"), "fc_daily"),
              Run("run-1", RUNS["run-1"]))
    sinks.write_slice(all_facts(spark, sf)[0], job.table("fact"))
    archive_facts_before(spark, job, "1996-07-01")

    def place(name: str, table: str) -> DataFrame:
        return spark.table(job.table(table)).groupBy("period", "_frequency").agg(
            F.count(F.lit(1)).alias("n"), F.sum(QTY).alias(QTY)).withColumn("place", F.lit(name))

    return place("fact", "fact").unionByName(place("archive", "fact_archive"))


@query(with_parts(f"{_SRC_SQL} WHERE product_id = 'P7' AND location_id = 'L7'", "src"))
def clustered_scan(spark, sf):
    path = work_path(spark, "clustered")
    rows = fixture.forecast_src(spark, sf).select(*_SRC_COLUMNS)
    sinks.write_clustered(rows, path, ["product_id", "location_id"], num_files=8)
    return spark.read.parquet(path).filter((F.col("product_id") == "P7") & (F.col("location_id") == "L7"))


@query(with_parts(f"{_SRC_SQL} WHERE location_id = 'L7'", "src"))
def interleaved_scan(spark, sf):
    """A filter on the second of three columns, of which files are narrow ranges."""
    path = work_path(spark, "interleaved")
    rows = fixture.forecast_src(spark, sf).select(*_SRC_COLUMNS)
    sinks.write_interleaved(rows, path, ["product_id", "location_id", "forecast_date"], num_files=64)
    return spark.read.parquet(path).filter(F.col("location_id") == "L7")


@query(with_parts(f"{_SRC_SQL}", "src"))
def compacted_slices(spark, sf):
    """Small appends, then a compaction: the same rows in fewer files."""
    table = f"{new_database(spark)}.sliced"
    rows = fixture.forecast_src(spark, sf).select(*schema.SOURCE_COLUMNS, *SRC_IDS, "_batch_id", "_frequency")
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    spark.sql(f"CREATE TABLE {table} ({types}) USING PARQUET PARTITIONED BY (`_frequency`)")
    for part in range(5):
        sinks.insert_rows(rows.filter(F.pmod(F.xxhash64("_src_orderkey"), F.lit(5)) == part), table)
    if sinks.compact(spark, table) == 0:
        raise RuntimeError("no slice was compacted")
    return spark.table(table).select(*_SRC_COLUMNS)


@query(with_parts(
    f"SELECT {strings(skip=('forecast_date', QTY, REV))}, CAST(forecast_date AS VARCHAR) AS forecast_date,"
    f" {real(QTY, REV)}, _frequency FROM batch1 UNION ALL SELECT"
    f" {strings('b.', skip=('forecast_date', QTY, REV))}, CAST(b.forecast_date AS VARCHAR), CAST(b.{QTY} AS DOUBLE),"
    f" CAST(b.{REV} AS DOUBLE), b._frequency FROM batch2 b WHERE NOT EXISTS (SELECT 1 FROM batch1 a WHERE "
    + " AND ".join(f"a.{c} = b.{c}" for c in schema.FACT_KEY) + ")", "batch1", "batch2"))
def insert_only_merge(spark, sf):
    """Two batches into the fact, the second one twice."""
    table = f"{new_database(spark)}.fact"
    sinks.merge_insert_only(batch_one(spark, sf), table, schema.FACT_KEY)
    second = batch_two(spark, sf)
    sinks.merge_insert_only(second, table, schema.FACT_KEY)
    sinks.merge_insert_only(second, table, schema.FACT_KEY)
    return spark.table(table).select(*schema.SOURCE_COLUMNS, "_frequency")


# ---------------------------------------------------------------- streaming


def _stream(spark: SparkSession, database: str, root: str, run: str, rows: DataFrame, to_silver: bool = False,
            checkpoint: str = "checkpoints", folder: str | None = None) -> None:
    """Land a run's files and start one stream per frequency; their table slices do not overlap."""
    running = []
    for frequency in FREQUENCIES:
        place = f"{root}/{folder or 'in'}/{frequency}"
        land(rows, frequency, place, run)
        subject = get_pipeline_metadata(spark.table(f"{database}.pipeline_metadata"), f"fc_{frequency}")
        running.append(stream_layers(
            landing_files(spark, f"{place}/*"), database, subject, f"{root}/{checkpoint}/{frequency}", to_silver=to_silver,
            newest_by=["changed_on"], run_ts=RUNS[run]))
    for one in running:
        one.awaitTermination()


def _stamped(column: str = "_frequency") -> list[str]:
    return [f"'fc_' || {column} || '_{RUNS[run]:%Y%m%d%H%M}.parquet' AS _file_name" for run in RUNS]


@query(with_parts(" UNION ALL ".join(
    f"SELECT {strings()}, changed_on, _frequency, {name} FROM bronze{k + 1}" for k, name in enumerate(_stamped())),
    "bronze1", "bronze2"))
def stream_bronze(spark, sf):
    """Both runs' files; the stream is started again for the second run and reads its files only."""
    database, root = new_database(spark), work_path(spark, "stream")
    for run, rows in landing_rows(spark, sf).items():
        _stream(spark, database, root, run, rows)
    return spark.table(f"{database}.bronze_stream").select(
        *schema.SOURCE_COLUMNS, "changed_on", "_frequency", "_file_name")


@query(with_parts(f"SELECT {_VERSIONS} FROM run_history", "run_history"))
def stream_silver(spark, sf):
    """Each run's files arrive and the stream is started again: it reads only the new ones."""
    database, root = new_database(spark), work_path(spark, "stream")
    for run, rows in landing_rows(spark, sf).items():
        _stream(spark, database, root, run, rows, to_silver=True)
    return spark.table(f"{database}.silver").select(*_VERSION_COLUMNS)


def _per_table(run: str, number: int) -> str:
    day = f"{RUNS[run]:%Y-%m-%d}"
    lines = [(f"bronze{number}", "bronze_stream"), (f"silver{number}", "period_agg")]
    counts = [f"SELECT '{name}' AS table_name, _frequency, '{day}' AS day, count(*) AS n FROM {source} GROUP BY _frequency" for source, name in lines]
    return " UNION ALL ".join([*counts, f"SELECT 'quarantine', _frequency, '{day}', count(*) FROM ({_rejected(run, number)}) GROUP BY _frequency"])


@query(with_parts(
    f"{_per_table('run-1', 1)} UNION ALL {_per_table('run-2', 2)} UNION ALL"
    " SELECT 'silver', _frequency, CAST(effective_from AS VARCHAR), count(*) FROM run_history GROUP BY ALL",
    "bronze1", "bronze2", "run_history"))
def stream_new_checkpoint(spark, sf):
    """The second run's stream has a checkpoint of its own, whose numbers begin anew: every table keeps the first run's rows."""
    database, root = new_database(spark), work_path(spark, "stream")
    for run, rows in landing_rows(spark, sf).items():
        _stream(spark, database, root, run, rows, to_silver=True, checkpoint=f"checkpoint-{run}", folder=f"in-{run}")

    def counted(name: str, day: str, n=F.count(F.lit(1))) -> DataFrame:
        rows = spark.table(f"{database}.{name}").withColumn("day", F.expr(f"string(date({day}))"))
        return rows.groupBy("_frequency", "day").agg(n.alias("n")).select(F.lit(name).alias("table_name"), "_frequency", "day", "n")

    return counted("bronze_stream", "_ingestion_ts").unionByName(
        counted("period_agg", "_silver_load_ts", F.sum("no_of_records"))).unionByName(
        counted("quarantine", "_ingestion_ts")).unionByName(counted("silver", "effective_from"))


_TYPED_SOURCE = ", ".join(
    f"CAST(CAST({c} AS {t}) AS {'VARCHAR' if t == 'DATE' else 'DOUBLE'}) AS {c}" for c, t in
    {"forecast_date": "DATE", QTY: "DECIMAL(18,4)", REV: "DECIMAL(18,2)"}.items())


def _typed(number: int, revision: str) -> str:
    tries = _TYPED_SOURCE.replace("CAST(CAST(", "CAST(TRY_CAST(")
    return (f"SELECT {strings(skip=('forecast_date', QTY, REV))}, {tries}, {revision} AS revision, _frequency, {_stamped()[number - 1]}"
            f" FROM bronze{number} WHERE TRY_CAST(forecast_date AS DATE) IS NOT NULL")


@query(with_parts(f"{_typed(1, 'CAST(NULL AS VARCHAR)')} UNION ALL {_typed(2, chr(39) + 'r2' + chr(39))}", "bronze1", "bronze2"))
def stream_typed(spark, sf):
    """Parquet with DATE and DECIMAL columns; the second run's files have one column more. The stream is restarted
    in between without new files. A day that is not a date is NULL in such a file, and its row incomplete."""
    database, root = new_database(spark), work_path(spark, "stream")
    landed = landing_rows(spark, sf)
    typed = {run: clean.cast_columns(rows) for run, rows in landed.items()}
    _stream(spark, database, root, "run-1", typed["run-1"])
    _stream(spark, database, root, "run-1", typed["run-1"].limit(0), folder="in/nothing")
    _stream(spark, database, root, "run-2", typed["run-2"].withColumn("revision", F.lit("r2")))
    numbers = [F.col(c).cast("double").alias(c) for c in (QTY, REV)]
    others = [c for c in schema.SOURCE_COLUMNS if c not in (QTY, REV)]
    return spark.table(f"{database}.bronze_stream").select(*others, *numbers, "revision", "_frequency", "_file_name")


@query(with_parts(" UNION ALL ".join(
    f"SELECT * EXCLUDE (batch_id), '{RUNS[run]:%Y-%m-%d}' AS day FROM ({line})" for run, line in [
        ("run-1", _log_line("BRONZE", "run-1", "count(*)", "0", "bronze1")),
        ("run-2", _log_line("BRONZE", "run-2", "count(*)", "0", "bronze2")),
        ("run-1", _log_line("SILVER", "run-1", "count(*)", "0", "silver1")),
        ("run-2", _log_line("SILVER", "run-2", "count_if(is_new)", "count_if(NOT is_new)", "opened2"))]),
    "bronze1", "bronze2", "opened2"))
def stream_logs(spark, sf):
    """The job-log rows that the micro-batches of both runs commit with."""
    database, root = new_database(spark), work_path(spark, "stream")
    for run, rows in landing_rows(spark, sf).items():
        _stream(spark, database, root, run, rows, to_silver=True)
    return spark.table(f"{database}.job_log").select(
        "data_subject", "layer", "status", "records_inserted", "records_updated", F.expr("string(date(insert_time))").alias("day"))


@query(with_parts(f"SELECT DISTINCT {', '.join(schema.MATCH_KEY)} FROM valid", "valid"))
def stream_dedup(spark, sf):
    """One row per key from files that arrive one by one, newest months first, with a restart in the middle: rows and
    repeats that come late, by any delay, are told from each other by what has landed."""
    folder, table = work_path(spark, "stream-dedup"), f"{new_database(spark)}.first_seen"
    rows = valid_rows(spark, sf).select(*schema.MATCH_KEY, F.col("_ingestion_ts").cast("timestamp").alias("_ingestion_ts"))
    month = F.date_format("_ingestion_ts", "yyyy")
    sinks.write_partitioned(rows.withColumn("year", month), f"{folder}/all", ["year"])
    years = sorted((r.year for r in spark.read.parquet(f"{folder}/all").select("year").distinct().collect()), reverse=True)
    create_key_table(spark, table, "product_id STRING, location_id STRING, forecast_date STRING, _frequency STRING, _ingestion_ts TIMESTAMP")
    for part in (years[:len(years) // 2], years[len(years) // 2:]):
        for year in part:
            spark.read.parquet(f"{folder}/all/year={year}").coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/in")
        land_new_keys(stream, table, schema.MATCH_KEY, ["_ingestion_ts"], f"{folder}/checkpoint").awaitTermination()
    return spark.table(table).select(*schema.MATCH_KEY)


# ---------------------------------------------------------------- runs that fail and interleave


def _interleaved() -> str:
    """Versions after run-2 was merged first and run-1 afterwards, as of its earlier day."""
    return (
        f"SELECT b.*, DATE '{SECOND_DAY}' AS effective_from,"
        " CAST(NULL AS DATE) AS effective_to, true AS is_active FROM silver2 b"
        f" UNION ALL SELECT a.*, DATE '{FIRST_DAY}', CASE WHEN b.product_id IS NULL THEN NULL ELSE DATE '{SECOND_DAY}' END,"
        f" b.product_id IS NULL FROM silver1 a LEFT JOIN silver2 b ON {matches('a', 'b')}")


@query(with_parts(f"SELECT {_VERSIONS} FROM ({_interleaved()})", "silver1", "silver2"))
def resume_after_other_batch(spark, sf):
    """run-1 is lost after it has written its Silver merge aside and before it publishes it; run-2 is loaded; then run-1 is
    resumed. Both runs' rows are there, and run-1's versions end where those of run-2 begin."""
    root = work_path(spark, "resume")
    landed = landing_rows(spark, sf)
    paths = {(run, f): land(rows, f, f"{root}/{f}", run) for run, rows in landed.items() for f in FREQUENCIES}
    with ThreadPoolExecutor(len(FREQUENCIES)) as pool:
        databases = list(pool.map(lambda f: _interrupted(spark.newSession(), f, {run: paths[run, f] for run in RUNS}), FREQUENCIES))
    return reduce(DataFrame.unionByName, [spark.table(f"{d}.silver") for d in databases]).select(*_VERSION_COLUMNS)


def _interrupted(spark: SparkSession, frequency: str, paths: dict[str, str]) -> str:
    """A database of its own in which one subject's runs go as ``resume_after_other_batch`` says."""
    database, name = new_database(spark), f"fc_{frequency}"
    job = Job(database, get_pipeline_metadata(spark.table(f"{database}.pipeline_metadata"), name), Run("run-1", RUNS["run-1"], "run-1"))
    first = ("BRONZE", lambda: load_bronze(spark, job, paths["run-1"], newest_by=["changed_on"]))
    run_steps(spark, job, paths["run-1"], {}, {}, [first])
    incoming = silver_rows(validate_data_types(bronze_batch(spark, job), schema.TYPED_COLUMNS)[0], job, ["changed_on"])
    write_version(open_all(incoming, job.run.as_of), job.table("silver"), "lost", sinks.balanced)
    for run in ("run-2", "run-1"):
        run_subject(spark, database, name, Run(run, RUNS[run], run), paths[run], newest_by=["changed_on"])
    return database
