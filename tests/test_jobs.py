"""A subject's run on small landing files."""

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from conftest import rows_of, same_rows
from strata import schema
from strata.operators.quality import QualityGateError, check_schema
from strata.operators.scd2 import scd2_violations
from strata.plans import subject as subject_module
from strata.plans.load_queries import new_database
from strata.plans.reports import register_views
from strata.plans.run import Run
from strata.plans.subject import run_subject
from strata.session import work_path
from strata.sources import versions
from strata.sources.logs import loaded_layers

SUBJECT = "fc_daily"
COLUMNS = ", ".join(f"{c} string" for c in schema.SOURCE_COLUMNS) + ", changed_on string"


def row(product="P1", location="L1", day="2024-01-15", qty="10", revenue="5.00", customer="C1", channel="DIRECT",
        category="SERVER", currency="USD", changed="1", sub="S1"):
    return (product, location, day, qty, revenue, customer, channel, category, sub, "EUROPE", "DE", currency, "UNIT",
            changed)


FIRST = [
    row(), row("P2", category=" server"), row("P3", customer=None), row("P4", qty="-3"),
    row("P5", category="LEGACY_HW"), row("P6", currency="XX"), row("P7", revenue=None),
    row("P8", qty="1", changed="1"), row("P8", qty="2", changed="2"), row("P8", qty="2", changed="2"),
    row(None), row(location="  "), row(day=""),
    row("P9", day="not-a-date"), row("P1", day="2024-02-15"),
]
SECOND = [row(), row("P2", category="SERVER", qty="11"), row("P1", day="2024-02-15"), row("P10", sub="S9")]


def land(spark, rows, name):
    path = f"{work_path(spark, 'jobs')}/{name}.parquet"
    spark.createDataFrame(rows, COLUMNS).write.parquet(path)
    return path


def go(spark, database, batch, day, path, **options):
    run = Run(batch, datetime(2024, day, 1, 6, tzinfo=timezone.utc), f"job-{batch}")
    return run_subject(spark, database, SUBJECT, run, path, newest_by=["changed_on"], **options)


@pytest.fixture(scope="module")
def two_runs(spark):
    database = new_database(spark)
    archive = work_path(spark, "archive")
    one = land(spark, FIRST, "fc_202401010600")
    two = land(spark, SECOND, "fc_202403010600")
    results = [go(spark, database, "b1", 1, one, archive_root=archive), go(spark, database, "b2", 3, two)]
    return database, results, archive, (one, two)


def test_layer_counts(two_runs):
    _, (first, second), _, _ = two_runs
    got = {r.layer: (r.source_rows, r.inserted, r.updated, r.errors) for r in first.layers}
    assert got == {"BRONZE": (15, 10, 0, 5), "SILVER": (10, 9, 0, 1), "GOLD": (9, 9, 0, 0), "AGGR_AUDIT": (9, 8, 0, 0)}
    got = {r.layer: (r.source_rows, r.inserted, r.updated, r.errors) for r in second.layers}
    assert got["SILVER"] == (4, 1, 1, 0)
    assert got["GOLD"] == (2, 1, 0, 0)


def test_bronze_is_text_with_provenance(spark, two_runs):
    bronze = spark.table(f"{two_runs[0]}.bronze")
    assert {bronze.schema[c].dataType.simpleString() for c in schema.SOURCE_COLUMNS} == {"string"}
    assert "changed_on" in bronze.columns
    assert bronze.filter("_file_name IS NULL OR _ingestion_ts IS NULL OR _batch_id IS NULL").isEmpty()
    assert rows_of(bronze.select("_source_batch_nr").distinct()) == [("202401010600",), ("202403010600",)]
    assert bronze.filter("product_id = 'P8'").first().forecast_qty == "2"
    assert bronze.filter("product_id = 'P2'").first().category == "SERVER"


def test_quarantine(spark, two_runs):
    rows = spark.table(f"{two_runs[0]}.quarantine").groupBy("_batch_id", "_dq_fail_reason").count()
    assert rows_of(rows) == [("b1", "NULL_PK", 3), ("b1", "TYPE_ERROR", 1)]


def test_silver_history(spark, two_runs):
    silver = spark.table(f"{two_runs[0]}.silver")
    assert check_schema(silver, schema.SILVER) == []
    assert scd2_violations(silver, schema.MATCH_KEY).isEmpty()
    p2 = silver.filter("product_id = 'P2'").orderBy("effective_from").collect()
    assert [(float(r.forecast_qty), r.effective_from, r.effective_to, r.is_active) for r in p2] == [
        (10.0, date(2024, 1, 1), date(2024, 3, 1), False), (11.0, date(2024, 3, 1), None, True)]
    flags = {r.product_id: r._dq_flags for r in silver.filter("size(_dq_flags) > 0").collect()}
    assert flags == {"P4": ["RANGE_CHECK"], "P5": ["CATEGORY_VALIDATION"], "P6": ["CURRENCY_VALIDATION"]}


def test_gold(spark, two_runs):
    fact = spark.table(f"{two_runs[0]}.fact")
    assert fact.filter("product_key IS NULL OR location_key IS NULL OR time_key IS NULL").isEmpty()
    parts = {r.partition for r in spark.sql(f"SHOW PARTITIONS {two_runs[0]}.fact").collect()}
    assert parts == {"period=2024-01-01/_frequency=daily", "period=2024-02-01/_frequency=daily"}
    # The revised forecast stays in Silver; the fact keeps the first value.
    assert float(fact.filter("product_id = 'P2'").first().forecast_qty) == 10.0
    products = spark.table(f"{two_runs[0]}.dim_product")
    assert products.filter("is_active").count() == products.select("product_id").distinct().count()
    assert spark.table(f"{two_runs[0]}.dim_time").count() == 2


def test_archived_batch_and_silver_copy(spark, two_runs):
    assert spark.read.parquet(f"{two_runs[2]}/{SUBJECT}/job-b1").count() == 15
    assert spark.table(f"{two_runs[0]}.silver_archive").groupBy("_batch_id").count().count() == 2


def test_audit_trail(spark, two_runs):
    log = spark.table(f"{two_runs[0]}.pipeline_audit").filter("batch_id = 'b1'")
    assert rows_of(log.select("data_layer", "job_status")) == [
        ("AGGR_AUDIT", "SUCCESS"), ("BRONZE", "SUCCESS"), ("GOLD", "SUCCESS"), ("SILVER", "SUCCESS")]
    dq = spark.table(f"{two_runs[0]}.data_quality_log").filter("batch_id = 'b1'")
    rows = dq.collect()
    silver_repeats = [r for r in rows if r.check_type == "DUPLICATE_CHECK" and r.table_name.endswith(".silver")]
    assert [(r.records_checked, r.records_failed) for r in silver_repeats] == [(9, 0)]
    got = {r.check_type: (r.records_checked, r.records_failed) for r in rows if r not in silver_repeats}
    assert got == {"NULL_CHECK": (15, 3), "DUPLICATE_CHECK": (12, 2), "FORMAT_CHECK": (10, 1),
                   "CATEGORY_VALIDATION": (9, 1), "CURRENCY_VALIDATION": (9, 1), "RANGE_CHECK": (9, 1)}


def test_views(spark, two_runs):
    register_views(spark, two_runs[0])
    assert spark.sql("SELECT * FROM vw_latest_pipeline_runs").count() == 8
    assert spark.sql("SELECT sum(success_count) FROM vw_daily_load_summary").first()[0] == 8
    rate = spark.sql("SELECT pass_rate_pct FROM vw_dq_summary WHERE check_type = 'NULL_CHECK' ORDER BY check_date")
    assert [float(r[0]) for r in rate.collect()] == [80.0, 100.0]
    gold = spark.sql("SELECT data_subject, keyfigures FROM vw_aggregated_audit")
    assert rows_of(gold) == [(SUBJECT, "forecast_qty,revenue_amount")] * 2


def test_key_figures(spark, two_runs):
    kpi = spark.table(f"{two_runs[0]}.kpi").filter("_batch_id = 'b1'")
    by_file = kpi.filter("file_name IS NOT NULL").select("keyfigure", "no_of_records", "total_qty_amount")
    assert rows_of(by_file) == [("forecast_qty", 9, 69.0), ("revenue_amount", 9, 40.0)]
    total = kpi.filter("period IS NOT NULL AND keyfigure = 'forecast_qty'").agg(F.sum("total_qty_amount")).first()[0]
    assert total == 69.0


def test_running_a_batch_again_is_skipped(spark, two_runs):
    database, _, _, (one, _) = two_runs
    before = {t: spark.table(f"{database}.{t}").collect() for t in ("silver", "fact", "kpi", "job_log")}
    again = go(spark, database, "b1", 1, one)
    assert {r.status for r in again.layers} == {"SKIPPED"}
    for name, rows in before.items():
        assert len(rows) == spark.table(f"{database}.{name}").count()


def test_repeating_lost_log_entries_changes_no_data(spark):
    """The data of a run was written but the log was lost: running again leaves the same tables."""
    database = new_database(spark)
    path = land(spark, FIRST, "fc_202401010600")
    go(spark, database, "b1", 1, path)
    names = ("bronze", "quarantine", "silver", "period_agg", "fact", "dim_product", "dim_time", "kpi")
    before = {n: spark.createDataFrame(spark.table(f"{database}.{n}").collect(), spark.table(f"{database}.{n}").schema)
              for n in names}
    spark.sql(f"TRUNCATE TABLE {database}.job_log")
    go(spark, database, "b1", 1, path)
    for name, rows in before.items():
        assert same_rows(rows, spark.table(f"{database}.{name}")), name


def test_no_data(spark):
    database = new_database(spark)
    result = go(spark, database, "b1", 1, land(spark, [], "fc_202401010600"))
    assert (result.status, result.layers) == ("NO_DATA", [])
    entry = spark.table(f"{database}.pipeline_audit").first()
    assert (entry.data_layer, entry.job_status) == ("LANDING", "NO_DATA")
    assert spark.table(f"{database}.bronze").isEmpty()


def test_batch_of_rejects_only(spark):
    database = new_database(spark)
    result = go(spark, database, "b1", 1, land(spark, [row(None), row(day="never")], "fc_202401010600"))
    assert {r.layer: r.inserted for r in result.layers} == {"BRONZE": 1, "SILVER": 0, "GOLD": 0, "AGGR_AUDIT": 0}
    assert spark.table(f"{database}.quarantine").count() == 2


def test_failure_stops_the_run_is_logged_and_can_be_resumed(spark, monkeypatch):
    database = new_database(spark)
    path = land(spark, FIRST, "fc_202401010600")

    def broken(*_):
        raise RuntimeError("disk full")

    with monkeypatch.context() as patch:
        patch.setattr(subject_module, "load_silver", broken)
        with pytest.raises(RuntimeError, match="disk full"):
            go(spark, database, "b1", 1, path)
    log = spark.table(f"{database}.job_log")
    assert rows_of(log.select("layer", "status")) == [("BRONZE", "SUCCESS"), ("SILVER", "FAILED")]
    assert log.filter("status = 'FAILED'").first().error_message == "RuntimeError: disk full"
    assert spark.table(f"{database}.fact").isEmpty()

    result = go(spark, database, "b1", 1, path)
    assert [r.status for r in result.layers] == ["SKIPPED", "SUCCESS", "SUCCESS", "SUCCESS"]
    assert loaded_layers(spark, f"{database}.job_log", "b1", SUBJECT).keys() == {"BRONZE", "SILVER", "GOLD", "AGGR_AUDIT"}


def test_gate_stops_before_silver_is_written(spark):
    database = new_database(spark)
    with pytest.raises(QualityGateError):
        go(spark, database, "b1", 1, land(spark, FIRST, "fc_202401010600"), threshold=0.95)
    assert spark.table(f"{database}.silver").isEmpty()
    assert not spark.table(f"{database}.data_quality_log").isEmpty()


def dies_after(monkeypatch, module, name, calls, table):
    """``module.name`` raises at its call number ``calls`` for a table."""
    real, seen = getattr(module, name), []

    def dying(spark, where, *args, **kwargs):
        if where.endswith(table):
            seen.append(where)
            if len(seen) == calls:
                raise RuntimeError("driver lost")
        return real(spark, where, *args, **kwargs)

    monkeypatch.setattr(module, name, dying)


@pytest.mark.parametrize("table", [".silver", ".dim_product"])
@pytest.mark.parametrize("name", ["publish", "apply"])
def test_a_run_that_dies_while_publishing_is_resumed(spark, monkeypatch, name, table):
    """Before the manifest entry the merge is built again; after it, the next attempt completes the catalog."""
    calm, database = new_database(spark), new_database(spark)
    first, second = land(spark, FIRST, "fc_202401010600"), land(spark, SECOND, "fc_202403010600")
    for where in (calm, database):
        go(spark, where, "b1", 1, first)
    go(spark, calm, "b2", 3, second)
    with monkeypatch.context() as patch:
        dies_after(patch, versions, name, 1, table)
        with pytest.raises(RuntimeError, match="driver lost"):
            go(spark, database, "b2", 3, second)
    layers = {r.layer: r for r in go(spark, database, "b2", 3, second).layers}
    if table == ".silver":
        assert (layers["SILVER"].inserted, layers["SILVER"].updated) == (1, 1)
    for table in ("silver", "dim_product", "dim_location", "fact"):
        assert content(spark, database, table) == content(spark, calm, table)


@pytest.mark.parametrize("name", ["publish", "apply"])
def test_a_batch_is_resumed_after_another_one(spark, monkeypatch, name):
    """b1 dies while it publishes Silver, b2 runs, b1 is resumed: nobody's rows are lost, in no layer."""
    database = new_database(spark)
    go(spark, database, "b0", 1, land(spark, [row("P0")], "fc_202401010600"))
    late = land(spark, [row("P1"), row("P0", qty="11")], "fc_202402010600")
    with monkeypatch.context() as patch:
        dies_after(patch, versions, name, 1, ".silver")
        with pytest.raises(RuntimeError, match="driver lost"):
            go(spark, database, "b1", 2, late)
    go(spark, database, "b2", 3, land(spark, [row("P2"), row("P0", qty="12")], "fc_202403010600"))
    result = go(spark, database, "b1", 2, late)
    assert [r.status for r in result.layers] == ["SKIPPED", "SUCCESS", "SUCCESS", "SUCCESS"]
    silver = spark.table(f"{database}.silver")
    assert rows_of(silver.selectExpr("product_id", "int(forecast_qty)", "string(effective_from)", "string(effective_to)")) == [
        ("P0", 10, "2024-01-01", "2024-02-01"), ("P0", 11, "2024-02-01", "2024-03-01"), ("P0", 12, "2024-03-01", None),
        ("P1", 10, "2024-02-01", None), ("P2", 10, "2024-03-01", None)]
    for table in ("fact", "dim_product"):
        assert rows_of(spark.table(f"{database}.{table}").select("product_id").distinct()) == [("P0",), ("P1",), ("P2",)]


def test_a_merge_that_was_overtaken_is_built_again(spark, monkeypatch):
    """Another batch publishes between the moment a merge reads Silver and the moment it publishes."""
    database = new_database(spark)
    other = land(spark, [row("P2")], "fc_202403010600")
    real, seen = versions.publish, []

    def overtaken(session, table, *args, **kwargs):
        if table.endswith(".silver") and not seen:
            seen.append(table)
            go(spark, database, "b2", 3, other)
        return real(session, table, *args, **kwargs)

    with monkeypatch.context() as patch:
        patch.setattr(versions, "publish", overtaken)
        go(spark, database, "b1", 2, land(spark, [row("P1")], "fc_202402010600"))
    for table in ("silver", "fact", "dim_product"):
        assert rows_of(spark.table(f"{database}.{table}").select("product_id")) == [("P1",), ("P2",)]


def at(spark, database, batch, when, path, **options):
    return run_subject(spark, database, SUBJECT, Run(batch, when, f"job-{batch}"), path, **options)


def content(spark, database, *names):
    found = {}
    for name in names or ("bronze", "quarantine", "silver", "period_agg", "fact", "data_quality_log"):
        rows = spark.table(f"{database}.{name}").drop(
            "_ingestion_ts", "_update_ts", "_silver_load_ts", "_gold_load_ts", "_file_name", "created_ts", "table_name")
        found[name] = rows_of(rows.select(*sorted(rows.columns)))
    return found


def test_a_batch_is_resumed_on_another_day_without_its_landing_folder(spark, monkeypatch):
    late, early = datetime(2024, 1, 1, 23, 50, tzinfo=timezone.utc), datetime(2024, 1, 2, 0, 10, tzinfo=timezone.utc)
    path = land(spark, FIRST, "fc_202401010600")
    calm = new_database(spark)
    at(spark, calm, "b1", late, path)

    database = new_database(spark)

    def broken(*_, **__):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(subject_module, "load_silver", broken)
        with pytest.raises(RuntimeError, match="stopped"):
            at(spark, database, "b1", late, path)
    # A second batch of the same day comes in between, with other keys.
    at(spark, database, "b2", datetime(2024, 1, 1, 23, 55, tzinfo=timezone.utc), land(spark, [row("Q1")], "fc_202401010700"))
    with monkeypatch.context() as patch:
        dies_after(patch, versions, "apply", 1, ".silver")
        with pytest.raises(RuntimeError, match="driver lost"):
            at(spark, database, "b1", early, "/nowhere")
    result = at(spark, database, "b1", early, "/nowhere")
    assert [r.status for r in result.layers] == ["SKIPPED", "SUCCESS", "SUCCESS", "SUCCESS"]
    at(spark, calm, "b2", datetime(2024, 1, 1, 23, 55, tzinfo=timezone.utc), land(spark, [row("Q1")], "fc_202401010700"))
    want, got = content(spark, calm), content(spark, database)
    for name in want:
        assert got[name] == want[name], name


def test_silver_stops_when_bronze_lost_rows(spark, monkeypatch):
    database = new_database(spark)
    with monkeypatch.context() as patch:
        patch.setattr(subject_module, "load_silver", lambda *_, **__: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            go(spark, database, "b1", 1, land(spark, FIRST, "fc_202401010600"))
    spark.sql(f"ALTER TABLE {database}.bronze DROP PARTITION (_frequency = 'daily', _load_date = '2024-01-01', _batch_id = 'b1')")
    with pytest.raises(RuntimeError, match="Bronze logged 10 rows"):
        go(spark, database, "b1", 1, "/nowhere")


def test_one_key_in_two_spellings_is_one_version_and_one_fact(spark):
    database = new_database(spark)
    rows = [row(day="2024-01-15", changed="9", qty="9"), row(day="2024-1-15", changed="10", qty="10"), row("P2", qty="1", changed="x"), row("P2", qty="2", changed="3")]
    run_subject(spark, database, SUBJECT, Run("b1", datetime(2024, 1, 1, tzinfo=timezone.utc)), land(spark, rows, "fc_202401010600"),
                newest_by={"changed_on": "int"})
    silver = spark.table(f"{database}.silver")
    assert rows_of(silver.selectExpr("product_id", "int(forecast_qty)", "is_active", "changed_on")) == [
        ("P1", 10, True, "10"), ("P2", 2, True, "3")]
    assert spark.table(f"{database}.fact").count() == 2
    repeats = spark.table(f"{database}.data_quality_log").filter("check_type = 'DUPLICATE_CHECK'")
    assert sorted(r.records_failed for r in repeats.collect()) == [1, 1]


def test_a_corrected_repeat_leaves_no_stale_rows(spark):
    database = new_database(spark)
    go(spark, database, "b1", 1, land(spark, FIRST, "fc_202401010600"))
    spark.sql(f"TRUNCATE TABLE {database}.job_log")
    go(spark, database, "b1", 1, land(spark, [row()], "fc_202401010600"))
    assert spark.table(f"{database}.quarantine").isEmpty()
    assert spark.table(f"{database}.bronze").count() == 1
    log = spark.table(f"{database}.data_quality_log")
    assert log.count() == 7 and log.filter("records_failed <> 0").isEmpty()


def test_views_after_a_status_update(spark):
    from strata.sources.logs import update_audit_status

    database = new_database(spark)
    go(spark, database, "b1", 1, land(spark, [row()], "fc_202401010600"))
    update_audit_status(spark, f"{database}.pipeline_audit", batch_id="b1", object_name=f"{database}.fact", data_layer="GOLD",
                        job_status="FAILED", error_record_count=7)
    register_views(spark, database)
    assert rows_of(spark.sql("SELECT data_layer, total_jobs, failed_count, total_error_rows FROM vw_daily_load_summary WHERE data_layer = 'GOLD'")) == [("GOLD", 1, 1, 7)]
    assert spark.sql("SELECT * FROM vw_aggregated_audit WHERE source_system IS NOT NULL").count() == 1
    assert rows_of(spark.sql("SELECT job_status FROM vw_latest_pipeline_runs WHERE data_layer = 'GOLD'")) == [("FAILED",)]
