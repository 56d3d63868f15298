"""Key figures, dimensions and run-log reports on small inputs."""

import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from conftest import rows_of
from strata.operators import kpi, monitor, star


def test_file_totals_and_unpivot(spark):
    df = spark.createDataFrame(
        [("file1.csv", 100.0, 5000.0), ("file1.csv", 200.0, 10000.0), ("file2.csv", 50.0, 2500.0)],
        "fl_nm string, forecast_qty double, revenue_amount double").withColumn(
            "_ingestion_ts", F.lit(datetime(2024, 1, 1)))
    rows = kpi.kpi_rows(df, ["fl_nm"], ["forecast_qty", "revenue_amount", "absent"]).drop("load_date")
    assert rows_of(rows) == [
        ("file1.csv", 2, "forecast_qty", 300.0), ("file1.csv", 2, "revenue_amount", 15000.0),
        ("file2.csv", 1, "forecast_qty", 50.0), ("file2.csv", 1, "revenue_amount", 2500.0)]


def test_count_only_fallback(spark):
    df = spark.createDataFrame([("f", datetime(2024, 1, 1))], "_file_name string, _ingestion_ts timestamp")
    row = kpi.kpi_rows(df, ["_file_name"], ["absent"]).first()
    assert (row.file_name, row.no_of_records, row.keyfigure, row.total_qty_amount) == ("f", 1, "", None)


def test_parse_list():
    assert kpi.parse_list(" a, b,,c ") == ["a", "b", "c"]
    assert kpi.parse_list(None) == []


def test_calendar(spark):
    df = spark.createDataFrame([(date(2024, 12, 30),), (date(2024, 12, 30),), (date(2023, 7, 1),), (None,)],
                               "forecast_date date")
    days = {r.date_key: r for r in star.build_dim_time(df, fiscal_start_month=7).collect()}
    assert len(days) == 2
    monday = days[date(2024, 12, 30)]
    assert (monday.time_key, monday.quarter, monday.week_of_year, monday.day_of_week) == (20241230, 4, 1, 1)
    assert (monday.month_name, monday.day_name, monday.is_weekend) == ("December", "Monday", False)
    assert (monday.fiscal_year, monday.fiscal_quarter, monday.period) == (2025, 2, "2024-12-01")
    assert (days[date(2023, 7, 1)].fiscal_year, days[date(2023, 7, 1)].fiscal_quarter) == (2024, 1)
    assert days[date(2023, 7, 1)].is_weekend


def test_latest_attributes_per_key(spark):
    df = spark.createDataFrame(
        [("p", "A", "x", 1), ("p", "B", "y", 2), ("p", "B", "z", 2), ("q", None, None, 1)],
        "product_id string, category string, sub_category string, _ingestion_ts int")
    got = rows_of(star.latest_per_key(df, "product_id", ["category", "sub_category"]))
    assert got == [("p", "B", "z"), ("q", None, None)]


def test_new_fact_rows_treats_null_channels_as_equal(spark):
    columns = ("product_id string, location_id string, forecast_date date, channel string, _frequency string,"
               " period string, n int")
    d = date(2024, 1, 15)
    held = spark.createDataFrame([("p", "l", d, None, "daily", "2024-01-01", 1)], columns)
    new = spark.createDataFrame([
        ("p", "l", d, None, "daily", "2024-01-01", 2), ("p", "l", d, "ONLINE", "daily", "2024-01-01", 3)], columns)
    assert [r.n for r in star.new_fact_rows(new, held).collect()] == [3]


def test_previous_value_matches_brute_force_on_a_hot_object(spark):
    rng = random.Random(5)
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(600):
        name = "hot" if i % 3 else f"o{i % 7}"
        rows.append((name, start + timedelta(seconds=rng.randrange(0, 7200, 20)), f"b{i:04d}",
                     None if rng.random() < 0.1 else rng.randrange(100)))
    df = spark.createDataFrame(rows, "object_name string, job_start_ts timestamp_ntz, batch_id string, n int")
    got = {r.batch_id: r.prev for r in monitor.with_previous(
        df, ["object_name"], ["job_start_ts", "batch_id"], "n", "prev").collect()}
    last, expected = {}, {}
    for name, _, batch, n in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        expected[batch] = last.get(name)
        last[name] = n
    assert got == expected


def test_reconcile_and_completeness(spark):
    columns = ("batch_id string, data_layer string, job_status string, source_row_count bigint,"
               " target_row_count bigint, error_record_count bigint")
    rows = [("a", layer, "SUCCESS", 10, 8 if layer == "BRONZE" else 10, 2 if layer == "BRONZE" else 0)
            for layer in ("BRONZE", "SILVER", "GOLD", "AGGR_AUDIT")]
    rows += [("b", "BRONZE", "SUCCESS", 10, 10, 0), ("b", "SILVER", "FAILED", 10, 5, 1)]
    log = spark.createDataFrame(rows, columns)
    checked = {r.batch_id: r for r in monitor.reconcile(log).collect()}
    assert checked["a"].unbalanced_layers == 0 and checked["a"].gold_matches_silver
    assert checked["b"].unbalanced_layers == 1 and checked["b"].gold_matches_silver is None
    assert {r.batch_id: r.is_complete for r in monitor.batch_complete(log).collect()} == {"a": True, "b": False}


def test_freshness(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1),)], "ts timestamp_ntz")
    now = F.lit("2024-01-02 00:00:01").cast("timestamp_ntz")
    assert monitor.freshness(df, "ts", 24, now).first().is_stale
    assert not monitor.freshness(df, "ts", 25, now).first().is_stale
    assert monitor.freshness(df.limit(0), "ts", 24, now).first().is_stale
