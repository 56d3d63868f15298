from datetime import datetime

import pytest

from conftest import rows_of
from strata import schema
from strata.functions.checks import castable
from strata.operators import clean, quality

COLUMNS = "product_id string, location_id string, forecast_date string, forecast_qty string, revenue_amount string"
KEYS = ["product_id", "location_id", "forecast_date"]


@pytest.fixture(scope="module")
def sample(spark):
    return spark.createDataFrame([
        ("SKU-77", "WH-3", "2022-09-02", "12", "34.5"),
        ("SKU-78", "WH-3", "2022-09-02", "", None),
        (None, "WH-4", "2022-10-30", "1", "2"),
        ("  ", "WH-4", "2022-10-31", "7", "8.25"),
        ("SKU-80", None, "2022-11-05", "3", "1"),
        ("SKU-81", "WH-5", "", "4", "4.40"),
        ("SKU-81", " ", "", "5", "5"),
        ("SKU-82", "WH-6", "2023-02-28", "6", "6.06"),
    ], COLUMNS)


def test_key_split(sample):
    valid, invalid = quality.validate_not_null(sample, KEYS)
    assert [r[0] for r in rows_of(valid.select("product_id"))] == ["SKU-77", "SKU-78", "SKU-82"]
    assert invalid.count() == 5


def test_key_split_single_column(sample):
    assert quality.validate_not_null(sample, ["product_id"])[1].count() == 2


def test_key_split_ignores_unknown_columns_and_accepts_all_without_columns(sample):
    assert quality.validate_not_null(sample, ["product_id", "nope"])[1].count() == 2
    assert quality.validate_not_null(sample, [])[0].count() == 8
    assert quality.validate_not_null(sample, [])[1].count() == 0


def test_key_split_three_rows(spark):
    df = spark.createDataFrame(
        [("P1", "L1", "2025-01-01"), (None, "L2", "2025-01-01"), ("P3", None, None)],
        "product_id string, location_id string, forecast_date string")
    valid, invalid = quality.validate_not_null(df, KEYS)
    assert (valid.count(), invalid.count()) == (1, 2)


def test_blank_key_of_spaces_is_missing(spark):
    df = spark.createDataFrame([("   ",), ("a ",)], "product_id string")
    assert quality.validate_not_null(df, ["product_id"])[1].count() == 1


def test_nullify(sample):
    rows = {r.revenue_amount: r for r in clean.nullify_empty_strings(sample).collect()}
    assert rows["4.40"].forecast_date is None
    assert rows["34.5"].location_id == "WH-3"
    assert rows[None].forecast_qty is None


def test_nullify_leaves_other_types_and_inner_blanks(spark):
    df = spark.createDataFrame([(1, "  "), (2, " DIRECT")], "n int, channel string")
    assert rows_of(clean.nullify_empty_strings(df)) == [(1, None), (2, " DIRECT")]


def test_type_split(spark):
    df = spark.createDataFrame(
        [("2025-01-15", "1"), ("not-a-date", "1"), (None, None), ("2025-01-15", "x")], "forecast_date string, q string")
    valid, invalid = quality.validate_data_types(df, {"forecast_date": "date", "q": "decimal(18,4)", "nope": "int"})
    assert (valid.count(), invalid.count()) == (2, 2)
    assert castable({}) is not None


def test_range_and_allowlists_count_but_keep(spark):
    df = spark.createDataFrame(
        [("SERVER", "USD", -100.0), ("LEGACY_HW", "XX", 5.0), (None, None, None)],
        "category string, currency string, forecast_qty double")
    counts = {r.check_type: (r.records_checked, r.records_failed)
              for r in quality.count_violations(df, quality.business_rules()).collect()}
    assert counts == {"CATEGORY_VALIDATION": (3, 1), "CURRENCY_VALIDATION": (3, 1), "RANGE_CHECK": (3, 1)}
    flags = [r._dq_flags for r in quality.flag_violations(df, quality.business_rules()).collect()]
    assert flags == [["RANGE_CHECK"], ["CATEGORY_VALIDATION", "CURRENCY_VALIDATION"], []]


def test_gate(spark):
    def results(failed):
        return spark.createDataFrame(
            [("NULL_CHECK", "product_id", 100, failed), ("EMPTY", "x", 0, 0)],
            "check_type string, column_name string, records_checked bigint, records_failed bigint")

    quality.gate(results(5), 0.95)
    with pytest.raises(quality.QualityGateError, match="NULL_CHECK"):
        quality.gate(results(6), 0.95)


def test_pass_rate_is_100_when_nothing_was_checked(spark):
    log = spark.createDataFrame(
        [("b", "t", "NULL_CHECK", "c", 0, 0, "PASSED", None, datetime(2024, 1, 1))], schema.DQ_LOG)
    assert float(quality.dq_summary(log).first().pass_rate_pct) == 100.0


def test_unknown_reason(spark):
    df = spark.createDataFrame([("NULL_PK",), ("OTHER",), (None,)], "_dq_fail_reason string")
    assert quality.unknown_reasons(df).count() == 2


def test_schema_contract(spark):
    df = spark.createDataFrame([("a", 1)], "product_id string, forecast_date int")
    problems = quality.check_schema(df, schema.SILVER)
    assert "forecast_date: int instead of date" in problems
    assert "effective_from: missing" in problems
    assert not [p for p in problems if p.startswith("product_id")]


def test_standardize_and_align(spark):
    df = spark.createDataFrame([(" P1 ", " server", "x")], "Product__c string, category string, extra string")
    row = clean.standardize(clean.align_columns(df, {"Product__c": "product_id"})).first()
    assert (row.product_id, row.category, row.extra, row.customer_id) == ("P1", "SERVER", "x", None)


def test_period(spark):
    df = spark.createDataFrame([("2019-05-31",), (None,), ("2020-02-29",), ("2021-11-01",)], "forecast_date string")
    assert [r.period for r in clean.derive_period(df).collect()] == ["2019-05-01", None, "2020-02-01", "2021-11-01"]
    assert [r.period for r in clean.derive_period(df, apply_concat=False).collect()][0] == "2019-05-31"
    assert clean.derive_period(df, "absent").columns == ["forecast_date"]


def test_gate_passes_at_the_threshold_exactly(spark):
    rows = spark.createDataFrame(
        [(100, 7, "equal"), (100, 8, "under"), (0, 0, "nothing"), (10**15, 7 * 10**13 + 1, "one under")],
        "records_checked long, records_failed long, check_type string")
    assert {r.check_type for r in quality.below_threshold(rows, 0.93).collect()} == {"under", "one under"}
