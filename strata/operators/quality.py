"""Data-quality splits, counts and reports."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import schema
from strata.functions import checks
from strata.operators.clean import existing


def _split(df: DataFrame, good: Column) -> tuple[DataFrame, DataFrame]:
    return df.filter(good), df.filter(~good)


def validate_not_null(df: DataFrame, columns: Iterable[str]) -> tuple[DataFrame, DataFrame]:
    """(complete, incomplete) rows. Unknown columns are ignored; an empty list accepts every row."""
    return _split(df, checks.keys_present(existing(df, columns)))


def validate_data_types(df: DataFrame, expected_schema: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """(castable, not castable) rows for ``{column: type}``. NULL counts as castable."""
    known = {c: expected_schema[c] for c in existing(df, expected_schema)}
    return _split(df, checks.castable(known))


def quarantine(df: DataFrame, reason: str) -> DataFrame:
    return df.withColumn("_dq_fail_reason", F.lit(reason))


@dataclass(frozen=True)
class Rule:
    """``failed`` is TRUE where a row breaks the rule; ``applies`` limits the rows it is checked on."""

    check_type: str
    column: str
    failed: Column
    applies: Column | None = None

    @property
    def in_scope(self) -> Column:
        return F.lit(True) if self.applies is None else self.applies


def check_allowed(check_type: str, column: str, values: Iterable[str]) -> Rule:
    """NULL is not counted as a violation."""
    return Rule(check_type, column, checks.not_allowed(F.col(column), values))


def check_range(check_type: str, column: str, low=None, high=None) -> Rule:
    return Rule(check_type, column, checks.out_of_range(F.col(column), low, high))


def business_rules() -> list[Rule]:
    return [
        check_allowed("CATEGORY_VALIDATION", "category", schema.VALID_CATEGORIES),
        check_allowed("CURRENCY_VALIDATION", "currency", schema.VALID_CURRENCIES),
        check_range("RANGE_CHECK", "forecast_qty", low=0),
    ]


def flag_violations(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Keep every row and list the check types it breaks in ``_dq_flags``."""
    flags = [F.when(r.failed, F.lit(r.check_type)) for r in rules]
    return df.withColumn("_dq_flags", F.array_compact(F.array(*flags)))


def count_violations(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """One row per rule with ``records_checked`` and ``records_failed``, from a single aggregate."""
    rules = list(rules)
    counts = [
        c
        for i, r in enumerate(rules)
        for c in (F.count_if(r.in_scope).alias(f"_c{i}"), F.count_if(r.in_scope & r.failed).alias(f"_f{i}"))
    ]
    entries = F.array(*[
        F.struct(F.lit(r.check_type).alias("check_type"), F.lit(r.column).alias("column_name"),
                 F.col(f"_c{i}").alias("records_checked"), F.col(f"_f{i}").alias("records_failed"))
        for i, r in enumerate(rules)
    ])
    return df.agg(*counts).select(F.inline(entries))


def check_status(failed: Column) -> Column:
    return F.when(failed == 0, "PASSED").otherwise("FAILED")


def dq_log_rows(counts: DataFrame, *, batch_id: str, table_name: str, created_ts: datetime) -> DataFrame:
    """Log rows from rule counts; a check passes only when nothing failed."""
    return counts.select(
        F.lit(batch_id).alias("batch_id"),
        F.lit(table_name).alias("table_name"),
        "check_type", "column_name", "records_checked", "records_failed",
        check_status(F.col("records_failed")).alias("check_status"),
        F.lit(None).cast("string").alias("error_message"),
        F.lit(created_ts).cast("timestamp").alias("created_ts"),
    )


def _pass_rate(checked: Column, failed: Column) -> Column:
    rate = (1 - F.try_divide(failed.cast("double"), checked)) * 100
    return F.when(checked > 0, rate).otherwise(F.lit(100.0)).cast("decimal(5,2)")


def dq_summary(log: DataFrame) -> DataFrame:
    """Totals and pass rate per day, table and check."""
    return (
        log.groupBy(F.to_date("created_ts").alias("check_date"), "table_name", "check_type")
        .agg(F.sum("records_checked").alias("total_checked"), F.sum("records_failed").alias("total_failed"))
        .withColumn("pass_rate_pct", _pass_rate(F.col("total_checked"), F.col("total_failed")))
    )


def dq_by_batch(log: DataFrame) -> DataFrame:
    """Checked, passed and failed rows per batch and check, with the pass rate."""
    return (
        log.groupBy("batch_id", "table_name", "check_type")
        .agg(F.sum("records_checked").alias("records_checked"), F.sum("records_failed").alias("records_failed"))
        .withColumns({
            "records_passed": F.col("records_checked") - F.col("records_failed"),
            "pass_rate_pct": _pass_rate(F.col("records_checked"), F.col("records_failed")),
        })
    )


class QualityGateError(RuntimeError):
    """Raised when a check's pass rate is under the threshold."""


def below_threshold(results: DataFrame, threshold: float) -> DataFrame:
    """The checks whose pass rate is under ``threshold`` (0..1)."""
    checked, failed = F.col("records_checked"), F.col("records_failed")
    # Exact decimals: 7 of 100 failed is a rate of 0.93, which passes at 0.93.
    least = F.lit(str(threshold)).cast("decimal(10,8)") * checked.cast("bigint")
    return results.filter((checked - failed).cast("bigint") < least)


def gate(results: DataFrame, threshold: float) -> None:
    """Stop the run when a check is under the threshold. ``results`` holds one row per check."""
    broken = [f"{r.check_type}({r.column_name})" for r in below_threshold(results, threshold).collect()]
    if broken:
        raise QualityGateError(f"pass rate under {threshold}: {', '.join(sorted(broken))}")


def mixed_case(df: DataFrame, column: str = "category") -> DataFrame:
    return df.filter(F.col(column) != F.upper(column))


def duplicate_keys(df: DataFrame, keys: Iterable[str] = schema.MATCH_KEY) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).filter(F.col("cnt") > 1)


def null_keys(df: DataFrame, keys: Iterable[str] = schema.BUSINESS_KEY) -> DataFrame:
    return validate_not_null(df, keys)[1]


def unknown_reasons(df: DataFrame) -> DataFrame:
    """Quarantined rows without a known reason."""
    known = F.col("_dq_fail_reason").isin(*schema.FAIL_REASONS)
    return df.filter(~F.coalesce(known, F.lit(False)))


def check_schema(df: DataFrame, expected: T.StructType) -> list[str]:
    """Differences from the layer's contract: missing columns and other types."""
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for field in expected.fields:
        if field.name not in have:
            problems.append(f"{field.name}: missing")
        elif have[field.name] != field.dataType:
            problems.append(
                f"{field.name}: {have[field.name].simpleString()} instead of {field.dataType.simpleString()}"
            )
    return problems
