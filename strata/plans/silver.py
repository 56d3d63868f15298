"""Bronze to Silver: type, check, keep history, aggregate by period."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import schema
from strata.functions.checks import castable
from strata.operators.clean import (
    cast_columns, conform, current_batch, derive_period, enrich_silver, nullify_empty_strings,
)
from strata.operators.dedup import dedup_newest
from strata.operators.kpi import period_aggregate
from strata.operators.quality import (
    Rule, business_rules, count_violations, flag_violations, gate, quarantine, validate_data_types,
)
from strata.operators.scd2 import ACTION, CHANGED, NEW, scd2_merge
from strata.plans.bronze import NewestBy
from strata.plans.contract import require_contract
from strata.plans.run import Job, LayerResult
from strata.sources import logs
from strata.sources.sinks import add_missing_columns, bounded, partition_values, replace_owned
from strata.sources.staging import fingerprint, stage_rows, staging_path
from strata.sources.versions import merge_version


def bronze_batch(spark: SparkSession, job: Job) -> DataFrame:
    """This batch's Bronze slice, found by its partitions, with blanks as NULL."""
    rows = spark.table(job.table(job.bronze)).filter(F.col("_frequency") == job.frequency)
    return nullify_empty_strings(current_batch(rows, job.run.batch_id))


def silver_rows(castable_rows: DataFrame, job: Job, newest_by: NewestBy = ()) -> DataFrame:
    """Typed, stamped and flagged rows, not versioned yet; one per key, also where texts spell a key in two ways."""
    config, run = job.subject, job.run
    if config["partition_column"] not in schema.MATCH_KEY:
        raise ValueError("the partition column must be part of the match key, or one key would lie in two periods")
    typed = dedup_newest(cast_columns(castable_rows), newest_by)
    stamped = enrich_silver(typed, batch_id=run.batch_id, run_ts=run.run_ts)
    flagged = flag_violations(stamped, business_rules())
    return derive_period(flagged, config["partition_column"], config["apply_concat"])


def staged_path(spark: SparkSession, job: Job, name: str = "") -> str:
    """The folder of a batch's staged copies."""
    return staging_path(spark, job.database, f"{job.run.batch_id}-{job.frequency}", *([name] if name else []))


def check_rows(nullified: DataFrame) -> DataFrame:
    """Counts of the type check on all rows and of the business rules on castable ones."""
    types = schema.TYPED_COLUMNS
    marked = nullified.withColumn("_castable", castable(types))
    business = [Rule(r.check_type, r.column, r.failed, F.col("_castable")) for r in business_rules()]
    return count_violations(
        cast_columns(marked), [Rule("FORMAT_CHECK", ",".join(types), ~F.col("_castable")), *business])


def batch_periods(spark: SparkSession, job: Job) -> list[str]:
    """The months of this batch, from its aggregate: a short list that prunes later table reads."""
    totals = spark.table(job.table("period_agg")).filter(
        (F.col("_frequency") == job.frequency) & (F.col("_batch_id") == job.run.batch_id))
    return [v["period"] for v in partition_values(totals, ["period"])]


def touched_versions(spark: SparkSession, job: Job, periods: list[str]) -> DataFrame:
    """The Silver slices a merge may change: the batch's periods, open or closed on this day or later."""
    return spark.table(job.table("silver")).filter(
        (F.col("_frequency") == job.frequency) & F.col("period").isin(periods)
        & (F.col("effective_to").isNull() | (F.col("effective_to") >= F.lit(job.run.as_of))))


def write_period_totals(job: Job, incoming: DataFrame) -> None:
    totals = period_aggregate(incoming).withColumns({
        "_silver_load_ts": F.lit(job.run.run_ts), "_batch_id": F.lit(job.run.batch_id)})
    replace_owned(conform(totals, schema.PERIOD_AGG), job.table("period_agg"),
                  {"_frequency": job.frequency, "_batch_id": job.run.batch_id})


def merge_silver(spark: SparkSession, job: Job, incoming: DataFrame) -> dict[str, int]:
    """Merge one row per key into Silver; returns the number of keys per action.

    The batch's period totals have been written before and tell which slices the merge touches. A resumed run
    finds what it has published, and builds anew what it has not, also where other batches came in between.
    """
    run = job.run

    def merged() -> DataFrame:
        return scd2_merge(
            touched_versions(spark, job, periods), incoming, schema.MATCH_KEY, schema.TRACKED, run.as_of,
            on_close={"_update_ts": F.lit(run.run_ts)}, with_action=True)

    def opened(rows: DataFrame) -> dict[str, int]:
        new = rows.filter((F.col("effective_from") == F.lit(run.as_of)) & F.col(ACTION).isin(NEW, CHANGED))
        return {r[ACTION]: r["count"] for r in new.groupBy(ACTION).count().collect()}

    def touched(values: Mapping[str, str | None]) -> bool:
        return values["_frequency"] == job.frequency and values["period"] in periods and still_open(values, run.as_of)

    add_missing_columns(incoming, job.table("silver"))
    periods = batch_periods(spark, job)
    mark = fingerprint(incoming, [*schema.SOURCE_COLUMNS, "_frequency"])
    return merge_version(spark, job.table("silver"), touched, f"{run.batch_id}/{job.name}/{mark}", merged, opened,
                         bounded(job.subject["num_partitions"]), (ACTION,))


def still_open(values: Mapping[str, str | None], day: date) -> bool:
    """Whether a slice of ended or open versions is one that a merge on this day may change."""
    return values["effective_to"] is None or values["effective_to"] >= day.isoformat()


def load_silver(spark: SparkSession, job: Job, threshold: float | None = None, newest_by: NewestBy = (),
                expected: int | None = None) -> LayerResult:
    """``threshold`` stops the run before anything is written when a check's pass rate is lower; ``expected``
    is the number of rows that Bronze logged, and the run stops if others are found."""
    run = job.run
    require_contract(spark, job.database, "silver", "period_agg", "quarantine")
    nullified = bronze_batch(spark, job)
    valid, invalid = validate_data_types(nullified, schema.TYPED_COLUMNS)
    incoming = stage_rows(silver_rows(valid, job, newest_by), staged_path(spark, job, f"typed-{uuid.uuid4().hex[:12]}"))
    counts = check_rows(nullified).collect()
    checked = next(r for r in counts if r.check_type == "FORMAT_CHECK")
    if expected is not None and checked.records_checked != expected:
        raise RuntimeError(f"Bronze logged {expected} rows of batch {run.batch_id}, found {checked.records_checked}")
    unique, castable_rows = incoming.count(), checked.records_checked - checked.records_failed
    repeats = ("DUPLICATE_CHECK", ",".join(schema.MATCH_KEY), castable_rows, castable_rows - unique)
    measured = spark.createDataFrame(
        [*map(tuple, counts), repeats], "check_type string, column_name string, records_checked bigint, records_failed bigint")
    logs.log_dq_counts(measured, job.table("data_quality_log"), batch_id=run.batch_id, data_subject=job.name,
                       table_name=job.table("silver"), created_ts=run.run_ts)
    if threshold is not None:
        gate(measured.filter("check_type <> 'DUPLICATE_CHECK'"), threshold)

    replace_owned(quarantine(invalid, "TYPE_ERROR"), job.table("quarantine"), {
        "_frequency": job.frequency, "_batch_id": run.batch_id, "_dq_fail_reason": "TYPE_ERROR"})
    write_period_totals(job, incoming)
    actions = merge_silver(spark, job, incoming)
    return LayerResult("SILVER", "SUCCESS", checked.records_checked, actions.get(NEW, 0), actions.get(CHANGED, 0),
                       checked.records_failed + castable_rows - unique)
