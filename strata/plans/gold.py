"""Silver to Gold: dimensions, calendar, insert-only fact, archive."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import schema
from strata.operators.clean import active_versions, current_batch, enrich_gold
from strata.operators.star import (
    build_dim_time, build_fact, merge_dim_location, merge_dim_product, missing_dates, new_fact_rows,
)
from strata.plans.contract import require_contract
from strata.plans.run import Job, LayerResult
from strata.plans.silver import batch_periods, staged_path, still_open
from strata.sources.sinks import add_missing_columns, append_rows, archive_partitions, balanced, insert_rows, replace_owned
from strata.sources.staging import fingerprint, stage_rows
from strata.sources.versions import merge_version


def in_slices(spark: SparkSession, job: Job, name: str, periods: list[str]) -> DataFrame:
    """The partitions of a table that hold the given periods of the job's frequency."""
    return spark.table(job.table(name)).filter(
        (F.col("_frequency") == job.frequency) & F.col("period").isin(periods))


def silver_batch(spark: SparkSession, job: Job, periods: list[str]) -> DataFrame:
    """Versions this run opened, read from the open partitions it touched."""
    rows = in_slices(spark, job, "silver", periods)
    return current_batch(active_versions(rows), job.run.batch_id)


def open_dimension(spark: SparkSession, job: Job, name: str) -> DataFrame:
    """The slices of a dimension that a merge on this day may change."""
    return spark.table(job.table(name)).filter(
        F.col("effective_to").isNull() | (F.col("effective_to") >= F.lit(job.run.as_of)))


def load_dimensions(spark: SparkSession, job: Job, batch: DataFrame, fiscal_start_month: int = 1) -> None:
    run = job.run
    mark = fingerprint(batch, [*schema.SOURCE_COLUMNS, "_frequency"])
    for name, merge in (("dim_product", merge_dim_product), ("dim_location", merge_dim_location)):
        merge_version(
            spark, job.table(name), lambda values: still_open(values, run.as_of), f"{run.batch_id}/{job.name}/{mark}",
            lambda m=merge, n=name: m(open_dimension(spark, job, n), batch, run.as_of, run.run_ts), lambda _: {}, balanced)
    days = build_dim_time(batch, "forecast_date", fiscal_start_month)
    append_rows(missing_dates(days, spark.table(job.table("dim_time"))), job.table("dim_time"))


def fact_candidates(spark: SparkSession, job: Job, batch: DataFrame) -> DataFrame:
    run = job.run
    facts = build_fact(batch, *[spark.table(job.table(n)) for n in ("dim_product", "dim_location", "dim_time")])
    return enrich_gold(facts, batch_id=run.batch_id, run_ts=run.run_ts)


def archive_silver(batch: DataFrame, job: Job) -> None:
    """Copy the processed rows; Silver itself keeps them, since its history needs them."""
    replace_owned(batch.withColumn("_archived_ts", F.lit(job.run.run_ts)), job.table("silver_archive"),
                  {"_frequency": job.frequency, "_batch_id": job.run.batch_id})


def archive_facts_before(spark: SparkSession, job: Job, period: str) -> int:
    """Move fact partitions of periods before ``period`` to the archive, with columns that the fact has gained."""
    facts = spark.table(job.table("fact"))
    add_missing_columns(facts.select([c for c in facts.columns if c not in schema.FACT.names]), job.table("fact_archive"))
    return archive_partitions(
        spark, job.table("fact"), job.table("fact_archive"), F.col("period") < period, job.run.run_ts)


def load_gold(spark: SparkSession, job: Job, fiscal_start_month: int = 1) -> LayerResult:
    require_contract(spark, job.database, "fact", "silver_archive", "dim_product", "dim_location", "dim_time")
    periods = batch_periods(spark, job)
    batch = stage_rows(silver_batch(spark, job, periods), staged_path(spark, job, f"gold-{uuid.uuid4().hex[:12]}"))
    load_dimensions(spark, job, batch, fiscal_start_month)
    added = batch.select([c for c in batch.columns if c not in schema.SILVER.names])
    for name in ("fact", "silver_archive"):  # columns that the source has newly added
        add_missing_columns(added, job.table(name))
    held = in_slices(spark, job, "fact", periods)
    insert_rows(new_fact_rows(fact_candidates(spark, job, batch), held, schema.FACT_KEY), job.table("fact"), job.subject["num_partitions"])
    archive_silver(batch, job)

    written = in_slices(spark, job, "fact", periods).filter(F.col("_batch_id") == job.run.batch_id)
    return LayerResult("GOLD", "SUCCESS", batch.count(), written.count(), 0, 0)
