"""Landing to Bronze: read, standardise, split incomplete rows off, deduplicate, replace the slice."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import schema
from strata.operators.clean import align_columns, enrich_bronze, standardize
from strata.operators.dedup import dedup_newest
from strata.operators.kpi import parse_list
from strata.operators.quality import quarantine, validate_not_null
from strata.plans.contract import require_contract
from strata.plans.run import Job, LayerResult
from strata.sources import logs
from strata.sources.files import read_landing, resolve_path
from strata.sources.sinks import add_missing_columns, archive_batch, replace_owned


def bronze_rows(landing: DataFrame, job: Job, mapping: Mapping[str, str]) -> DataFrame:
    run = job.run
    aligned = align_columns(landing, mapping)
    enriched = enrich_bronze(
        aligned, batch_id=run.batch_id, load_job_nr=run.load_job_nr, frequency=job.frequency, run_ts=run.run_ts)
    return standardize(enriched)


NewestBy = Mapping[str, str] | Sequence[str]


def split_bronze(rows: DataFrame, key: Sequence[str], newest_by: NewestBy) -> tuple[DataFrame, DataFrame]:
    """(one complete row per match key, incomplete rows)."""
    valid, invalid = validate_not_null(rows, key)
    return dedup_newest(valid, newest_by), quarantine(invalid, "NULL_PK")


def load_bronze(spark: SparkSession, job: Job, source_path: str | None = None, *,
                mapping: Mapping[str, str] | None = None, newest_by: NewestBy = (),
                archive_root: str | None = None) -> LayerResult:
    """``newest_by`` names source columns (with types, if they are not to be compared as text) that tell
    which duplicate is the latest.

    Row counts are taken from what was written, so a task that ran twice is not counted twice.
    """
    config = job.subject
    path = resolve_path(config["source_path"], source_path)
    landing = read_landing(spark, path, config["file_format"], config["delimiter"], config["has_header"])
    return load_landing(spark, job, landing, mapping=mapping, newest_by=newest_by, archive_root=archive_root)


def load_landing(spark: SparkSession, job: Job, landing: DataFrame, *, mapping: Mapping[str, str] | None = None,
                 newest_by: NewestBy = (), archive_root: str | None = None) -> LayerResult:
    """Bronze from landing rows, however they were found."""
    config, run = job.subject, job.run
    rows = bronze_rows(landing, job, mapping or {})
    key = parse_list(config["null_check_columns"])
    kept, rejected = split_bronze(rows, key, newest_by)

    bronze, rejects = job.table(job.bronze), job.table("quarantine")
    require_contract(spark, job.database, job.bronze, "quarantine")
    add_missing_columns(kept, bronze)
    owned = {"_frequency": job.frequency, "_batch_id": run.batch_id}
    replace_owned(rejected, rejects, {**owned, "_dq_fail_reason": "NULL_PK"})
    replace_owned(kept, bronze, owned, config["num_partitions"])
    if archive_root is not None:
        archive_batch(landing, archive_root, job.name, run.load_job_nr)

    source = landing.count()
    inserted = spark.table(bronze).filter(
        (F.col("_frequency") == job.frequency) & (F.col("_batch_id") == run.batch_id)).count()
    errors = spark.table(rejects).filter(
        (F.col("_frequency") == job.frequency) & (F.col("_batch_id") == run.batch_id)
        & (F.col("_dq_fail_reason") == "NULL_PK")).count()
    checks = [("NULL_CHECK", ",".join(key), source, errors),
              ("DUPLICATE_CHECK", ",".join(schema.MATCH_KEY), source - errors, source - errors - inserted)]
    counts = spark.createDataFrame(
        checks, "check_type string, column_name string, records_checked bigint, records_failed bigint")
    logs.log_dq_counts(counts, job.table("data_quality_log"), batch_id=run.batch_id, table_name=bronze,
                       data_subject=job.name, created_ts=run.run_ts)
    return LayerResult("BRONZE", "SUCCESS", source, inserted, 0, source - inserted)
