"""A subject's run: its configuration row drives the four layers in order."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from strata.plans.bronze import NewestBy, load_bronze
from strata.plans.gold import load_gold
from strata.plans.kpi import load_kpi
from strata.plans.run import Job, LayerResult, Run
from strata.plans.silver import load_silver, staged_path
from strata.schema import table_name
from strata.sources import logs
from strata.sources.config import get_pipeline_metadata
from strata.sources.files import has_source, resolve_path
from strata.sources.staging import clear_staged

TARGETS = {"SILVER": "silver", "GOLD": "fact", "AGGR_AUDIT": "kpi"}
INPUTS = {"GOLD": "silver", "AGGR_AUDIT": "fact"}
Step = tuple[str, Callable[[], LayerResult]]


@dataclass(frozen=True)
class SubjectResult:
    batch_id: str
    status: str
    layers: list[LayerResult]


def _log(spark: SparkSession, job: Job, result: LayerResult, started: datetime, path: str) -> None:
    """Audit entry first; the job-log row is the layer's commit marker and comes last."""
    run, config = job.run, job.subject
    read_from = path if result.layer == "BRONZE" else job.table(INPUTS.get(result.layer, job.bronze))
    logs.write_audit_entry(
        spark, job.table("pipeline_audit"), batch_id=run.batch_id, application_id=run.application_id,
        object_name=job.table(TARGETS.get(result.layer, job.bronze)), data_layer=result.layer, job_status=result.status,
        source_row_count=result.source_rows, target_row_count=result.inserted + result.updated,
        error_record_count=result.errors, source_system=config["source_system"], data_subject=job.name,
        file_name=read_from, load_job_number=run.load_job_nr, job_start_ts=started,
        job_end_ts=datetime.now(timezone.utc))
    logs.write_job_log(
        spark, job.table("job_log"), batch_id=run.batch_id, layer=result.layer, status=result.status,
        insert_time=run.run_ts, records_inserted=result.inserted, records_updated=result.updated,
        source_system=config["source_system"], data_subject=job.name)


def _fail(spark: SparkSession, job: Job, layer: str, started: datetime, error: Exception) -> None:
    run, config = job.run, job.subject
    message = f"{type(error).__name__}: {error}"
    logs.mark_audit_failed(
        spark, job.table("pipeline_audit"), batch_id=run.batch_id, application_id=run.application_id,
        object_name=job.table(TARGETS.get(layer, job.bronze)), data_layer=layer, source_system=config["source_system"], data_subject=job.name,
        load_job_number=run.load_job_nr, job_start_ts=started, job_end_ts=datetime.now(timezone.utc),
        error_message=message)
    logs.write_job_log(
        spark, job.table("job_log"), batch_id=run.batch_id, layer=layer, status="FAILED", insert_time=run.run_ts,
        source_system=config["source_system"], data_subject=job.name, error_message=message)


def run_subject(spark: SparkSession, database: str, data_subject: str, run: Run | None = None,
                source_path: str | None = None, *, mapping: Mapping[str, str] | None = None,
                newest_by: NewestBy = (), archive_root: str | None = None, threshold: float | None = None,
                fiscal_start_month: int = 1) -> SubjectResult:
    """Run Bronze, Silver, Gold and key figures for one batch.

    Layers the job log lists as loaded are skipped, so a failed run is resumed by running it again
    with the same batch id, on any day: it goes on with the day of its first layer and does not need the
    landing folder any more. A failing layer is logged with its message and stops the run. Without
    source rows a NO_DATA entry is logged and no layer starts.
    """
    config = get_pipeline_metadata(spark.table(table_name(database, "pipeline_metadata")), data_subject)
    run = run or Run(application_id=spark.sparkContext.applicationId)
    job = Job(database, config, run)
    path = resolve_path(config["source_path"], source_path)

    loaded = logs.loaded_layers(spark, job.table("job_log"), run.batch_id, job.name)
    if "BRONZE" in loaded:
        job = replace(job, run=replace(run, day=loaded["BRONZE"].day))
    elif not has_source(spark, path, config["file_format"], config["delimiter"], config["has_header"]):
        logs.log_no_data(
            spark, job.table("pipeline_audit"), batch_id=run.batch_id, application_id=run.application_id,
            object_name=path, source_system=config["source_system"], data_subject=job.name,
            load_job_number=run.load_job_nr, job_start_ts=run.run_ts, job_end_ts=run.run_ts)
        return SubjectResult(run.batch_id, "NO_DATA", [])

    rows = {layer: entry.inserted for layer, entry in loaded.items()}
    done = run_steps(spark, job, path, loaded, rows, [
        ("BRONZE", lambda: load_bronze(
            spark, job, path, mapping=mapping, newest_by=newest_by, archive_root=archive_root)),
        ("SILVER", lambda: load_silver(spark, job, threshold, newest_by, rows["BRONZE"])),
        ("GOLD", lambda: load_gold(spark, job, fiscal_start_month)),
        ("AGGR_AUDIT", lambda: load_kpi(spark, job)),
    ])
    return SubjectResult(run.batch_id, "SUCCESS", done)


def run_steps(spark: SparkSession, job: Job, path: str, loaded: Mapping[str, logs.Loaded], rows: dict[str, int],
              steps: list[Step]) -> list[LayerResult]:
    """Run the layers that are not loaded yet and log each, also a failing one; ``rows`` tells what each has written."""
    done = []
    for layer, step in steps:
        if layer in loaded:
            done.append(LayerResult(layer, "SKIPPED"))
            continue
        started = datetime.now(timezone.utc)
        try:
            result = step()
        except Exception as error:
            _fail(spark, job, layer, started, error)
            raise
        _log(spark, job, result, started, path)
        done.append(result)
        rows[layer] = result.inserted
    clear_staged(spark, staged_path(spark, job))
    return done
