"""Gold to key-figure rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.clean import current_batch
from strata.operators.kpi import PERIOD_GROUP, kpi_rows, parse_list, stamp_kpi
from strata.plans.contract import require_contract
from strata.plans.gold import in_slices
from strata.plans.run import Job, LayerResult
from strata.plans.silver import batch_periods
from strata.sources.sinks import write_slice


def kpi_frame(facts: DataFrame, job: Job) -> DataFrame:
    """Rows by the configured group columns and by period, category, region and frequency."""
    config, run = job.subject, job.run
    metrics = parse_list(config["metric_columns"])
    by_config = kpi_rows(facts, parse_list(config["group_columns"]), metrics)
    by_period = kpi_rows(facts, PERIOD_GROUP, metrics)
    return stamp_kpi(
        by_config.unionByName(by_period, allowMissingColumns=True), data_subject=job.name,
        ld_jb_nr=run.load_job_nr, batch_id=run.batch_id, ins_ts=run.run_ts)


def load_kpi(spark: SparkSession, job: Job) -> LayerResult:
    require_contract(spark, job.database, "kpi")
    facts = in_slices(spark, job, "fact", batch_periods(spark, job))
    batch = current_batch(facts, job.run.batch_id)
    write_slice(kpi_frame(batch, job), job.table("kpi"))
    written = spark.table(job.table("kpi")).filter(
        (F.col("data_subject") == job.name) & (F.col("_batch_id") == job.run.batch_id))
    return LayerResult("AGGR_AUDIT", "SUCCESS", batch.count(), written.count(), 0, 0)
