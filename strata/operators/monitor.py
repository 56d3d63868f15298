"""Reports over the run log and the data-quality log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata import schema
from strata.operators.dedup import one_per_key

RUN_COLUMNS = [
    "batch_id", "object_name", "data_layer", "job_status", "source_row_count", "target_row_count",
    "error_record_count", "job_duration_sec", "job_start_ts", "job_end_ts", "file_name", "source_system",
]


def last_days(df: DataFrame, ts: str, as_of: Column, days: int) -> DataFrame:
    """Rows at or after ``as_of - days``; the column stays bare so the scan can skip."""
    return df.filter(F.col(ts) >= as_of - F.make_dt_interval(F.lit(days)))


def latest_runs(log: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    return last_days(log, "job_start_ts", as_of, days).select(*[c for c in RUN_COLUMNS if c in log.columns])


def daily_load_summary(log: DataFrame) -> DataFrame:
    return log.groupBy(F.to_date("job_start_ts").alias("load_date"), "data_layer").agg(
        F.count(F.lit(1)).alias("total_jobs"),
        F.count_if(F.col("job_status") == "SUCCESS").alias("success_count"),
        F.count_if(F.col("job_status") == "FAILED").alias("failed_count"),
        F.sum("source_row_count").alias("total_source_rows"),
        F.sum("target_row_count").alias("total_target_rows"),
        F.sum("error_record_count").alias("total_error_rows"),
        F.avg("job_duration_sec").alias("avg_duration_sec"),
    )


def aggregated_audit(log: DataFrame, metadata: DataFrame) -> DataFrame:
    """Gold runs with the key figures of their data subject (one configuration row per subject)."""
    config = metadata.select("data_subject", F.col("metric_columns").alias("keyfigures"))
    gold = log.filter(F.col("data_layer") == "GOLD").withColumnRenamed("object_name", "table_name")
    return gold.join(config, "data_subject", "left")


def failed_runs(log: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    return last_days(log, "job_start_ts", as_of, days).filter(F.col("job_status") == "FAILED").orderBy(
        F.col("job_start_ts").desc(), "batch_id", "object_name")


def runs_today(log: DataFrame, as_of: Column) -> DataFrame:
    """Runs started on the day of ``as_of``, newest first."""
    day = F.date_trunc("day", as_of)
    today = (F.col("job_start_ts") >= day) & (F.col("job_start_ts") < day + F.expr("INTERVAL 1 DAY"))
    return log.filter(today).orderBy(F.col("job_start_ts").desc(), "batch_id", "object_name")


def batch_layers(log: DataFrame, batch_id: str) -> DataFrame:
    return log.filter(F.col("batch_id") == batch_id).orderBy("job_start_ts", "data_layer")


def batch_complete(log: DataFrame) -> DataFrame:
    """Per batch: the number of the four layers that logged a run, and whether all succeeded."""
    seen = [F.bool_or(F.col("data_layer") == layer) for layer in schema.LAYERS]
    layers = sum((s.cast("int") for s in seen), F.lit(0))
    return log.groupBy("batch_id").agg(
        layers.alias("layers"),
        F.count_if(F.col("job_status") != "SUCCESS").alias("not_successful"),
    ).withColumn("is_complete", (F.col("layers") == len(schema.LAYERS)) & (F.col("not_successful") == 0))


def newest_entry(log: DataFrame, layer: str) -> DataFrame:
    """The one newest entry of a layer: a sort of the best row of each task, no window."""
    newest = [F.col(c).desc_nulls_last() for c in ("job_end_ts", "job_start_ts", "batch_id", "object_name")]
    return log.filter(F.col("data_layer") == layer).orderBy(*newest).limit(1)


def latest_status(log: DataFrame) -> DataFrame:
    """The newest entry per object and layer."""
    order = [F.col("job_end_ts").desc(), F.col("job_start_ts").desc(), F.col("batch_id").desc()]
    return one_per_key(log, ["object_name", "data_layer"], order)


def merge_status_updates(log: DataFrame) -> DataFrame:
    """Resolve appended status updates: per (batch, object, layer) the newest status and end time, the
    first start, and the newest count that is not NULL."""
    at = F.struct("updated_ts", "job_end_ts")

    def newest(name: str) -> Column:
        return F.max(F.when(F.col(name).isNotNull(), F.struct(at.alias("at"), F.col(name)))).getField(name)

    counts = ["source_row_count", "target_row_count", "error_record_count"]
    resolved = log.groupBy("batch_id", "object_name", "data_layer").agg(
        F.min("job_start_ts").alias("job_start_ts"),
        newest("job_end_ts").alias("job_end_ts"),
        newest("job_status").alias("job_status"),
        *[newest(c).alias(c) for c in counts],
    )
    return resolved.withColumn(
        "job_duration_sec", F.timestamp_diff("SECOND", F.col("job_start_ts"), F.col("job_end_ts")))


def with_status_updates(log: DataFrame) -> DataFrame:
    """The run log with later status updates (rows without a start) applied to the entries of their batch,
    object and layer that they follow. Every attempt stays a row, with all its other columns."""
    keys, counts = ["batch_id", "object_name", "data_layer"], ["source_row_count", "target_row_count", "error_record_count"]
    changed = ["job_status", "job_end_ts", *counts]
    at = F.struct("updated_ts", "job_end_ts")
    updates = log.filter(F.col("job_start_ts").isNull()).groupBy(*keys).agg(
        F.max("updated_ts").alias("_at"),
        *[F.max(F.when(F.col(c).isNotNull(), F.struct(at.alias("at"), F.col(c)))).getField(c).alias(f"_{c}") for c in changed])
    entries = log.filter(F.col("job_start_ts").isNotNull()).join(updates, keys, "left")
    follows = F.col("_at") >= F.col("updated_ts")
    resolved = entries.withColumns({c: F.when(follows & F.col(f"_{c}").isNotNull(), F.col(f"_{c}")).otherwise(F.col(c)) for c in changed})
    seconds = F.timestamp_diff("SECOND", F.col("job_start_ts"), F.col("job_end_ts")).cast("int")
    return resolved.withColumn("job_duration_sec", F.when(follows, seconds).otherwise(F.col("job_duration_sec"))).select(log.columns)


def volume_trend(log: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """Rows loaded per day and layer by successful runs."""
    recent = last_days(log, "job_start_ts", as_of, days).filter(F.col("job_status") == "SUCCESS")
    return recent.groupBy(F.to_date("job_start_ts").alias("load_date"), "data_layer").agg(
        F.sum("target_row_count").alias("rows_loaded")).orderBy("load_date", "data_layer")


def reconcile(log: DataFrame) -> DataFrame:
    """Per batch: does every layer satisfy source = target + errors, and Gold = Silver rows?"""
    def target_of(layer: str) -> Column:
        return F.sum(F.when(F.col("data_layer") == layer, F.col("target_row_count")))

    balanced = F.col("source_row_count") == F.col("target_row_count") + F.col("error_record_count")
    return log.groupBy("batch_id").agg(
        F.count_if(~balanced).alias("unbalanced_layers"),
        target_of("SILVER").alias("silver_rows"),
        target_of("GOLD").alias("gold_rows"),
    ).withColumn("gold_matches_silver", F.col("silver_rows") == F.col("gold_rows"))


def freshness(df: DataFrame, ts: str, hours: int, as_of: Column) -> DataFrame:
    """Newest load and whether it is older than ``hours`` before ``as_of``."""
    return df.agg(F.max(ts).alias("last_load_ts")).withColumn(
        "is_stale", F.coalesce(F.col("last_load_ts") < as_of - F.make_dt_interval(F.lit(0), F.lit(hours)), F.lit(True)))


def with_previous(df: DataFrame, by: list[str], order: list[str], value: str, name: str,
                  grain: str = "minute") -> DataFrame:
    """The value of the row before, per ``by`` in the given order, whose first column is a time.

    A plain ``lag`` would sort a busy object's whole history in one task. Here it runs within
    (object, minute) groups, and the first row of each group takes the last value of the object's
    previous busy minute. That second step sees one row per minute.
    """
    sliced = df.withColumn("_slice", F.date_trunc(grain, F.col(order[0])).cast("timestamp_ntz"))
    within = Window.partitionBy(*by, "_slice").orderBy(*order)
    inner = sliced.withColumns({"_first": F.row_number().over(within) == 1, "_before": F.lag(value).over(within)})

    last = sliced.groupBy(*by, "_slice").agg(F.max_by(value, F.struct(*order)).alias("_last"))
    across = Window.partitionBy(*by).orderBy("_slice")
    carried = last.withColumn("_carried", F.lag("_last").over(across)).drop("_last")
    joined = inner.join(carried, [*by, "_slice"], "left")
    return joined.withColumn(name, F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_before"))).select(
        *df.columns, name)


def volume_drop(log: DataFrame, pct: float, by: str = "object_name") -> DataFrame:
    """Runs whose row count fell by more than ``pct`` percent against the run before."""
    runs = with_previous(log, [by], ["job_start_ts", "batch_id"], "target_row_count", "previous_rows")
    return runs.filter(F.col("target_row_count") < F.col("previous_rows") * (1 - pct / 100))


def batches_not_loaded(df: DataFrame, log: DataFrame, layer: str) -> DataFrame:
    """Rows of batches that have no successful entry for ``layer`` yet.

    The successful batches are made distinct first: the log grows with runs, not with rows.
    """
    done = log.filter((F.col("layer") == layer) & (F.col("status") == "SUCCESS")).select(
        F.col("batch_id").alias("_batch_id")).distinct()
    return df.join(done, "_batch_id", "left_anti")


def quarantine_sample(quarantine: DataFrame, batch_id: str, order: list[Column], limit: int = 100) -> DataFrame:
    """The newest rejected rows of a batch."""
    return quarantine.filter(F.col("_batch_id") == batch_id).orderBy(*order).limit(limit)
