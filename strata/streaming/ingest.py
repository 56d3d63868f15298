"""Landing folders as streams. Each micro-batch goes through the layer jobs, with their checks, gate and logs."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from dataclasses import replace
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.operators.dedup import one_per_key
from strata.plans.bronze import NewestBy, load_landing
from strata.plans.run import Job, Run
from strata.plans.silver import load_silver
from strata.plans.subject import run_steps
from strata.sources import logs
from strata.sources.files import read_landed_files
from strata.sources.sinks import replace_owned
from strata.sources.versions import Files


BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"  # of which only the path is read


def landing_files(spark: SparkSession, path: str, most_files: int = 1000) -> DataFrame:
    """The names of new files of a landing folder, as a stream; at most ``most_files`` in a micro-batch.

    Names only: a stream of rows would have to fix its columns and types before the first file has arrived.
    """
    return spark.readStream.format("binaryFile").schema(BINARY_FILE).option("maxFilesPerTrigger", most_files).load(path).select("path")


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The identity of a stream: kept with its checkpoint, so it survives restarts, and a new checkpoint is a new stream."""
    files = Files(spark, checkpoint)
    files.create(uuid.uuid4().hex[:12], "strata-stream-id")  # no effect if it is there
    return files.read("strata-stream-id")


def stream_layers(files: DataFrame, database: str, subject: Mapping[str, Any], checkpoint: str, *,
                  to_silver: bool = False, newest_by: NewestBy = (), mapping: Mapping[str, str] | None = None,
                  threshold: float | None = None, run_ts: datetime | None = None) -> StreamingQuery:
    """Load all waiting ``landing_files`` into Bronze, and into Silver if asked, then stop.

    A micro-batch reads its files with the columns and types they have; new columns reach the tables. It has a batch
    id of its own, made of the subject, the stream and its number, so no other stream or batch shares its slices. It
    writes the same audit, quality and job-log rows as a batch. The job-log row is its commit: a micro-batch that is
    repeated after a failure skips the layers it has loaded, and replaces what it had half written. With ``threshold`` a
    check with a lower pass rate stops the stream before Silver is written; the failure is logged.
    """
    spark = files.sparkSession
    identity = stream_id(spark, checkpoint)

    def load(found: DataFrame, number: int) -> None:
        session = found.sparkSession
        paths = sorted(r.path for r in found.distinct().collect())  # bounded by the stream's files per micro-batch
        if not paths:
            return
        run = Run(batch_id=f"{subject['data_subject']}-{identity}-{number:08d}", run_ts=run_ts or datetime.now(timezone.utc),
                  load_job_nr=str(number), application_id=session.sparkContext.applicationId)
        job = Job(database, dict(subject), run, "bronze_stream")
        loaded = logs.loaded_layers(session, job.table("job_log"), run.batch_id, job.name)
        if "BRONZE" in loaded:
            job = replace(job, run=replace(run, day=loaded["BRONZE"].day))
        rows = {layer: entry.inserted for layer, entry in loaded.items()}
        landing = read_landed_files(session, paths, subject["file_format"], subject["delimiter"], subject["has_header"])
        steps = [("BRONZE", lambda: load_landing(session, job, landing, mapping=mapping, newest_by=newest_by))]
        if to_silver:
            steps.append(("SILVER", lambda: load_silver(session, job, threshold, newest_by, rows["BRONZE"])))
        run_steps(session, job, paths[0] if len(paths) == 1 else f"{len(paths)} files from {paths[0]}", loaded, rows, steps)

    return files.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def deduplicate_stream(df: DataFrame, keys: Iterable[str], ts: str, delay: str) -> DataFrame:
    """One row per key among rows that arrive within ``delay`` of each other; state is bounded by the delay. Rows that
    are older than the watermark are dropped; ``land_new_keys`` keeps them."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def key_bucket(keys: Iterable[str], buckets: int):
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def land_new_keys(df: DataFrame, table: str, keys: Iterable[str], order: Iterable[str], checkpoint: str) -> StreamingQuery:
    """Append the rows of a stream whose key the table does not hold yet, whenever they arrive; then stop.

    ``table`` is partitioned by ``_bucket`` (a hash of the key) and ``_batch_id``. A micro-batch keeps one row per key, the
    first by ``order``, and drops keys that earlier micro-batches have landed: an anti join with the buckets that it
    touches, by key columns only. Nothing is kept in state, so neither late rows nor late repeats are mistaken, and a
    repeated micro-batch replaces what it has landed. NULL keys are equal to each other.
    """
    spark, keys = df.sparkSession, list(keys)
    order = [F.col(c).asc_nulls_last() for c in order]
    buckets, identity = table_buckets(spark, table), stream_id(df.sparkSession, checkpoint)

    def load(rows: DataFrame, number: int) -> None:
        session, batch_id = rows.sparkSession, f"{identity}-{number:08d}"
        fresh = one_per_key(rows, keys, order).withColumn("_bucket", key_bucket(keys, buckets))
        held = session.table(table).filter(F.col("_batch_id") != batch_id).select(
            F.col("_bucket").alias("_held_bucket"), *[F.col(k).alias(f"_held_{k}") for k in keys])
        same = F.col("_bucket") == F.col("_held_bucket")
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_held_{k}"))
        replace_owned(fresh.join(held, same, "left_anti").withColumn("_batch_id", F.lit(batch_id)), table, {"_batch_id": batch_id})

    return df.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def create_key_table(spark: SparkSession, table: str, columns: str, buckets: int = 64) -> None:
    """A table for ``land_new_keys``; the number of buckets stays with it."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, _bucket INT, _batch_id STRING) USING PARQUET"
              f" PARTITIONED BY (_bucket, _batch_id) TBLPROPERTIES ('strata.buckets' = '{buckets}')")


def table_buckets(spark: SparkSession, table: str) -> int:
    return int({r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}["strata.buckets"])
