"""Source object to landing folder."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import schema
from strata.plans.run import Run
from strata.sources.extract import advance_watermark, extracted_mark, full_extract, incremental_extract
from strata.sources.sinks import balanced, replace_small
from strata.sources.staging import exists


@dataclass(frozen=True)
class ExtractResult:
    path: str
    rows: int
    watermark: str | None


def extract_to_landing(spark: SparkSession, metadata_table: str, source: DataFrame, system: str, name: str,
                       landing_root: str, run: Run) -> ExtractResult:
    """Write the object's new rows (or all rows, for a full load) as Parquet, then move the mark.

    Object and batch are in the path. A complete extract is never written again: a repeat of its run only
    moves the mark. The mark is read from the landed files and only moves after they are complete. The state table has
    one row per source object.
    """
    state = spark.table(metadata_table)
    row = state.filter(
        (F.col("source_system") == system) & (F.col("source_object") == name) & F.col("is_active")).first()
    if row is None:
        raise LookupError(f"no active extract configuration for {system}.{name}")
    incremental = row.load_type == "incremental"
    rows = incremental_extract(source, row.watermark_column, row.last_watermark) if incremental else full_extract(source)

    folder = f"{landing_root.rstrip('/')}/{row.landing_path}/{system}.{name}/{run.batch_id}"
    path = f"{folder}/{row.data_subject}_{run.run_ts:%Y%m%d%H%M}.parquet"
    if not exists(spark, f"{path}/_SUCCESS"):
        balanced(rows).write.mode("overwrite").parquet(path)
    landed = spark.read.parquet(path)
    mark = extracted_mark(landed, row.watermark_column).first().new_watermark if incremental else None
    moved = advance_watermark(state, system, name, mark)
    replace_small(spark.createDataFrame(moved.collect(), schema.EXTRACT_METADATA), metadata_table)
    return ExtractResult(path, landed.count(), mark if mark is not None else row.last_watermark)
