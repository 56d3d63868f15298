"""Period aggregates and key-figure rows in long form."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import schema
from strata.operators.clean import existing

PERIOD_GROUP = ["period", "category", "region", "_frequency"]


def parse_list(text: str | None) -> list[str]:
    """A configured comma-separated list."""
    return [part.strip() for part in (text or "").split(",") if part.strip()]


def period_aggregate(df: DataFrame, group: Sequence[str] = PERIOD_GROUP,
                     metrics: Sequence[str] = schema.METRICS) -> DataFrame:
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("no_of_records"), *[F.sum(m).alias(m) for m in metrics]
    )


def kpi_rows(df: DataFrame, group_columns: Iterable[str], metric_columns: Iterable[str]) -> DataFrame:
    """One row per group and key figure: record count, total and newest ingestion time.

    Metrics are summed exactly as decimals and become doubles afterwards. Configured columns that the
    frame lacks are skipped; without any metric there is one count-only row per group.
    """
    groups, metrics = existing(df, group_columns), existing(df, metric_columns)
    totals = df.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("no_of_records"),
        F.max("_ingestion_ts").alias("load_date"),
        *[F.sum(m).cast("double").alias(m) for m in metrics],
    )
    if metrics:
        long = totals.unpivot([*groups, "no_of_records", "load_date"], metrics, "keyfigure", "total_qty_amount")
    else:
        long = totals.withColumns({
            "keyfigure": F.lit(""), "total_qty_amount": F.lit(None).cast("double"),
        })
    return long.withColumnRenamed("_file_name", "file_name")


def stamp_kpi(rows: DataFrame, *, data_subject: str, ld_jb_nr: str, batch_id: str, ins_ts: datetime) -> DataFrame:
    return rows.withColumns({
        "data_subject": F.lit(data_subject),
        "ld_jb_nr": F.lit(ld_jb_nr),
        "_batch_id": F.lit(batch_id),
        "ins_gmt_ts": F.lit(ins_ts).cast("timestamp"),
    })


def loaded_on(df: DataFrame, as_of: datetime, ts: str = "_ingestion_ts") -> DataFrame:
    """Rows ingested on the day of ``as_of``, as a range on the raw column so the scan can skip."""
    day = F.date_trunc("day", F.lit(as_of))
    return df.filter((F.col(ts) >= day) & (F.col(ts) < day + F.expr("INTERVAL 1 DAY")))


def keyfigure_total(kpi: DataFrame, keyfigure: str | None = None) -> DataFrame:
    chosen = kpi if keyfigure is None else kpi.filter(F.col("keyfigure") == keyfigure)
    return chosen.groupBy("keyfigure").agg(F.sum("total_qty_amount").alias("total_qty_amount"))
