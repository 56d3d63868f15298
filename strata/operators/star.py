"""Dimensions, calendar and fact."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import schema
from strata.functions.dates import calendar_columns
from strata.functions.keys import surrogate_key
from strata.operators.clean import conform
from strata.operators.dedup import one_per_key
from strata.operators.scd2 import scd2_merge

PRODUCT_ATTRIBUTES = ["category", "sub_category"]
LOCATION_ATTRIBUTES = ["region", "country"]


def latest_per_key(df: DataFrame, key: str, attributes: Iterable[str], order: str = "_ingestion_ts") -> DataFrame:
    """One attribute set per key when a batch carries several: the newest, then the greatest."""
    attributes = list(attributes)
    newest = df.select(key, *attributes, order)
    ranking = [F.col(c).desc_nulls_last() for c in [order, *attributes]]
    return one_per_key(newest, [key], ranking).select(key, *attributes)


def merge_dimension(current: DataFrame, members: DataFrame, key: str, attributes: Iterable[str],
                    surrogate: str, as_of: date, load_ts: datetime) -> DataFrame:
    """SCD2 merge of dimension members. A version's key is derived from its id and its first day."""
    stamped = members.withColumn("_load_ts", F.lit(load_ts).cast("timestamp"))
    merged = scd2_merge(current, stamped, [key], attributes, as_of)
    return merged.withColumn(surrogate, surrogate_key(F.col(key), F.col("effective_from")))


def merge_dim_product(current: DataFrame, batch: DataFrame, as_of: date, load_ts: datetime) -> DataFrame:
    members = latest_per_key(batch, "product_id", PRODUCT_ATTRIBUTES)
    return merge_dimension(current, members, "product_id", PRODUCT_ATTRIBUTES, "product_key", as_of, load_ts)


def merge_dim_location(current: DataFrame, batch: DataFrame, as_of: date, load_ts: datetime) -> DataFrame:
    members = latest_per_key(batch, "location_id", LOCATION_ATTRIBUTES)
    return merge_dimension(current, members, "location_id", LOCATION_ATTRIBUTES, "location_key", as_of, load_ts)


def build_dim_time(dates: DataFrame, column: str = "forecast_date", fiscal_start_month: int = 1) -> DataFrame:
    """Calendar rows for the distinct days of a column."""
    days = dates.select(F.col(column).cast("date").alias("_day")).filter("_day IS NOT NULL").distinct()
    return days.select([c.alias(n) for n, c in calendar_columns(F.col("_day"), fiscal_start_month).items()])


def missing_dates(candidates: DataFrame, dim_time: DataFrame) -> DataFrame:
    return candidates.join(dim_time.select("date_key"), "date_key", "left_anti")


def build_fact(silver: DataFrame, dim_product: DataFrame, dim_location: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Silver rows with the keys of the open dimension versions; unmatched rows keep NULL keys.

    Each dimension holds one open row per id, so the joins add no rows. The calendar is broadcast:
    it has one short row per day, whatever the number of facts. The other two are left to adaptive
    execution, which broadcasts by measured size and otherwise splits a hot id's partition.
    """
    product = dim_product.filter("effective_to IS NULL").select("product_id", "product_key")
    location = dim_location.filter("effective_to IS NULL").select("location_id", "location_key")
    calendar = dim_time.select(F.col("date_key").alias("forecast_date"), "time_key")
    return (
        silver.join(F.broadcast(calendar), "forecast_date", "left")
        .join(product, "product_id", "left")
        .join(location, "location_id", "left")
    )


def unmatched_keys(fact: DataFrame) -> DataFrame:
    """Fact rows, and how many of them found no dimension row."""
    return fact.agg(
        F.count(F.lit(1)).alias("fact_rows"),
        F.count_if(F.col("product_key").isNull()).alias("no_product"),
        F.count_if(F.col("location_key").isNull()).alias("no_location"),
        F.count_if(F.col("time_key").isNull()).alias("no_time"),
    )


def new_fact_rows(candidates: DataFrame, fact: DataFrame, keys: Iterable[str] = schema.FACT_KEY) -> DataFrame:
    """Candidates whose natural key the fact does not hold yet; NULL keys match each other.

    The partition columns follow from the key (``period`` is a function of ``forecast_date``) and
    are part of the condition, so it stays an equality join on both layouts.
    """
    names = list(dict.fromkeys([*keys, "period"]))
    held = fact.select([F.col(c).alias(f"_f_{c}") for c in names])
    nullable = {"channel"}
    condition = [
        F.col(c).eqNullSafe(F.col(f"_f_{c}")) if c in nullable else F.col(c) == F.col(f"_f_{c}") for c in names
    ]
    return candidates.join(held, condition, "left_anti")


def star_join(fact: DataFrame, dim_product: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Fact rows with the attributes of the versions their keys point to."""
    product = dim_product.select(
        "product_key", F.col("category").alias("dim_category"), F.col("sub_category").alias("dim_sub_category"))
    location = dim_location.select(
        "location_key", F.col("region").alias("dim_region"), F.col("country").alias("dim_country"))
    return fact.join(product, "product_key").join(location, "location_key")
