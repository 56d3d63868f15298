"""Forecast-shaped inputs derived from the driver's tables, as described in FIXTURES.md.

The column expressions use only syntax that Spark and DuckDB share, so both engines build the same
rows from the same text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import work_path

AS_OF = "1998-12-01 00:00:00"

FORECAST = {
    "product_id": "CASE WHEN l_orderkey % 97 = 0 THEN NULL WHEN l_orderkey % 101 = 0 THEN ''"
                  " ELSE concat('P', CAST(l_partkey % 40 AS STRING)) END",
    "location_id": "CASE WHEN l_orderkey % 103 = 0 THEN '   ' ELSE concat('L', CAST(s_nationkey AS STRING)) END",
    "forecast_date": "CASE WHEN l_orderkey % 107 = 0 THEN 'not-a-date' WHEN l_orderkey % 109 = 0 THEN NULL"
                     " ELSE concat(substring(CAST(CAST(l_shipdate AS DATE) AS STRING), 1, 7), '-15') END",
    "forecast_qty": "CASE WHEN l_orderkey % 113 = 0 THEN ''"
                    " WHEN l_orderkey % 53 = 0 THEN concat('-', CAST(CAST(l_quantity AS DECIMAL(18,4)) AS STRING))"
                    " ELSE CAST(CAST(l_quantity AS DECIMAL(18,4)) AS STRING) END",
    "revenue_amount": "CASE WHEN l_orderkey % 59 = 0 THEN NULL"
                      " ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING) END",
    "customer_id": "CASE WHEN l_orderkey % 31 = 0 THEN NULL ELSE concat('C', CAST(o_custkey AS STRING)) END",
    "channel": "CASE o_custkey % 4 WHEN 0 THEN 'DIRECT' WHEN 1 THEN 'PARTNER' WHEN 2 THEN 'DISTRIBUTOR'"
               " ELSE 'ONLINE' END",
    "category": "CASE p_type WHEN 'ECONOMY' THEN 'SERVER' WHEN 'SMALL' THEN 'server' WHEN 'MEDIUM' THEN ' Storage'"
                " WHEN 'PROMO' THEN 'AI' WHEN 'LARGE' THEN 'COMPUTE' ELSE 'LEGACY_HW' END",
    "sub_category": "p_brand",
    "region": "r_name",
    "country": "n_name",
    "currency": "CASE WHEN l_orderkey % 41 = 0 THEN 'XX' WHEN n_regionkey = 1 THEN 'USD'"
                " WHEN n_regionkey = 3 THEN 'EUR' ELSE 'INR' END",
    "uom": "'UNIT'",
    "_frequency": "CASE l_linenumber % 4 WHEN 0 THEN 'daily' WHEN 1 THEN 'weekly' WHEN 2 THEN 'monthly'"
                  " ELSE 'quarterly' END",
    "_file_name": "concat('fc_', substring(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 4), '01010600.csv')",
    "_ingestion_ts": "o_orderdate",
    "_batch_id": "CASE WHEN o_orderdate < TIMESTAMP '1998-07-01 00:00:00' THEN 'b1' ELSE 'b2' END",
    "_src_orderkey": "l_orderkey",
    "_src_linenumber": "l_linenumber",
    "_src_partkey": "l_partkey",
    "_src_suppkey": "l_suppkey",
}

AUDIT_LOG = {
    "batch_id": "concat('b', CAST(CAST(floor(o_orderkey / 4.0) AS BIGINT) AS STRING))",
    "object_name": "concat('obj', CAST(o_orderkey % 4 AS STRING))",
    "data_layer": "CASE o_orderkey % 4 WHEN 0 THEN 'BRONZE' WHEN 1 THEN 'SILVER' WHEN 2 THEN 'GOLD'"
                  " ELSE 'AGGR_AUDIT' END",
    "job_start_ts": "o_orderdate + INTERVAL '1' SECOND * o_custkey",
    "job_end_ts": "o_orderdate + INTERVAL '1' SECOND * (o_custkey + o_custkey % 600)",
    "job_status": "CASE WHEN o_orderkey % 23 = 0 THEN 'FAILED' ELSE 'SUCCESS' END",
    "source_row_count": "1000 + o_custkey",
    "target_row_count": "1000 + o_custkey - o_orderkey % 7",
    "error_record_count": "o_orderkey % 7",
    "job_duration_sec": "CAST(o_custkey % 600 AS INT)",
    "source_system": "'forecast'",
    "data_subject": "CASE o_custkey % 4 WHEN 0 THEN 'fc_daily' WHEN 1 THEN 'fc_weekly' WHEN 2 THEN 'fc_monthly'"
                    " ELSE 'fc_quarterly' END",
}

DQ_LOG = {
    "batch_id": "concat('b', CAST(CAST(floor(o_orderkey / 4.0) AS BIGINT) AS STRING))",
    "table_name": "'silver.forecast'",
    "check_type": "CASE o_orderkey % 3 WHEN 0 THEN 'NULL_CHECK' WHEN 1 THEN 'DUPLICATE_CHECK'"
                  " ELSE 'FORMAT_CHECK' END",
    "column_name": "'product_id'",
    "records_checked": "100 + o_custkey",
    "records_failed": "o_orderkey % 20",
    "check_status": "CASE WHEN o_orderkey % 20 = 0 THEN 'PASSED' ELSE 'FAILED' END",
    "created_ts": "o_orderdate",
}

# Newest first, with every source identifier as a tie-break.
LATEST_ORDER = ["_ingestion_ts", "_src_orderkey", "_src_linenumber", "_src_partkey", "_src_suppkey",
                "forecast_qty", "revenue_amount"]

FORECAST_FROM = (
    "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"
    " JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"
    " JOIN region ON n_regionkey = r_regionkey"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select([F.expr(e).alias(n) for n, e in columns.items()])


def derive_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped rows, dirty classes included, from the driver's tables.

    Parts and orders grow with the lineitems, so both are met by a shuffle at every size, while lineitems are still
    numbers: supplier, nation and region names and all texts come after the last one.
    """
    def t(name: str) -> DataFrame:
        return table(spark, sf_dir, name)

    joined = (
        t("lineitem")
        .join(t("part").hint("merge"), F.col("l_partkey") == F.col("p_partkey"))
        .join(t("orders").hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return _project(joined, FORECAST)


_STORED: dict[tuple[str, str], str] = {}


def forecast_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forecast rows as a stored extract, which is what every operator starts from.

    Derived in full and written to the shared folder once per session and input folder, from the tasks of its last
    join, which are even: the texts themselves are not shuffled.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORED:
        path = work_path(spark, "forecast-src")
        derive_forecast(spark, sf_dir).write.parquet(path)
        _STORED[key] = path
    return spark.read.parquet(_STORED[key])


def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(table(spark, sf_dir, "orders"), AUDIT_LOG)


def dq_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(table(spark, sf_dir, "orders"), DQ_LOG)


def _select(columns: dict[str, str], source: str) -> str:
    return "SELECT " + ", ".join(f"{e} AS {n}" for n, e in columns.items()) + f" FROM {source}"


def forecast_sql() -> str:
    return _select(FORECAST, FORECAST_FROM)


def audit_log_sql() -> str:
    return _select(AUDIT_LOG, "orders")


def dq_log_sql() -> str:
    return _select(DQ_LOG, "orders")
