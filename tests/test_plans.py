"""Physical plans: pruning, pushdown, and nothing that would not scale."""

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from strata import fixture
from strata.plans import load_queries, queries as q
from strata.plans.load_queries import landing_rows, new_database
from strata.plans.registry import QUERIES

BATCH = ["kpi_by_period", "bronze_standardize", "dedup_latest", "duplicates", "scd2_silver", "scd2_actions",
         "scd2_invariants", "dim_product", "fact_build", "fact_insert_only", "star_join", "as_of_join",
         "dq_flags", "dq_log", "kpi_by_file", "volume_drop", "batch_guard", "reconcile_layers", "status_update"]


@pytest.mark.parametrize("name", BATCH)
def test_no_python_workers_and_no_pairwise_joins(spark, sf, name):
    plan = plan_of(QUERIES[name](spark, sf))
    for bad in ("PythonUDF", "EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin",
                "SinglePartition, ENSURE_REQUIREMENTS, [plan_id=0]"):
        assert bad not in plan


@pytest.mark.parametrize("name", ["dedup_latest", "dim_product", "duplicates", "latest_status"])
def test_windows_are_limited_or_small(spark, sf, name):
    plan = plan_of(QUERIES[name](spark, sf))
    assert plan.count("Window [row_number()") * 2 <= plan.count("WindowGroupLimit")


def test_only_needed_columns_are_read(spark, sf):
    plan = plan_of(QUERIES["volume_trend"](spark, sf))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_layer_reads_prune_partitions(spark):
    database = new_database(spark)
    silver = spark.table(f"{database}.silver")
    open_daily = silver.filter((F.col("_frequency") == "daily") & F.col("effective_to").isNull())
    frame = open_daily.filter(F.col("period").isin("2024-01-01"))
    scan = frame._jdf.queryExecution().executedPlan().collectLeaves().head().verboseStringWithOperatorId()
    filters = scan[scan.index("PartitionFilters"):].split("\n")[0]
    for column in ("_frequency", "effective_to", "period"):
        assert column in filters
    assert "Filter (" not in plan_of(frame)


def test_merge_shuffles_each_side_once(spark, sf):
    """Joining on the match key needs one exchange per side; the deduplicated side reuses its own."""
    plan = plan_of(q.silver_history(spark, sf))
    assert plan.count("SortMergeJoin [product_id") == 1


def test_forecast_rows_are_joined_alike_at_every_size_and_shuffled_as_numbers(spark, sf):
    plan = plan_of(fixture.derive_forecast(spark, sf))
    for key in ("l_partkey", "l_orderkey"):
        assert f"SortMergeJoin [{key}" in plan
    texts = plan[:plan.index("SortMergeJoin [l_orderkey")]
    assert "Exchange hashpartitioning" not in texts and "r_name" not in plan[len(texts):].split("BroadcastExchange")[0]


def test_landed_rows_are_read_from_the_stored_rows_and_not_copied_before(spark, sf):
    """What a run's extract delivers is a filter on the scan of the stored rows: no shuffle, no copy of its own."""
    stored = {f.rsplit("/", 1)[0] for f in fixture.forecast_src(spark, sf).inputFiles()}
    for rows in landing_rows(spark, sf).values():
        assert {f.rsplit("/", 1)[0] for f in rows.inputFiles()} == stored
        assert "Exchange" not in plan_of(rows.filter("_frequency = 'daily'"))


def test_rows_that_are_written_twice_are_computed_once(spark, sf, monkeypatch):
    """Both writes of ``partitioned_overwrite`` start from rows that were deduplicated once."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    ids = [f"CAST(id AS BIGINT) AS {c}" for c in q.SRC_IDS]
    rows = spark.range(100).selectExpr(*ids, "string(id % 7) AS product_id", "CAST(id AS DECIMAL(18,4)) AS forecast_qty",
                                       "'2024-01-01' AS period", "'daily' AS _frequency")
    monkeypatch.setattr(load_queries, "clean_rows", lambda spark, sf: rows.mapInArrow(counted, rows.schema))
    assert QUERIES["partitioned_overwrite"](spark, sf).agg(F.sum("forecast_qty")).first()[0] == sum(range(100))
    assert seen.value == 100
