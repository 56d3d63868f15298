from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows_of
from strata import schema
from strata.functions.text import source_batch_nr
from strata.plans.extract import extract_to_landing
from strata.plans.run import Run
from strata.session import work_path
from strata.sources import config, extract, files, jdbc, logs, sinks


def test_resolve_path():
    assert files.resolve_path("a", "b") == "b"
    assert files.resolve_path("a") == "a"
    with pytest.raises(ValueError):
        files.resolve_path(None)


def test_has_source(spark):
    root = work_path(spark, "probe")
    assert not files.has_source(spark, f"{root}/missing")
    spark.range(0).write.parquet(f"{root}/empty")
    assert not files.has_source(spark, f"{root}/empty")
    spark.range(1).write.parquet(f"{root}/one")
    assert files.has_source(spark, f"{root}/one")


def test_delimited_scan_keeps_text(spark):
    root = work_path(spark, "text")
    lines = ["a|b|c", '001| x |"p|q"', "2024-01-01||"]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(f"{root}/f_202401010600.csv")
    df = files.read_delimited(spark, f"{root}/f_202401010600.csv")
    assert {f.dataType.simpleString() for f in df.schema.fields} == {"string"}
    assert rows_of(df) == sorted([
        ("001", " x ", "p|q", "f_202401010600.csv"), ("2024-01-01", None, None, "f_202401010600.csv")], key=repr)


def test_batch_number(spark):
    names = ["fc_202401010600.csv", "fc_202401010600.parquet", "fc_20240101.csv", "fc_202401010600.txt"]
    df = spark.createDataFrame([(n,) for n in names], "n string").select(source_batch_nr(F.col("n")))
    assert [r[0] for r in df.collect()] == ["202401010600", "202401010600", "", ""]


def test_jdbc_options():
    database = jdbc.Database("jdbc:x://host/db", {"user": "u"})
    plain = jdbc.read_options(database, "audit.t")
    assert plain["url"] == "jdbc:x://host/db" and plain["dbtable"] == "audit.t" and "numPartitions" not in plain
    split = jdbc.read_options(database, "audit.t", jdbc.SplitBy("id", "0", "100", 4))
    assert (split["partitionColumn"], split["numPartitions"]) == ("id", "4")


def test_metadata_lookup(spark):
    subjects = config.default_subjects(spark)
    assert config.get_pipeline_metadata(subjects, "fc_daily")["frequency"] == "daily"
    with pytest.raises(LookupError):
        config.get_pipeline_metadata(subjects, "nope")
    off = subjects.withColumn("is_active", F.lit(False))
    with pytest.raises(LookupError):
        config.get_pipeline_metadata(off, "fc_daily")


@pytest.fixture()
def database(spark):
    name = f"t{work_path(spark, 'x')[-8:]}"
    schema.ensure_tables(spark, name, work_path(spark, name))
    return name


def state(spark, load_type="incremental", mark=None):
    return spark.createDataFrame(
        [("erp", "jdbc", "s", "forecast", "daily", "fc_daily", load_type, "changed_on", mark, True),
         ("crm", "jdbc", "s", "forecast", "monthly", "fc_monthly", "full", None, None, True)], schema.EXTRACT_METADATA)


def marks(df):
    return {r.source_system: r.last_watermark for r in df.collect()}


def test_watermark_rules(spark):
    before = state(spark, mark="2024-01-01")
    assert marks(extract.advance_watermark(before, "erp", "forecast", "2024-02-01"))["erp"] == "2024-02-01"
    assert marks(extract.advance_watermark(before, "erp", "forecast", None))["erp"] == "2024-01-01"
    assert marks(extract.advance_watermark(before, "crm", "forecast", "2024-02-01"))["crm"] is None
    assert marks(extract.set_watermark(before, "erp", "forecast", None))["erp"] is None
    assert marks(extract.set_watermark(before, "erp", "forecast", "2020-01-01"))["erp"] == "2020-01-01"


def test_extract_is_incremental(spark, database):
    table = f"{database}.extract_metadata"
    sinks.replace_small(state(spark), table)
    root = work_path(spark, "landing")

    def source(*days):
        return spark.createDataFrame(
            [(f"P{i}", datetime(2024, 1, d)) for i, d in enumerate(days)], "product_id string, changed_on timestamp_ntz")

    def run(minute, df, system="erp"):
        when = datetime(2024, 2, 1, 6, minute, tzinfo=timezone.utc)
        return extract_to_landing(spark, table, df, system, "forecast", root, Run("b", when))

    first = run(0, source(1, 2, 3))
    assert first.rows == 3 and first.watermark.startswith("2024-01-03")
    assert first.path.endswith("daily/erp.forecast/b/fc_daily_202402010600.parquet")
    assert run(1, source(1, 2, 3)).rows == 0
    assert marks(spark.table(table))["erp"].startswith("2024-01-03")
    grown = run(2, source(1, 2, 3, 4, 5))
    assert grown.rows == 2 and grown.watermark.startswith("2024-01-05")
    assert run(3, source(1, 2), system="crm").rows == 2
    assert run(4, source(1, 2), system="crm").rows == 2
    assert marks(spark.table(table))["crm"] is None


def test_incremental_filter_reaches_the_scan(spark, sf):
    plan = plan_of(extract.incremental_extract(
        spark.read.parquet(f"{sf}/orders.parquet"), "o_orderdate", "1997-01-01 00:00:00"))
    assert "GreaterThan(o_orderdate" in plan


def test_ensure_tables_twice(spark, database):
    schema.ensure_tables(spark, database)
    assert set(schema.TABLES) <= {t.name for t in spark.catalog.listTables(database)}
    assert sinks.partition_columns(spark, f"{database}.fact") == ["period", "_frequency"]


def test_audit_log_entries(spark, database):
    table = f"{database}.pipeline_audit"
    start = datetime(2024, 1, 1, 6, 0, 0, tzinfo=timezone.utc)
    end = datetime(2024, 1, 1, 6, 1, 30, 900000, tzinfo=timezone.utc)
    entry = dict(batch_id="b", object_name="o", data_layer="BRONZE")
    logs.write_audit_entry(spark, table, **entry, job_status="RUNNING", source_row_count=5, job_start_ts=start,
                           job_end_ts=end)
    assert spark.table(table).first().job_duration_sec == 90
    logs.mark_audit_failed(spark, table, batch_id="c", object_name="o", data_layer="SILVER", error_message="boom")
    assert spark.table(table).filter("job_status = 'FAILED'").first().error_message == "boom"
    logs.log_no_data(spark, table, batch_id="d", object_name="o")
    assert spark.table(table).filter("batch_id = 'd'").first().data_layer == "LANDING"

    logs.update_audit_status(spark, table, **entry, job_status="SUCCESS", target_row_count=4)
    from strata.operators.monitor import merge_status_updates
    row = merge_status_updates(spark.table(table).filter("batch_id = 'b'")).first()
    assert (row.job_status, row.source_row_count, row.target_row_count) == ("SUCCESS", 5, 4)
    assert row.job_duration_sec > 90
    with pytest.raises(LookupError):
        logs.update_audit_status(spark, table, batch_id="zz", object_name="o", data_layer="GOLD", job_status="FAILED")


def test_dq_log_status(spark, database):
    table = f"{database}.data_quality_log"
    common = dict(batch_id="b", table_name="t", check_type="NULL_CHECK", column_name="c", records_checked=3)
    logs.log_dq_results(spark, table, **common, records_failed=0)
    logs.log_dq_results(spark, table, **common, records_failed=1)
    assert rows_of(spark.table(table).select("check_status")) == [("FAILED",), ("PASSED",)]


def test_hot_key_is_spread_over_clustered_files(spark):
    """One key with most rows must not end in one file, and the files stay sorted by key."""
    path = work_path(spark, "clustered")
    df = spark.range(20000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"), "id")
    sinks.write_clustered(df, path, ["k"], num_files=6)
    stored = spark.read.parquet(path)
    hot = stored.filter("k = 'hot'").groupBy(F.input_file_name()).count()
    assert stored.count() == 20000 and hot.count() >= 3


def test_a_large_frame_gets_more_files_than_asked_for(spark, monkeypatch):
    """A task writes a file, so the rows of one are bounded; a small frame has the files that were asked for."""
    monkeypatch.setattr(sinks, "ROWS_PER_FILE", 1000)
    df = spark.range(20000).selectExpr("if(id % 3 > 0, 'hot', concat('k', id)) AS k", "id")
    for write in (sinks.write_clustered, sinks.write_interleaved):
        for rows, least, most in ((df, 15, 20), (df.limit(4000), 1, 6)):
            path = work_path(spark, "files")
            write(rows, path, ["k"], num_files=6)
            stored = spark.read.parquet(path)
            files = [r["count"] for r in stored.groupBy(F.input_file_name()).count().collect()]
            assert sum(files) == rows.count() and least <= len(files) <= most and max(files) < 2500


def test_a_repeated_extract_keeps_what_has_landed(spark):
    from datetime import datetime, timezone

    from strata import schema
    from strata.plans.load_queries import new_database

    database, root = new_database(spark), work_path(spark, "extract-repeat")
    table = f"{database}.extract_metadata"
    row = ("erp", "jdbc", "s", "forecast", "daily", "fc_daily", "incremental", "changed_on", None, True)
    sinks.replace_small(spark.createDataFrame([row, (*row[:3], "other", *row[4:])], schema.EXTRACT_METADATA), table)
    source = spark.createDataFrame([(i, datetime(2024, 1, i)) for i in (1, 2, 3)], "id int, changed_on timestamp")
    run = Run("b", datetime(2024, 2, 1, 6, tzinfo=timezone.utc))
    first = extract_to_landing(spark, table, source, "erp", "forecast", root, run)
    again = extract_to_landing(spark, table, source, "erp", "forecast", root, run)
    other = extract_to_landing(spark, table, source.limit(1), "erp", "other", root, run)
    assert (first.rows, again.rows, other.rows) == (3, 3, 1)
    assert spark.read.parquet(first.path).count() == 3 and first.path != other.path


def test_null_and_quoted_partitions_are_moved(spark):
    from datetime import datetime

    from pyspark.sql import functions as F
    from strata.plans.load_queries import new_database

    database = new_database(spark)
    for name, more in (("here", ""), ("there", "_archived_ts timestamp, ")):
        spark.sql(f"CREATE TABLE {database}.{name} (id int, {more}part string) USING PARQUET PARTITIONED BY (part)")
    sinks.write_slice(spark.createDataFrame([(1, None), (2, "it's"), (3, "a b/c"), (4, "stays")], "id int, part string"), f"{database}.here")
    moved = sinks.archive_partitions(spark, f"{database}.here", f"{database}.there", F.coalesce(F.col("part"), F.lit("")) != "stays", datetime(2024, 1, 1))
    assert moved == 3
    assert [r.id for r in spark.table(f"{database}.here").collect()] == [4]
    assert sorted(r.id for r in spark.table(f"{database}.there").collect()) == [1, 2, 3]


def test_file_names_are_not_escaped(spark):
    path = f"{work_path(spark, 'names')}/fc daily+1%_202401010600.parquet"
    spark.createDataFrame([("a",)], "x string").write.parquet(path)
    assert files.read_parquet_as_strings(spark, path).first()._file_name == "fc daily+1%_202401010600.parquet"


def test_rows_without_partition_columns_are_written_where_they_are(spark, tmp_path, monkeypatch):
    """A plain write does not shuffle: each task writes its own rows, a large one in several files."""
    monkeypatch.setattr(sinks, "ROWS_PER_FILE", 40)
    frame = spark.range(300, numPartitions=3).withColumn("task", F.spark_partition_id())
    for write in (sinks.write_overwrite, sinks.write_append):
        path = str(tmp_path / write.__name__)
        write(frame, path)
        files = spark.read.parquet(path).groupBy(F.input_file_name().alias("file")).agg(F.countDistinct("task").alias("tasks"), F.count("id").alias("n"))
        found = files.collect()
        assert len(found) == 9 and all(f.tasks == 1 and f.n <= 40 for f in found)
        assert rows_of(spark.read.parquet(path)) == rows_of(frame)
