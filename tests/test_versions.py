"""Versioned slices: publication, replacement without a gap, lost drivers and concurrent writers."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from strata.plans.load_queries import new_database
from strata.sources import sinks, versions

LAYOUT = "a int, part string, day date"


@pytest.fixture()
def table(spark):
    name = f"{new_database(spark)}.t"
    spark.sql(f"CREATE TABLE {name} (a INT, part STRING, day DATE) USING PARQUET PARTITIONED BY (part, day)")
    return name


def frame(spark, *rows):
    return spark.createDataFrame([(a, p, d) for a, p, d in rows], "a int, part string, day string").selectExpr("a", "part", "date(day) AS day")


def held(spark, table):
    return rows_of(spark.table(table).selectExpr("a", "part", "string(day)"))


def test_slices_are_replaced_and_others_stay(spark, table):
    sinks.write_slice(frame(spark, (1, "x", None), (2, "it's/", "2024-01-01"), (3, None, None)), table)
    sinks.write_slice(frame(spark, (9, "it's/", "2024-01-01")), table)
    assert held(spark, table) == [(1, "x", None), (3, None, None), (9, "it's/", "2024-01-01")]
    sinks.replace_owned(frame(spark, (7, "x", "2024-02-01")), table, {"part": "x"})
    assert held(spark, table) == [(3, None, None), (7, "x", "2024-02-01"), (9, "it's/", "2024-01-01")]
    sinks.replace_owned(frame(spark), table, {"part": "x"})
    assert held(spark, table) == [(3, None, None), (9, "it's/", "2024-01-01")]
    assert spark.table(table).filter("part = 'x'").isEmpty()
    sinks.insert_rows(frame(spark, (4, None, None), (5, "x", "2024-02-01")), table)
    assert held(spark, table) == [(3, None, None), (4, None, None), (5, "x", "2024-02-01"), (9, "it's/", "2024-01-01")]
    sinks.replace_owned(frame(spark), table, {"part": "x"})
    sinks.replace_owned(frame(spark), table, {"part": "it's/"})
    sinks.insert_rows(frame(spark, (6, "x", "2024-02-01")), table)  # an emptied slice has a folder of its own
    assert held(spark, table) == [(3, None, None), (4, None, None), (6, "x", "2024-02-01")]


def test_readers_find_the_old_slice_until_the_new_one_is_whole(spark, table, monkeypatch):
    sinks.write_slice(frame(spark, (1, "x", None)), table)
    version = "v-1"
    slices = versions.write_version(frame(spark, (2, "x", None)), table, version, sinks.balanced)
    assert held(spark, table) == [(1, "x", None)]
    with pytest.raises(Exception, match="lost"):  # a job that fails on the way
        sinks.replace_owned(frame(spark, (3, "x", None)).selectExpr("int(raise_error('lost')) AS a", "part", "day"), table, {"part": "x"})
    assert held(spark, table) == [(1, "x", None)]
    before = spark.table(table)
    versions.publish(spark, table, version, slices, lambda _: False)
    assert held(spark, table) == [(2, "x", None)] and before.count() == 1


def test_a_driver_lost_after_the_entry_is_made_good(spark, table, monkeypatch):
    sinks.write_slice(frame(spark, (1, "x", None), (1, "y", None)), table)
    with monkeypatch.context() as patch:
        patch.setattr(versions, "apply", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            sinks.replace_owned(frame(spark, (2, "x", "2024-01-01")), table, {"part": "x"})
    assert held(spark, table) == [(1, "x", None), (1, "y", None)]
    versions.settle(spark, table)
    assert held(spark, table) == [(1, "y", None), (2, "x", "2024-01-01")]


def add_one(spark, table):
    return spark.table(table).filter("part = 'x'").selectExpr("a + 1 AS a", "part", "day")


def test_a_merge_keeps_what_came_meanwhile_and_is_done_once(spark, table):
    sinks.write_slice(frame(spark, (1, "x", None), (1, "y", None)), table)
    tries = []

    def build():
        tries.append(1)
        rows = add_one(spark, table)
        if len(tries) == 1:
            sinks.write_slice(frame(spark, (10, "x", None)), table)  # another run
        return rows

    def merge(name):
        return versions.merge_version(spark, table, lambda v: v["part"] == "x", name, build, lambda rows: {"n": rows.count()}, sinks.balanced)

    assert merge("one") == {"n": 1} and len(tries) == 2 and held(spark, table) == [(1, "y", None), (11, "x", None)]
    assert merge("one") == {"n": 1} and len(tries) == 2
    sinks.write_slice(frame(spark, (5, "y", None)), table)  # another slice moves: no reason to build again
    merge("two")
    assert len(tries) == 3 and held(spark, table) == [(12, "x", None), (5, "y", None)]


def test_writers_side_by_side_lose_nothing(spark, table):
    sinks.write_slice(frame(spark, (0, "x", None)), table)

    def work(number):
        if number % 2:
            sinks.write_slice(frame(spark.newSession(), (number, f"p{number}", None)), table)
        else:
            versions.merge_version(spark, table, lambda v: v["part"] == "x", f"m{number}", lambda: add_one(spark, table), lambda _: {}, sinks.balanced)

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(work, range(8)))
    spark.catalog.refreshTable(table)
    assert held(spark, table) == [(1, "p1", None), (3, "p3", None), (4, "x", None), (5, "p5", None), (7, "p7", None)]


def test_appends_side_by_side_lose_nothing(spark, table):
    plain = table + "_log"
    spark.sql(f"CREATE TABLE {plain} (a INT, part STRING) USING PARQUET")
    sinks.write_slice(frame(spark, (100, "x", None)), table)

    def work(number):
        session = spark.newSession()
        sinks.append_rows(frame(session, (number, "x", None)), plain)
        sinks.insert_rows(frame(session, (number, "x", None), (number, f"p{number % 2}", "2024-01-01")), table)

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(work, range(12)))
    for name in (plain, table):
        spark.catalog.refreshTable(name)
    assert rows_of(spark.table(plain).selectExpr("a")) == sorted([(k,) for k in range(12)], key=repr)
    assert spark.table(table).filter("part = 'x'").count() == 13 and spark.table(table).count() == 25


def test_cleaning_keeps_what_is_current(spark, table):
    for a in range(4):
        sinks.write_slice(frame(spark, (a, "x", None), (a, f"y{a}", None)), table)
    assert versions.clean_versions(spark, table, keep_entries=1) == 0  # each version still holds its y slice
    sinks.replace_owned(frame(spark), table, {"part": "y0"})
    assert versions.clean_versions(spark, table, keep_entries=1) == 1
    assert held(spark, table) == [(1, "y1", None), (2, "y2", None), (3, "x", None), (3, "y3", None)]
    assert versions.snapshot(spark, table).number == 5
    sinks.write_slice(frame(spark, (9, "x", None)), table)
    assert (9, "x", None) in held(spark, table)


def test_compaction_joins_small_files_of_some_slices(spark, table):
    for a in range(6):
        sinks.insert_rows(frame(spark, (a, "it's/", None)).coalesce(1), table)
    sinks.write_slice(frame(spark, (9, "x", "2024-01-01")), table)
    before = held(spark, table)

    def files():
        spark.catalog.refreshTable(table)
        return sorted(len(versions.table_folder(spark, table).sizes(p)) for p in versions.slice_places(spark, table, 2).values())

    assert files() == [1, 6]
    assert sinks.compact(spark, table) == 1 and files() == [1, 1] and held(spark, table) == before
    assert sinks.compact(spark, table) == 0
    sinks.insert_rows(frame(spark, (7, "it's/", None)), table)
    assert sinks.compact(spark, table, target_bytes=10) == 0 and len(held(spark, table)) == 8


def test_num_partitions_bounds_the_files_of_a_slice(spark, table):
    rows = spark.range(20000).selectExpr("int(id) AS a", "'x' AS part", "date(null) AS day").repartition(16)
    sinks.replace_owned(rows, table, {"part": "x"}, num_files=3)
    places = versions.slice_places(spark, table, 2)
    assert len(places) == 1 and all(1 <= len(versions.table_folder(spark, table).sizes(p)) <= 3 for p in places.values())


def test_interleaved_files_are_skipped_by_each_column(spark, tmp_path):
    """Files whose statistics admit a value of one column: few for every column, and not only for the first."""
    import glob

    import pyarrow.parquet as pq

    rows = spark.range(40000).selectExpr("concat('P', lpad(id % 97, 3, '0')) AS p", "concat('L', lpad((id * 31) % 89, 3, '0')) AS l",
                                         "date_add(date('2024-01-01'), int((id * 7) % 300)) AS d", "id", "if(id % 500 = 0, null, id) AS gaps")
    places = {}
    for name, write in (("z", sinks.write_interleaved), ("sorted", sinks.write_clustered)):
        places[name] = f"{tmp_path}/{name}"
        write(rows, places[name], ["p", "l", "d"], num_files=64)

    def read(name, column, value):
        count = 0
        for file in glob.glob(f"{places[name]}/*.parquet"):
            meta = pq.ParquetFile(file).metadata
            at = meta.schema.names.index(column)
            stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
            count += any(s.min <= value <= s.max for s in stats)
        return count

    for column, value in (("p", "P040"), ("l", "L040")):
        assert read("z", column, value) <= 32
    assert read("sorted", "l", "L040") == 64
    assert rows_of(spark.read.parquet(places["z"]).agg({"id": "sum", "gaps": "count"})) == rows_of(rows.agg({"id": "sum", "gaps": "count"}))


def test_ranks_with_nulls_and_few_values(spark, tmp_path):
    rows = spark.createDataFrame([(None, 1), ("a", None), ("a", 2), (None, None)], "p string, n int")
    sinks.write_interleaved(rows, f"{tmp_path}/few", ["p", "n"])
    sinks.write_interleaved(rows.limit(0), f"{tmp_path}/none", ["p", "n"])
    assert rows_of(spark.read.parquet(f"{tmp_path}/few")) == rows_of(rows)


def test_compaction_joins_the_files_of_a_large_slice_without_a_shuffle(spark, table, monkeypatch):
    """Slices from ALONE_BYTES on are joined by jobs of their own, smaller ones together; rows, also those written before a
    column came, are the same."""
    def insert(a, part, n):
        sinks.insert_rows(spark.range(n).selectExpr(f"int(id + {a}) AS a", f"{part} AS part", "date('2024-01-01') AS day"), table)

    for k in range(4):
        insert(1000 * k, "'it''s/'", 500)
        insert(1000 * k, "string(null)", 500)
        insert(k, "'small'", 1)
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS (late STRING)")
    sinks.insert_rows(spark.sql("SELECT 7 AS a, \"it's/\" AS part, DATE '2024-01-01' AS day, 'l' AS late"), table)
    before = rows_of(spark.table(table))
    monkeypatch.setattr(sinks, "ALONE_BYTES", 4000)
    shuffled = []
    real = sinks.balanced
    monkeypatch.setattr(sinks, "balanced", lambda rows, *rest: shuffled.append(rows.count()) or real(rows, *rest))
    assert sinks.compact(spark, table) == 3 and shuffled == [4]
    spark.catalog.refreshTable(table)
    folder = versions.table_folder(spark, table)
    assert [len(folder.sizes(p)) for p in versions.slice_places(spark, table, 2).values()] == [1, 1, 1]
    assert rows_of(spark.table(table)) == before and sinks.compact(spark, table) == 0


def test_scanned_rows_of_large_slices_are_written_where_they_are(spark, table, tmp_path, monkeypatch):
    """Tasks that hold enough rows of each slice write them without a shuffle; else, and for other frames, slices are balanced."""
    spark.range(0, 600, 1, 3).selectExpr("int(id) AS a", "if(id % 2 = 0, 'it''s/', NULL) AS part", "date('2024-01-01') AS day").write.parquet(f"{tmp_path}/in")
    rows = spark.read.parquet(f"{tmp_path}/in")
    shuffled = []
    real = sinks.balanced
    monkeypatch.setattr(sinks, "balanced", lambda df, *rest: shuffled.append(1) or real(df, *rest))
    tasks = rows.select(F.spark_partition_id()).distinct().count()

    def written(**how):
        sinks.write_slice(rows, table, **how)
        spark.catalog.refreshTable(table)
        assert held(spark, table) == rows_of(rows.selectExpr("a", "part", "string(day)"))
        folder = versions.table_folder(spark, table)
        return [len(folder.sizes(p)) for p in versions.slice_places(spark, table, 2).values()]

    monkeypatch.setattr(sinks, "LEAST_ROWS_PER_FILE", 300 // tasks)
    assert written(scanned=True) == [tasks, tasks] and not shuffled
    monkeypatch.setattr(sinks, "LEAST_ROWS_PER_FILE", 300 // tasks + 1)
    assert written(scanned=True) == [1, 1] and shuffled == [1]
    monkeypatch.setattr(sinks, "LEAST_ROWS_PER_FILE", 1)
    written()
    assert shuffled == [1, 1]
    sinks.write_slice(rows.limit(0), table, scanned=True)
