"""Writes to layer tables and folders.

Every write is safe to repeat: it replaces the slices it owns, or inserts only what is absent.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from strata import schema
from strata.operators.clean import conform
from strata.sources.versions import (
    Layout, Slices, append_files, forget, merge_version, partition_columns, partition_spec, publish, settle, slice_places, slice_values, table_folder,
    write_version,
)

# Rows of a file, and so of the task that writes it, where a number of files is asked for that is too small for the rows.
ROWS_PER_FILE = 1_000_000
# Rows that a file must hold on average where rows are written to slices by the tasks that a scan deals them to.
LEAST_ROWS_PER_FILE = 100_000
# Bytes of a slice whose small files are joined by a job of their own.
ALONE_BYTES = 16 << 20


def balanced(df: DataFrame, columns: Sequence[str] = (), num_files: int | None = None) -> DataFrame:
    """Lay rows out for writing.

    A rebalance groups rows by partition columns, yet splits a large partition over several tasks and
    joins small ones, so file sizes stay even when one slice holds most rows. Sizes are measured in the shuffle and
    aimed at ``spark.sql.adaptive.advisoryPartitionSizeInBytes``. ``num_files`` is an upper bound on the tasks that
    write (and so on the files of a slice) unless one of them is far larger than the others and is split.
    """
    return df.hint("rebalance", *([num_files] if num_files else []), *columns)


def bounded(num_files: int | None) -> Layout:
    """``balanced`` with a subject's ``num_partitions``."""
    return lambda df, columns: balanced(df, columns, num_files)


def as_dealt(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows stay in the tasks that a scan deals them to, where these have enough rows of each slice that they hold; else
    they are ``balanced``. For frames that are read from files and changed row by row only: the pieces are counted first, by
    the partition columns alone, which would repeat costlier steps.
    """
    pieces = df.groupBy(F.spark_partition_id().alias("_task"), *columns).agg(F.count(F.lit(1)).alias("_n"))
    found = pieces.agg(F.count(F.lit(1)).alias("files"), F.sum("_n").alias("rows")).first()
    enough = found.files > 0 and found.rows >= found.files * LEAST_ROWS_PER_FILE
    return df if enough else balanced(df, columns)


def unshuffled(df: DataFrame) -> DataFrameWriter:
    """A writer without partition columns: rows are written by the tasks that hold them, as scans deal even ones and
    adaptive execution joins small and splits skewed ones. A large task writes several files."""
    return df.write.option("maxRecordsPerFile", ROWS_PER_FILE)


def write_overwrite(df: DataFrame, path: str) -> None:
    """Replace everything, schema included."""
    unshuffled(df).mode("overwrite").parquet(path)


def _replace(df: DataFrame, table: str, owned: Slices, layout: Layout) -> None:
    spark, version = df.sparkSession, f"v-{uuid.uuid4().hex}"
    folder = table_folder(spark, table)
    publish(spark, table, version, write_version(df, table, version, layout, folder=folder), owned, folder=folder)


def write_slice(df: DataFrame, table: str, *, scanned: bool = False) -> None:
    """Replace the partitions that occur in ``df`` and leave all others. Readers see each one whole, old or new.

    ``scanned`` tells that ``df`` comes straight from files: rows in a few large slices are then not shuffled (``as_dealt``).
    """
    _replace(df, table, lambda _: False, as_dealt if scanned else balanced)


def replace_owned(df: DataFrame, table: str, owned: Mapping[str, str], num_files: int | None = None) -> None:
    """Replace all partitions with the values ``owned``, also those that ``df`` has no row for any more. New rows are
    written before anything old goes."""
    _replace(df, table, lambda values: all(values[c] == v for c, v in owned.items()), bounded(num_files))


def write_append(df: DataFrame, path: str) -> None:
    """Add rows; new columns may appear, and ``read_evolved`` shows them as NULL in older rows."""
    unshuffled(df).mode("append").parquet(path)


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(path)


def write_partitioned(df: DataFrame, path: str, columns: Sequence[str] = ()) -> None:
    """Replace everything, partitioned when partition columns are given."""
    writer = balanced(df, columns).write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*columns) if columns else writer).parquet(path)


def append_rows(df: DataFrame, table: str) -> None:
    """Append a few log or configuration rows."""
    append_files(df, table, lambda rows, _: rows.coalesce(1))


def replace_small(df: DataFrame, table: str) -> None:
    """Replace a configuration table by rows that were built on the driver."""
    conform(df, df.sparkSession.table(table).schema).coalesce(1).write.mode("overwrite").insertInto(table)


def insert_rows(df: DataFrame, table: str, num_files: int | None = None) -> None:
    """Append rows that the caller has shown to be absent."""
    append_files(df, table, bounded(num_files))


def write_quarantine(df: DataFrame, table: str) -> None:
    """Replace the (batch, reason) slices of the rejected rows; a re-run does not double them."""
    write_slice(df, table)


def archive_batch(df: DataFrame, root: str, data_subject: str, load_job_nr: str) -> str:
    """Keep a processed batch under ``root/subject/job``; returns that folder."""
    path = f"{root.rstrip('/')}/{data_subject}/{load_job_nr}"
    df.write.mode("overwrite").parquet(path)
    return path


def partition_values(df: DataFrame, columns: Sequence[str]) -> list[dict[str, str]]:
    """The distinct partition values in a frame: calendar months times frequencies, a short list."""
    return [row.asDict() for row in df.select(*columns).distinct().collect()]


def archive_partitions(spark: SparkSession, table: str, archive: str, predicate: Column,
                       archived_ts: datetime) -> int:
    """Move the partitions selected by a predicate over partition columns to the archive table.

    Rows are written to the archive first (replacing the same partitions there), then the partitions
    are dropped from the source, so a run that stops in between is completed by running it again.
    Returns the number of partitions moved.
    """
    columns = partition_columns(spark, table)
    source = spark.table(table).filter(predicate)
    chosen = partition_values(source, columns)
    if not chosen:
        return 0
    write_slice(source.withColumn("_archived_ts", F.lit(archived_ts).cast("timestamp")), archive, scanned=True)
    specs = ", ".join(f"PARTITION ({partition_spec(values)})" for values in chosen)
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")
    moved = [{c: None if v is None else str(v) for c, v in values.items()} for values in chosen]
    forget(spark, table, lambda values: values in moved)
    return len(chosen)


def enough_files(df: DataFrame, num_files: int | None) -> int | None:
    """``num_files``, or more where its files would hold over ``ROWS_PER_FILE`` rows each."""
    return max(num_files, -(-df.count() // ROWS_PER_FILE)) if num_files else None


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], num_files: int | None = None) -> None:
    """Sorted ranges of ``columns`` per file, so Parquet statistics let a scan skip files.

    A hash of the whole row is the last range column: a key with very many rows is then spread over
    several adjacent files. ``num_files`` is for a small frame: one task writes a file, so a larger frame has more of
    them, of ``ROWS_PER_FILE`` rows at most on average. Rows are counted first.
    """
    spread = F.xxhash64(*df.columns)
    ranges = [*[F.col(c) for c in columns], spread]
    num_files = enough_files(df, num_files)
    ranged = df.repartitionByRange(num_files, *ranges) if num_files else df.repartitionByRange(*ranges)
    ranged.sortWithinPartitions(*columns).write.mode("overwrite").parquet(path)


def _cuts(df: DataFrame, column: str, parts: int, sample: int = 4096) -> list:
    """Values that divide the column's distinct values into about equal parts, from the ``sample`` with the smallest hashes."""
    values = df.select(F.col(column).alias("v")).filter("v IS NOT NULL").distinct().orderBy(F.xxhash64("v")).limit(sample)
    found = sorted(row.v for row in values.collect())
    return sorted({found[len(found) * k // parts] for k in range(1, parts)}) if found else []


def _part(column: Column, cuts: list) -> Column:
    """The number of cuts at or below a value, by halving; NULL is 0."""
    if not cuts:
        return F.lit(0)
    middle = len(cuts) // 2
    return F.when(column >= F.lit(cuts[middle]), middle + 1 + _part(column, cuts[middle + 1:])).otherwise(_part(column, cuts[:middle]))


def z_value(df: DataFrame, columns: Sequence[str], bits: int = 6) -> Column:
    """One number whose bits are those of the columns' ranks in turn, so that near numbers are near in every column."""
    out = F.lit(0).cast("bigint")
    for j, name in enumerate(columns):
        rank = _part(F.col(name), _cuts(df, name, 1 << bits)).cast("bigint")
        for i in range(bits):
            out = out + F.shiftleft(F.shiftright(rank, i).bitwiseAND(1), i * len(columns) + j)
    return out


def write_interleaved(df: DataFrame, path: str, columns: Sequence[str], num_files: int | None = None) -> None:
    """Files that are narrow ranges of every one of ``columns``: a filter on any of them alone skips most files, where
    ``write_clustered`` serves the leading column. A hash of the row divides equal ranks over several files; a large frame
    has more than ``num_files`` of them, as there."""
    placed = df.withColumn("_z", z_value(df, columns))
    spread = F.xxhash64(*df.columns)
    num_files = enough_files(df, num_files)
    ranged = placed.repartitionByRange(num_files, "_z", spread) if num_files else placed.repartitionByRange("_z", spread)
    ranged.sortWithinPartitions("_z", *columns).drop("_z").write.mode("overwrite").parquet(path)


def compact(spark: SparkSession, table: str, target_bytes: int = 128 << 20, least_files: int = 4) -> int:
    """Rewrite slices that lie in ``least_files`` or more files of less than half of ``target_bytes`` on average; returns
    their number.

    File sizes are read from the file system. A slice of ``ALONE_BYTES`` or more is joined by a job of its own, whose tasks
    read whole files one after the other, without a shuffle; the smaller ones are shuffled together. The new files are a version like any other: readers see either
    state whole, and if another run publishes one of the slices meanwhile, they are read again. Appends are no
    publications: do not compact a slice while rows are appended to it.
    """
    folder = table_folder(spark, table)
    settle(spark, table, folder)
    small, alone = {}, {}
    for name, place in slice_places(spark, table, len(folder.columns)).items():
        sizes = folder.sizes(place)
        if len(sizes) >= least_files and 2 * sum(sizes) < target_bytes * len(sizes):
            small[name] = slice_values(name)
            if sum(sizes) >= ALONE_BYTES:
                alone[name] = -(-sum(sizes) // target_bytes)
    if not small:
        return 0

    def is_slice(values: Mapping[str, str | None]) -> Column:
        return reduce(Column.__and__, [F.col(c).cast("string").eqNullSafe(F.lit(v)) for c, v in values.items()])

    def together() -> DataFrame:
        keys = spark.createDataFrame([tuple(values[c] for c in folder.columns) for name, values in small.items() if name not in alone],
                                     ", ".join(f"_s_{c} string" for c in folder.columns))
        same = [F.col(c).cast("string").eqNullSafe(F.col(f"_s_{c}")) for c in folder.columns]
        return spark.table(table).join(F.broadcast(keys), reduce(Column.__and__, same), "left_semi")

    def join_alone(version: str) -> list[str]:
        def join(name: str) -> None:
            rows = spark.table(table).filter(is_slice(small[name])).drop(*folder.columns)
            rows.coalesce(alone[name]).write.parquet(folder.path("_versions", version, name).toString())

        with ThreadPoolExecutor(8) as pool:
            list(pool.map(join, alone))
        return list(alone)

    merge_version(spark, table, lambda values: values in small.values(), f"compact/{uuid.uuid4().hex}", together, lambda _: {}, balanced, also=join_alone)
    return len(small)


def merge_insert_only(df: DataFrame, table: str, keys: Iterable[str]) -> None:
    """Insert the rows whose key the table does not hold; held rows never change."""
    held = df.sparkSession.table(table).select(*keys)
    insert_rows(df.join(held, list(keys), "left_anti"), table)


def add_missing_columns(df: DataFrame, table: str) -> None:
    """Let a table absorb columns that a source has newly added; older rows read as NULL."""
    spark = df.sparkSession
    have = set(spark.table(table).columns)
    extra = [f for f in df.schema.fields if f.name not in have]
    if extra:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in extra)
        try:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
        except AnalysisException:  # another run may have added them meanwhile
            spark.catalog.refreshTable(table)
            if not {f.name for f in extra} <= set(spark.table(table).columns):
                raise
