"""Deduplication that stays whole and balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata import schema

# Copies of one row that a single task writes out when a count is turned back into rows.
COPIES_PER_CHUNK = 1_000_000


def one_per_key(df: DataFrame, keys: Iterable[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key under ``order``.

    Rank 1 alone is wanted, so Spark limits each key within every map task before the shuffle
    (WindowGroupLimit): a hot key sends one row per task and never gathers whole.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")


def total_order(df: DataFrame, order_by: Iterable[str], latest: bool) -> list[Column]:
    """The given columns, then all others as tie-breaks, so equal ranks mean equal rows."""
    order_by = list(order_by)
    names = [*order_by, *[c for c in df.columns if c not in set(order_by)]]
    return [F.col(c).desc_nulls_last() if latest else F.col(c).asc_nulls_first() for c in names]


def dedup_latest(df: DataFrame, keys: Iterable[str] = schema.MATCH_KEY,
                 order_by: Iterable[str] = ("_ingestion_ts",)) -> DataFrame:
    """Keep the newest row of each key."""
    return one_per_key(df, keys, total_order(df, order_by, latest=True))


def dedup_newest(df: DataFrame, newest_by: Mapping[str, str] | Sequence[str] = (),
                 keys: Iterable[str] = schema.MATCH_KEY) -> DataFrame:
    """Keep the newest row of each key in a batch of text columns.

    ``newest_by`` lists columns, or maps them to the types they are compared in, so that 10 is newer than 9;
    values that do not parse are the oldest. Then the newer file wins, then the other columns break ties.
    """
    types = newest_by if isinstance(newest_by, Mapping) else dict.fromkeys(newest_by)
    first = [F.col(c).try_cast(t) if t else F.col(c) for c, t in types.items()]
    rest = total_order(df, [c for c in ("_source_batch_nr", "_ingestion_ts") if c in df.columns], latest=True)
    return one_per_key(df, keys, [*[c.desc_nulls_last() for c in first], *rest])


def dedup_first(df: DataFrame, keys: Iterable[str] = schema.MATCH_KEY,
                order_by: Iterable[str] = ("_ingestion_ts",)) -> DataFrame:
    """Keep the oldest row of each key."""
    return one_per_key(df, keys, total_order(df, order_by, latest=False))


def _many_alike(df: DataFrame, columns: Sequence[str]) -> bool:
    """Whether over ``COPIES_PER_CHUNK`` rows may agree in ``columns``: counts by a short hash, so a few rows per task are
    shuffled. Hashes that meet by chance only make it true too often."""
    bucket = F.pmod(F.xxhash64(*columns), F.lit(1 << 16)).cast("int").alias("_bucket")
    counts = df.groupBy(bucket).agg(F.count(F.lit(1)).alias("_n"))
    return not counts.filter(F.col("_n") > COPIES_PER_CHUNK).isEmpty()


def bag_difference(whole: DataFrame, part: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows of ``whole`` that are left after taking each row of ``part`` away once.

    Counting per distinct row spreads a hot key over all tasks. Rows of ``whole`` are first counted by a hash, of ``keys``
    and then of all columns. Where no row has many copies, rows are shuffled once, and the task that counts a row writes
    its copies. Otherwise copies are folded together before the shuffle, and counts become rows again in chunks that
    are shuffled apart, so a group of copies is written by many tasks.
    """
    names = whole.columns
    signed = whole.select(*names, F.lit(1).cast("bigint").alias("_n")).unionByName(
        part.select(*names, F.lit(-1).cast("bigint").alias("_n"))
    )
    many = _many_alike(whole, list(keys) or names) and (not keys or _many_alike(whole, names))
    # Few copies: nothing to fold, so rows are not gathered in a map task's memory before they are shuffled.
    placed = signed if many else signed.repartition(*names)
    left = placed.groupBy(*names).agg(F.sum("_n").alias("_n")).filter(F.col("_n") > 0)
    if not many:
        return left.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int")))).select(*names)
    chunks = left.withColumn("_chunk", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.expr(f"(_n - 1) div {COPIES_PER_CHUNK}"))))
    # A fixed number of partitions: adaptive execution would join the chunks again, as they are still short.
    partitions = int(whole.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = F.least(F.lit(COPIES_PER_CHUNK), F.col("_n") - F.col("_chunk") * COPIES_PER_CHUNK)
    copies = chunks.repartition(partitions, *names, "_chunk").withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), size.cast("int"))))
    return copies.select(*names)


def validate_duplicates(df: DataFrame, key_columns: Iterable[str], order_by: Iterable[str] = (),
                        keep: str = "first") -> tuple[DataFrame, DataFrame]:
    """(one row per key, all other rows). ``keep`` is ``first`` or ``latest`` under ``order_by``.

    Row positions are not stable between runs, so the order is by columns; those not named in
    ``order_by`` break ties.
    """
    if keep not in ("first", "latest"):
        raise ValueError("keep must be 'first' or 'latest'")
    keys = list(key_columns)
    kept = one_per_key(df, keys, total_order(df, order_by, latest=keep == "latest"))
    return kept, bag_difference(df, kept, keys)
