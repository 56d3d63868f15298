"""Exact top-k by inner product with MaxScore.

Vectors are quantised to integers and held in shards, dimension by dimension: a posting list per dimension.
For a query, a dimension's contribution above its least possible one is its score, and the greatest such score
in the shard its bound. Dimensions are ordered by bound; the non-essential ones are the longest tail of small
bounds that together cannot lift a row to the k-th best score. Essential postings are traversed, and the rest
are probed, largest bound first, only for rows that can still compete. Scores are exact integers.

Shards and blocks of queries meet by an equality join on block numbers, so no task holds all of either. Each
meeting keeps k rows per query, and a window over query and rank limit merges the shards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import frames, stored

WIDE = 1 << 20  # components beyond this go through unbounded integers


def usable(vector: str) -> Column:
    """Not null, not empty, and free of null and non-finite components."""
    bad = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & ~bad


def quantised(batch: pa.RecordBatch, name: str, scale: int) -> list[np.ndarray]:
    flat = batch.column(name)
    return [np.floor(np.asarray(v, np.float64) * scale) for v in flat.to_pylist()]


class Postings:
    """One shard: ids and, per dimension, the components of all its rows."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        exact = np.abs(rows).max(initial=0) <= WIDE
        self.lists = np.ascontiguousarray(rows[order].T) if exact else np.array([[int(x) for x in r] for r in rows[order].T], object)
        self.low, self.high = self.lists.min(axis=1), self.lists.max(axis=1)

    def top(self, query: np.ndarray, own: int, k: int, floor) -> list[tuple[int, int]]:
        """(id, score) of the k best rows but ``own``; rows below ``floor`` may be left out."""
        least = np.minimum(query * self.low, query * self.high)
        bound = np.maximum(query * self.low, query * self.high) - least
        order = np.argsort(-bound.astype(float), kind="stable")
        bound, base = bound[order], least.sum()
        tail = np.append(np.cumsum(bound[::-1])[::-1], 0)  # what dimensions from here on can add
        rows = np.flatnonzero(self.ids != own)
        if floor is None and len(rows) > k:  # a first floor: the k-th best of a few rows
            few = rows[:: max(1, len(rows) // (8 * k))]
            seen = query @ self.lists[:, few]
            floor = np.sort(seen)[-k] if len(few) >= k else None
        need = None if floor is None else floor - base
        essential = len(order) if need is None else int(np.searchsorted(-tail[:-1], -need, side="right"))
        got = np.zeros(len(rows), self.lists.dtype)
        at = 0
        for to in sorted({essential, *range(essential, len(order), 8), len(order)}):
            dims = order[at:to]
            if len(dims):
                part = self.lists[dims] if len(rows) == self.lists.shape[1] else self.lists[np.ix_(dims, rows)]
                got = got + (query[dims] - 0) @ part - least[dims].sum()
            at = to
            if need is not None:
                keep = got + tail[at] >= need
                rows, got = rows[keep], got[keep]
        score = got + base
        best = np.lexsort((self.ids[rows], -score))[:k] if score.dtype != object else sorted(range(len(rows)), key=lambda i: (-score[i], self.ids[rows[i]]))[:k]
        return [(int(self.ids[rows[i]]), int(score[i])) for i in best]


def _pack(scale: int):
    """Rows of one block as one row of bytes; a block is split where its vectors change length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        block = None

        def out():
            for dims in sorted({len(v) for _, v in held}):
                own = [(i, v) for i, v in held if len(v) == dims]
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([block], pa.int64()), "dims": pa.array([dims], pa.int32()),
                    "ids": pa.array([np.array([i for i, _ in own], "<i8").tobytes()], pa.binary()),
                    "data": pa.array([np.array([v for _, v in own], "<f8").tobytes()], pa.binary())})

        for batch in batches:
            for b, i, v in zip(batch.column("block").to_pylist(), batch.column("id").to_pylist(), quantised(batch, "v", scale)):
                if held and b != block:
                    yield from out()
                    held = []
                block = b
                held.append((i, v))
        if held:
            yield from out()

    return run


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames(batches, 1):
            row = batch.to_pylist()[0]
            dims = row["dims"]
            shard = Postings(np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["data"], "<f8").reshape(-1, dims))
            queries = np.frombuffer(row["q_data"], "<f8").reshape(-1, dims)
            if shard.lists.dtype == object or np.abs(queries).max(initial=0) > WIDE:
                queries = np.array([[int(x) for x in q] for q in queries], object)
            out: list[list[int]] = [[], [], []]
            for own, query in zip(np.frombuffer(row["q_ids"], "<i8").tolist(), queries):
                for i, score in shard.top(query, own, k, None):
                    for column, value in zip(out, (own, i, max(-2**63, min(2**63 - 1, score)))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["query_id", "vec_id", "score"])

    return run


def _blocks(spark: SparkSession, rows: DataFrame, size: int, scale: int, name: str) -> DataFrame:
    """(block, dims, ids, data): about ``size`` rows each, dealt by a hash of the id."""
    n = max(1, -(-rows.count() // size))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n))).repartition(min(n, 4096), "block").sortWithinPartitions("block", "id")
    return stored(spark, dealt.mapInArrow(_pack(scale), "block long, dims int, ids binary, data binary"), name)


def maxscore(
    spark: SparkSession, vectors: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding",
    scale: int = 256, shard: int = 8192, block: int = 2048,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of ``vectors`` with the highest inner product per query.

    Components are ``floor(scale * x)``. A query's own key is no candidate; ties go to the smaller key. Rows
    without key, and vectors that are null, empty or hold null or non-finite components, take no part; only
    vectors of equal length meet. A repeated key is a candidate as often as it occurs, and as a query counts
    once per distinct row. Components beyond 2**20 use unbounded integers, and scores are clamped to long.
    Empty inputs give no row.
    """
    def plain(df: DataFrame) -> DataFrame:
        return df.where(F.col(key).isNotNull() & usable(vector)).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))

    shards = _blocks(spark, plain(vectors), shard, scale, "shards")
    asked = _blocks(spark, plain(queries).distinct(), block, scale, "asked")
    blocks = asked.select(F.col("block").alias("q_block"), "dims", F.col("ids").alias("q_ids"), F.col("data").alias("q_data"))
    numbers = blocks.agg(F.coalesce(F.max("q_block"), F.lit(-1))).first()[0]
    if numbers < 0:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    met = shards.withColumn("q_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(numbers).cast("long")))).join(blocks, ["q_block", "dims"])
    found = met.repartition(F.col("q_block"), F.col("block"), F.col("dims")).select("ids", "data", "dims", "q_ids", "q_data").mapInArrow(_search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
