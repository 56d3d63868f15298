"""What several operators share: reading tables, stored intermediate tables, connected components,
rolling hashes over byte buffers and Arrow batches of bounded size.

Task code receives Arrow batches and emits them; Spark splits, shuffles and retries the work. Everything a
later step joins on is a function of the row, or was written to the shared folder before it is used, so a
task that runs twice gives the same rows.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import work_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage and survives lost executors."""
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def per_process(key, make):
    """``make()`` once per Python process; workers are reused, so later tasks find it made."""
    import types

    held = sys.modules.setdefault("_strata_llm_held", types.ModuleType("_strata_llm_held")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]


def tokenizer_file(name: str) -> str:
    """A vocabulary file by name, or a path of the caller's own."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def frames(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The same rows in slices whose text and binary columns hold about ``most`` bytes, one row at least."""
    for batch in batches:
        size = np.zeros(batch.num_rows, np.int64)
        for column in batch.columns:
            kind = column.type
            if pa.types.is_string(kind) or pa.types.is_binary(kind) or pa.types.is_large_string(kind):
                wide = column.cast(pa.large_binary())
                offsets = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset:wide.offset + len(wide) + 1]
                size += np.diff(offsets)
        block = np.cumsum(size) // max(most, 1)
        cuts = np.r_[0, np.flatnonzero(np.diff(block)) + 1, batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column, null as empty."""
    return [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]


class RollingHash:
    """64-bit hashes of all substrings of one length in a byte buffer, in a few vector passes.

    Prefix sums of byte codes times powers of an odd base, modulo 2**64; equal substrings have equal hashes
    wherever they start, and ``seed`` gives independent functions.
    """

    def __init__(self, seed: int, length: int = 0):
        rng = np.random.default_rng(seed)
        self.codes = rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = (int(rng.integers(0, 2**61)) * 8 + 5) % 2**64
        self.inverse = pow(self.base, -1, 2**64)
        self.up = self.down = np.ones(1, np.uint64)
        self._grow(length + 1)

    def _grow(self, n: int) -> None:
        if n > len(self.up):
            n = n + n // 4
            self.up = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, self.base, np.uint64)])
            self.down = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, self.inverse, np.uint64)])

    def prefix(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        out = np.empty(len(data) + 1, np.uint64)
        out[0] = 0
        np.cumsum(self.codes[data] * self.up[:len(data)], out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of ``data[start:end]``; spans of different lengths get different hashes for equal content."""
        return mixed((prefix[end] - prefix[start]) * self.down[start] + (end - start).astype(np.uint64))

    def windows(self, prefix: np.ndarray, length: int) -> np.ndarray:
        """Hashes of all substrings of ``length``, by start."""
        n = max(len(prefix) - length, 0)
        return mixed((prefix[length:] - prefix[:n]) * self.down[:n] + np.uint64(length))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every input bit over the word (multiply and shift, twice)."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def components(spark: SparkSession, links: DataFrame, name: str, rounds: int = 60) -> DataFrame:
    """(node, root): every node of ``links`` (a, b: long) with the smallest node reachable from it.

    Alternates two star steps: each node hands its larger neighbours, then its smaller ones, to the smallest
    neighbour it knows. Paths shrink by half, so rounds grow with the logarithm of a path's length. A round
    keeps at most one link per (node, neighbour); a hub's links are spread by the neighbour's id, for the
    smallest neighbour comes from an aggregate and is joined back. Each round is a stored table. Works on
    links alone: nodes without one are their own component and are not returned.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stored(spark, edges, f"{name}-links")
    before = None
    for k in range(rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        ).select("e.u", "e.v").where("u <> v").distinct()
        edges = stored(spark, small, f"{name}-round{k}")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = state
    raise RuntimeError("components did not settle; raise rounds")


def appended(docs: DataFrame, fields: str, compute, most: int = 2 << 20) -> DataFrame:
    """``docs`` with new columns, or same-named ones replaced: ``compute(batch)`` gives one array per field.

    ``fields`` is ``name type, ...``. All columns pass through Arrow in bounded slices; no shuffle.
    """
    names = [f.split(" ", 1)[0] for f in fields.split(", ")]
    passed = [c for c in docs.columns if c not in names]
    schema = docs.select([F.col(f"`{c}`") for c in passed]).schema
    new = docs.sparkSession.createDataFrame([], fields).schema
    for field in new.fields:
        schema = schema.add(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames(batches, most):
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in passed]
            yield pa.RecordBatch.from_arrays([*arrays, *compute(batch)], [*passed, *names])

    return docs.mapInArrow(run, schema)
