"""Embedding near-duplicates by E8 lattice hashing.

In each of several tables, a unit vector is projected on eight random directions and decoded to the nearest point
of the E8 lattice: its home cell. It also visits the ``probes`` lattice points that come next, found by asking
for the nearest point a small step away in the directions of the largest rounding errors. Residents and
visitors of a cell are compared by exact cosine in double precision.

A pair that meets in several cells counts only in the first one, which follows from the cells that both
carry along, so a vector's links are sums of what each cell finds, and no list of pairs exists. A task gets cells
in key order and compares a cell's rows in blocks; cells of more than ``chunk`` rows are dealt as pairs of chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import components, mixed, stored
from strata.llm.topk import usable


def nearest(x: np.ndarray) -> np.ndarray:
    """Nearest points of E8 to the rows of ``x``, doubled so that they are integers.

    E8 is D8 (integer points of even sum) together with D8 shifted by one half.
    """
    def d8(y: np.ndarray) -> np.ndarray:
        r = np.rint(y)
        odd = np.flatnonzero(r.sum(axis=1) % 2)
        if len(odd):
            off = y[odd] - r[odd]
            worst = np.abs(off).argmax(axis=1)
            r[odd, worst] += np.where(off[np.arange(len(odd)), worst] >= 0, 1, -1)
        return r

    a, b = d8(x), d8(x - 0.5) + 0.5
    closer = ((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1)
    return np.where(closer[:, None], 2 * a, 2 * b).astype(np.int64)


def cells(unit: np.ndarray, tables: int, width: float, probes: int, seed: int) -> np.ndarray:
    """(row, table, 1 + probes) cell numbers: the home cell, then the neighbours that come next."""
    out = np.empty((len(unit), tables, 1 + probes), np.int64)
    weights = np.random.default_rng(99).integers(1, 2**62, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for t in range(tables):
        rng = np.random.default_rng([seed, t, unit.shape[1]])
        x = unit @ (rng.standard_normal((unit.shape[1], 8)) / width) + rng.random(8)
        home = nearest(x)
        # A step over the facet towards each of the 240 shortest lattice vectors; those that lead closest come first.
        off = x - home / 2
        gain = off @ ROOTS.T  # the facet of root r is crossed where this reaches 1
        best = np.argpartition(-gain, probes, axis=1)[:, :probes] if probes else np.empty((len(x), 0), np.int64)
        for j in range(1 + probes):
            point = home if j == 0 else home + (2 * ROOTS[best[:, j - 1]]).astype(np.int64)
            out[:, t, j] = mixed((point.astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64) + np.uint64(t)).view(np.int64)
    return out


def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    found = []
    for i in range(8):
        for j in range(i):
            for a in (1, -1):
                for b in (1, -1):
                    v = np.zeros(8)
                    v[i], v[j] = a, b
                    found.append(v)
    for signs in range(256):
        v = np.array([0.5 if signs >> i & 1 else -0.5 for i in range(8)])
        if (v < 0).sum() % 2 == 0:
            found.append(v)
    return np.array(found)


ROOTS = _roots()


def _hash(tables: int, width: float, probes: int, seed: int, single: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("v").to_pylist()
            ids, labels = np.array(batch.column("row").to_pylist(), np.int64), np.array(batch.column("label").to_pylist(), np.int64)
            for dims in sorted({len(v) for v in rows}):
                own = [i for i, v in enumerate(rows) if len(v) == dims]
                x = np.array([rows[i] for i in own], np.float64)
                x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in the norm
                x = x / np.linalg.norm(x, axis=1, keepdims=True)
                found = cells(x, tables, width, probes, seed)
                found = mixed((found.view(np.uint64) ^ mixed(labels[own].view(np.uint64))[:, None, None]) + np.uint64(dims)).view(np.int64)
                data = [np.array(rows[i], "<f4" if single else "<f8").tobytes() for i in own]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[own]), pa.array(data, pa.binary()), pa.array([r.tobytes() for r in found], pa.binary()),
                     pa.array(found.reshape(len(own), -1).tolist(), pa.list_(pa.int64()))], ["row", "unit", "cells", "keys"])

    return run


def _compare(least: float, tables: int, single: bool):
    def links(part: list[dict]) -> tuple[np.ndarray, np.ndarray]:
        """Index pairs of a group of rows that meet first in this cell, at cosine ``least`` or more."""
        part = sorted(part, key=lambda r: (not r["home"], r["row"]))
        x = np.stack([np.frombuffer(r["unit"], "<f4" if single else "<f8") for r in part]).astype(np.float64)
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        keys = np.stack([np.frombuffer(r["cells"], np.int64).reshape(tables, -1) for r in part])
        home = np.array([r["home"] for r in part])
        side = np.array([r["side"] for r in part])
        t, ids = part[0]["t"], np.array([r["row"] for r in part], np.int64)
        residents = int(home.sum())
        found_a, found_b = [], []
        for at in range(0, residents, 512):
            to = min(at + 512, residents)
            a, b = np.nonzero(x[at:to] @ x.T >= least - 1e-9)  # rounding is settled below
            a += at
            ok = (b >= residents) | (a < b)
            # Rows of two chunks meet across; chunk pairs of one side hold its inner pairs.
            ok &= (side[a] != side[b]) | (side[a] == 2)
            a, b = a[ok], b[ok]
            ok = np.einsum("ij,ij->i", x[a], x[b]) >= least
            a, b = a[ok], b[ok]
            if len(a):
                ha, hb = keys[a, :, :1], keys[b, :, :1]
                met = (ha == hb)[:, :, 0] | (keys[b] == ha).any(axis=2) | (keys[a] == hb).any(axis=2)
                first = ~met[:, :t].any(axis=1)
                # Both may visit each other's home: the pair counts where the larger id is the visitor.
                mutual = (keys[a][:, t] == hb[:, t]).any(axis=1) & ~home[b]
                first &= ~mutual | (ids[a] < ids[b])
                a, b = a[first], b[first]
            found_a.append(ids[a])
            found_b.append(ids[b])
        none = [np.empty(0, np.int64)]
        return np.concatenate(found_a or none), np.concatenate(found_b or none)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None

        def out(part):
            if len(part) > 1 and any(r["home"] for r in part):
                a, b = links(part)
                if len(a):
                    ids, n = np.unique(np.r_[a, b], return_counts=True)
                    roots = _local_roots(ids, a, b)
                    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n), pa.array(roots)], ["row", "n", "root"])

        for batch in batches:
            for r in batch.to_pylist():
                k = (r["cell"], r["t"], r["i"], r["j"])
                if k != key:
                    yield from out(held)
                    held, key = [], k
                held.append(r)
        yield from out(held)

    return run


def _local_roots(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest id reachable from each of ``ids`` over the pairs (a, b)."""
    at, a, b = np.arange(len(ids)), np.searchsorted(ids, a), np.searchsorted(ids, b)
    while True:
        low = np.minimum(at[a], at[b])
        new = at.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == at).all():
            return ids[at]
        at = new


def lattice_links(
    spark: SparkSession, vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    least: float = 0.93, tables: int = 8, width: float = 0.95, probes: int = 4, chunk: int = 2000, seed: int = 11,
) -> DataFrame:
    """(key, n_links, component_id, kept) for every row.

    Only rows of equal, non-null label are compared. Vectors that are null, zero or hold null or non-finite
    components link with nothing and are their own component; so do rows with a null key (component null, not
    kept). Repeated keys are told apart while linking; each row has its own ``n_links``. Every link is exact;
    a pair near ``least`` is found with a chance the README gives, closer ones more surely.
    """
    usable_row = F.col(key).isNotNull() & F.col(label).isNotNull() & usable(vector) & F.exists(F.col(vector), lambda x: x != 0)
    rows = stored(spark, vectors.select(F.col(key).cast("long").alias("id"), F.xxhash64(F.col(label)).alias("label"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(usable_row, F.lit(False)).alias("ok"))
                  .withColumn("row", F.monotonically_increasing_id()), "lattice-rows")
    single = vectors.schema[vector].dataType.elementType.typeName() == "float"  # the double of a float fits a float
    units = stored(spark, rows.where("ok").select("row", "label", "v").mapInArrow(
        _hash(tables, width, probes, seed, single), "row long, unit binary, cells binary, keys array<long>"), "lattice-units")
    # Cells are counted and split as short rows; vectors join at the end, for one shuffle.
    k = F.col("k")
    light = units.select("row", F.posexplode("keys").alias("k", "cell")).select(
        "row", "cell", F.floor(k / (1 + probes)).cast("int").alias("t"), (k % (1 + probes) == 0).alias("home"))
    size = light.groupBy("cell", "t").agg(F.count("*").alias("n"), F.max("home").alias("used")).where("n > 1 and used")
    member = light.join(size, ["cell", "t"]).withColumn("parts", F.ceil(F.col("n") / chunk).cast("int"))
    member = member.withColumn("mine", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int"))
    # A chunk meets itself (side 2) and every other chunk once; the lower number is side 0.
    member = member.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "cell", "t", "home", "row", F.least("mine", "o").alias("i"), F.greatest("mine", "o").alias("j"),
        F.when(F.col("o") == F.col("mine"), 2).when(F.col("mine") < F.col("o"), 0).otherwise(1).alias("side"))
    group = ["cell", "t", "i", "j"]
    met = member.join(units.select("row", "unit", "cells"), "row").repartition(*group).sortWithinPartitions(*group)
    found = stored(spark, met.mapInArrow(_compare(least, tables, single), "row long, n long, root long"), "lattice-found")
    counts = found.groupBy("row").agg(F.sum("n").alias("n"))
    ids = rows.select("row", "id")
    links = found.where("row <> root").select("row", "root").distinct().join(ids.select("row", F.col("id").alias("a")), "row").join(
        ids.select(F.col("row").alias("root"), F.col("id").alias("b")), "root").select("a", "b")
    roots = components(spark, links, "lattice")
    out = rows.select("row", "id").join(counts, "row", "left").join(roots.withColumnRenamed("node", "id"), "id", "left")
    component = F.coalesce("root", "id")
    return out.select(F.col("id").alias(key), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"))
