"""Exact links between the components of large candidate groups, in blocks of bounded size.

A group whose members already form one component has nothing left to find. In the others, members are dealt to
blocks by size class and hash; texts whose sizes differ by a factor above ``1 / similarity`` cannot link, so
blocks meet those of their own and the two neighbouring classes only. The largest component of a group never
meets itself. Two blocks meet in one task, which holds both: shingles are ordered from rare to common, and only
texts that share one of their first shingles are compared (the prefix filter, which loses no link), and only
across components. A task emits links between components, not pairs of texts.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_TEXTS = 1_000
BLOCK_SHINGLES = 400_000


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    return len(np.intersect1d(x, y, assume_unique=True))


def links_between(sets: list[np.ndarray], label: np.ndarray, side: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Pairs of labels with a pair of alike sets, enough to connect the same labels as all of them.

    Sets of side 1 meet those of side 0; with one side only, all meet.
    """
    flat = np.concatenate(sets)
    size = np.array([len(s) for s in sets])
    _, token, count = np.unique(flat, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), size)
    order = np.lexsort((token, count[token], owner))
    place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    first = place < np.repeat(size - np.ceil(similarity * size - 1e-9).astype(np.int64) + 1, size)
    token, owner = token[order][first], owner[order][first]

    least, most = np.full(len(count), np.iinfo(np.int64).max), np.full(len(count), np.iinfo(np.int64).min)
    np.minimum.at(least, token, label[owner])
    np.maximum.at(most, token, label[owner])
    mixed = least[token] < most[token]  # only shingles of several components can link them
    token, owner = token[mixed], owner[mixed]

    both = bool(side.any()) and not bool(side.all())
    held = token[side[owner] == 0] if both else token
    rows = owner[side[owner] == 0] if both else owner
    order = np.argsort(held, kind="stable")
    held, rows = held[order], rows[order]
    begin, end = np.searchsorted(held, token), np.searchsorted(held, token, side="right")
    probes = defaultdict(list)
    for k in np.flatnonzero((side[owner] == 1) if both else np.ones(len(owner), bool)).tolist():
        probes[int(owner[k])].append(k)

    now, found = label.copy(), []
    for y, entries in probes.items():
        met = np.zeros(len(sets), bool)
        for k in entries:
            met[rows[begin[k]:end[k]]] = True
        met &= (now != now[y]) & (np.minimum(size, size[y]) >= similarity * np.maximum(size, size[y]) - 1e-9)
        for x in np.flatnonzero(met).tolist():
            if now[x] != now[y]:
                common = overlap(sets[x], sets[y])
                if common >= similarity * (size[x] + size[y] - common):
                    found.append((int(label[x]), int(label[y])))
                    now[now == now[x]] = now[y]
    return found


def crossings(rows: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(a, b): links between roots, from group members (g, w, n, root) and their shingle sets (w, set).

    ``n`` is the size of the set. Together with the roots given, the links connect any two members of a group
    whose sets have a Jaccard similarity of ``similarity`` or more.
    """
    parts = rows.groupBy("g", "root").agg(F.count("*").alias("texts"))
    chief = parts.groupBy("g").agg(F.max(F.struct("texts", "root")).alias("top"), F.count("*").alias("roots"))
    chief = chief.where("roots > 1").select("g", F.col("top.root").alias("chief"))
    # Sizes of a linked pair differ by less than one step of this scale, so by one class at most.
    step = math.log(1.001 / similarity)
    dealt = rows.join(chief, "g").withColumn("cls", F.floor(F.log("n") / step).cast("int")).withColumn(
        "part", (F.col("root") != F.col("chief")).cast("int")).select("g", "w", "root", "n", "cls", "part")
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK_TEXTS, F.sum("n") / BLOCK_SHINGLES)).cast("long")
    loads = dealt.groupBy("g", "cls", "part").agg(blocks.alias("blocks"))
    near = loads.select("g", F.explode(F.expr("array(cls - 1, cls, cls + 1)")).alias("c"), F.struct("cls", "part", "blocks").alias("load"))
    near = near.groupBy("g", F.col("c").alias("cls")).agg(F.collect_list("load").alias("loads"))  # six at most
    others = "flatten(transform(filter(loads, x -> x.part + part > 0), x -> transform(sequence(0L, x.blocks - 1), j -> struct(x.cls, x.part, j))))"
    own = "filter(loads, x -> x.cls = cls and x.part = part)[0].blocks"
    met = dealt.join(near, ["g", "cls"]).withColumn("mine", F.struct("cls", "part", F.expr(f"pmod(xxhash64(w), {own})").alias("j")))
    met = met.select("g", "w", "root", "mine", F.explode(F.expr(others)).alias("other"))
    cell = ["g", "cls", "part", "j", "cls2", "part2", "j2"]
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    met = met.select("g", "w", "root", (F.col("mine") > F.col("other")).cast("int").alias("side"), low.alias("low"), high.alias("high"))
    met = met.select("w", "root", "side", "g", "low.*", *(F.col(f"high.{c}").alias(f"{c}2") for c in ("cls", "part", "j")))

    def compare(cell_rows: pa.Table) -> pa.Table:
        found = links_between([np.frombuffer(s, np.uint64) for s in cell_rows.column("set").to_pylist()],
                              cell_rows.column("root").to_numpy(), cell_rows.column("side").to_numpy(), similarity)
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return met.join(sets, "w").groupBy(*cell).applyInArrow(compare, "a long, b long").distinct()
