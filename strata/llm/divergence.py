"""How far the sources of a language differ in their words: exact distances between smoothed word distributions.

A term's row is its nonzero counts in the sources of the language. Smoothed probabilities are also positive where a
count is zero, so the distance of two sources is written as

    V |z - z'|                                   every term as if both counts were zero
  + sum over terms of the first source           what its counts change against z'
  + sum over terms of the second source          the same the other way round
  + sum over terms of both                       the pair correction

with z and z' the probabilities of a zero count. Only the last sum needs pairs of cells, and it comes from a
frequent-pattern tree: rows with equal cells are one path with a multiplicity, paths are ordered by source (small
sources first, as their counts repeat most), and rows that begin alike share nodes. When a node is left, its
correction with each ancestor is counted once, times the number of terms below it. Rows are range-partitioned
and sorted, so each task builds its trees as one branch at a time, and its sums are added up afterwards.

Words are counted per slice of documents before the shuffle, so a language or source with most rows sends few.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import frames, stored, texts_of

SCALE = 1_000_000_000
SMOOTH = 5
# Lower-cases A-Z and turns every other byte below 0x80 into a space; bytes above are parts of words.
WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
MOST_HELD = 1 << 18  # distinct entries that a task counts before it sends them


def words(text: bytes) -> list[bytes]:
    return text.translate(WORDS).split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) summed over the slices of a task."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def out() -> pa.RecordBatch:
        keys = [(lang, source, term, n, docs[term]) for (lang, source), (total, docs) in held.items() for term, n in total.items()]
        lang, source, term, n, docs = zip(*keys)
        return pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.string()), pa.array(source, pa.string()), pa.array(term, pa.binary()).cast(pa.string()),
             pa.array(n, pa.int64()), pa.array(docs, pa.int64())], ["lang", "source", "term", "n", "docs"])

    size = 0
    for batch in frames(batches, 1 << 20):
        for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts_of(batch.column("text"))):
            total, docs = held.setdefault((lang, source), (Counter(), Counter()))
            found = words(text)
            size -= len(total)
            total.update(found)
            docs.update(set(found))
            size += len(total)
            if size >= MOST_HELD:
                yield out()
                held, size = {}, 0
    if size:
        yield out()


def term_rows(docs: DataFrame, least_docs: int) -> DataFrame:
    """(lang, term, cells: array of (source, n)): the kept terms with their nonzero counts."""
    sent = docs.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    # Both aggregates stay in the partitions of (lang, term).
    each = sent.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    rows = each.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "n")).alias("cells"), F.sum("docs").alias("docs"))
    return rows.where(F.col("docs") >= least_docs).drop("docs")


def share(n: str, total: str = "total", terms: str = "terms") -> Column:
    """1 + floor(SCALE * (n + SMOOTH) / (total + SMOOTH * terms)) in exact integers; NULL where there is no term."""
    return F.expr(
        f"CASE WHEN {terms} > 0 THEN 1 + (CAST({SCALE} AS DECIMAL(10,0)) * CAST({n} + {SMOOTH} AS DECIMAL(20,0)))"
        f" DIV CAST({total} + {SMOOTH} * {terms} AS DECIMAL(20,0)) END")


def groups_of(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(lang, source, total, terms, zero, no): every occurring group with its number of kept words, the kept terms of
    its language, the probability of a zero count and its place in the order of paths."""
    totals = rows.select("lang", F.explode("cells").alias("c")).groupBy("lang", "c.source").agg(F.sum("c.n").alias("total"))
    terms = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    found = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(terms, "lang", "left")
    found = found.select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("terms", F.lit(0)).alias("terms"))
    order = Window.partitionBy("lang").orderBy("total", "source")
    return found.withColumn("zero", share("0")).withColumn("no", F.row_number().over(order))


def cells_of(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, term, source, n, no, p, z): a row per nonzero count."""
    cells = rows.select("lang", "term", F.explode("cells").alias("c")).select("lang", "term", "c.source", "c.n")
    return cells.join(groups, ["lang", "source"]).select("lang", "term", "source", "n", "no", share("n").alias("p"), F.col("zero").alias("z"))


class Tree:
    """The open branch of a frequent-pattern tree over sorted paths, and the pair sums of what was left of it.

    A node is a cell (no, p, z) below its parent and has the number of terms whose path goes through it.
    """

    def __init__(self, depth: int = 64):
        self.no, self.p, self.z, self.terms = (np.zeros(depth, np.int64) for _ in range(4))
        self.path: list[tuple[int, int, int]] = []
        self.sums: dict[int, np.ndarray] = {}
        self.held = 0

    def add(self, path: list[tuple[int, int, int]], terms: int) -> None:
        same = 0
        while same < min(len(path), len(self.path)) and path[same] == self.path[same]:
            same += 1
        self.leave(same)
        if len(path) > len(self.no):
            self.no, self.p, self.z, self.terms = (np.resize(a, 2 * len(path)) for a in (self.no, self.p, self.z, self.terms))
        for at in range(same, len(path)):
            self.no[at], self.p[at], self.z[at] = path[at]
            self.terms[at] = 0
        self.path = path
        if path:
            self.terms[len(path) - 1] += terms

    def leave(self, depth: int) -> None:
        """Close the nodes below ``depth``: each meets its ancestors once and hands its terms to its parent."""
        for at in range(len(self.path) - 1, depth - 1, -1):
            if at:
                no, p, z = self.path[at]
                over, zero = self.p[:at], self.z[:at]
                change = np.abs(over - p) - np.abs(over - z) - np.abs(zero - p) + np.abs(zero - z)
                sums = self.sums.get(no)
                if sums is None:
                    sums = self.sums[no] = np.zeros(no, np.int64)
                    self.held += no
                sums[self.no[:at]] += change * self.terms[at]  # ancestors have smaller numbers, each once
                self.terms[at - 1] += self.terms[at]
        self.path = self.path[:depth]


def _correct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, a, b, change) from the sorted paths of a task."""
    lang, tree = None, Tree()

    def out() -> Iterator[pa.RecordBatch]:
        for b, sums in tree.sums.items():
            a = np.flatnonzero(sums)
            if len(a):
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang] * len(a), pa.string()), "a": pa.array(a.astype(np.int32)),
                    "b": pa.array(np.full(len(a), b, np.int32)), "change": pa.array(sums[a])})
        tree.sums, tree.held = {}, 0

    for batch in batches:
        for at in range(0, batch.num_rows, 256):  # a path has up to one cell per source
            for row in batch.slice(at, 256).to_pylist():
                if row["lang"] != lang:
                    tree.leave(0)
                    yield from out()
                    lang, tree = row["lang"], Tree()
                tree.add([(c["no"], c["p"], c["z"]) for c in row["path"]], row["terms"])
                if tree.held > 1 << 22:
                    yield from out()
    tree.leave(0)
    yield from out()


def pair_corrections(cells: DataFrame) -> DataFrame:
    """(lang, a, b, change), a < b by number: the sum of the pair corrections of two sources of a language."""
    paths = cells.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("no", "p", "z"))).alias("path"))
    paths = paths.where(F.size("path") > 1).groupBy("lang", "path").agg(F.count(F.lit(1)).alias("terms"))
    dealt = paths.repartitionByRange("lang", "path").sortWithinPartitions("lang", "path")
    found = dealt.mapInArrow(_correct, "lang string, a int, b int, change long")
    return found.groupBy("lang", "a", "b").agg(F.sum("change").alias("change"))


def one_sided(cells: DataFrame, pairs: DataFrame) -> DataFrame:
    """(lang, a, b, change): what the counts of source ``a`` change where ``b`` is taken to have none.

    For a point z' it is the sum of |p - z'| over the terms of ``a``, less that of |z - z'|: running sums over the
    values of ``a`` give it for all points at once.
    """
    values = cells.groupBy("lang", F.col("no").alias("a"), F.col("p").alias("x")).agg(F.count(F.lit(1)).alias("m"))
    values = values.withColumn("mx", F.col("m") * F.col("x"))
    points = pairs.select("lang", "a", F.col("zb").alias("x"), "b", "za")
    both = values.unionByName(points, allowMissingColumns=True)
    source = Window.partitionBy("lang", "a")
    below = source.orderBy("x").rangeBetween(Window.unboundedPreceding, -1)
    m, mx = (F.coalesce(F.sum(c).over(source), F.lit(0)) for c in ("m", "mx"))
    m_low, mx_low = (F.coalesce(F.sum(c).over(below), F.lit(0)) for c in ("m", "mx"))
    change = mx - 2 * mx_low + F.col("x") * (2 * m_low - m) - m * F.abs(F.col("za") - F.col("x"))
    return both.select("lang", "a", "b", change.alias("change")).where(F.col("b").isNotNull())


def divergence(
    docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least_docs: int = 30, best: int = 50,
) -> DataFrame:
    """(lang, source, part, item, value, rank): how sources differ from each other and from their language.

    Words are runs of letters A-Z, lower-cased, and characters beyond ASCII; a language keeps the terms that at least
    ``least_docs`` of its documents contain. Part ``pair``: ``value`` is the exact L1 distance of the source's
    smoothed word distribution (in 10**-9) to that of source ``item``, for every other source of the language. Part ``term``:
    terms that the source has and uses more than the language, and by how much, the ``best`` ones.
    ``rank`` counts from 1 per source and part, by value descending, then item in UTF-8 order.

    Null text, language and source count as ''. Repeated rows count as documents of their own. A source without kept
    terms takes part with zero counts; the distance is 0 in a language without kept terms. A language with one
    source has no pair rows. An empty table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for n, c in (("lang", lang), ("source", source), ("text", text))])
    rows = stored(spark, term_rows(docs, least_docs), "divergence-rows")
    groups = stored(spark, groups_of(docs, rows), "divergence-groups")
    cells = stored(spark, cells_of(rows, groups), "divergence-cells")

    one = groups.select("lang", F.col("no").alias("a"), F.col("source"), F.col("zero").alias("za"), "terms")
    other = groups.select("lang", F.col("no").alias("b"), F.col("source").alias("item"), F.col("zero").alias("zb"))
    pairs = one.join(other, "lang").where("a <> b")
    changes = one_sided(cells, pairs.where("terms > 0")).unionByName(pair_corrections(cells))
    changes = changes.groupBy("lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("change").alias("change"))
    changes = changes.unionByName(changes.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "change"))
    value = F.coalesce(F.col("terms") * F.abs(F.col("za") - F.col("zb")), F.lit(0)) + F.coalesce("change", F.lit(0))
    apart = pairs.join(changes, ["lang", "a", "b"], "left").select("lang", "source", "item", value.alias("value"))

    of_lang = cells.groupBy("lang", "term").agg(F.sum("n").alias("n")).join(
        groups.groupBy("lang").agg(F.sum("total").alias("total"), F.max("terms").alias("terms")), "lang")
    usual = of_lang.select("lang", "term", share("n").alias("q"))
    more = cells.join(usual, ["lang", "term"]).where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = more.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best).withColumn("part", F.lit("term"))
    result = apart.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair")).unionByName(ranked)
    return result.select("lang", "source", "part", "item", "value", "rank")
