"""Top-k against all inner products, lattice links against all cosines."""

import numpy as np
import pytest

from oracle_check import compare, duck
from strata.llm.lattice import ROOTS, lattice_links, nearest
from strata.llm.queries import ORACLE, QUERIES
from strata.llm.topk import maxscore

SCHEMA = "vec_id long, embedding array<double>, label int, score long, row int, cell long"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, g, 1, 2, 3) for i, v, g in rows], SCHEMA)


def best(rows, queries, k):
    out = []
    fine = [(i, [int(np.floor(256 * x)) for x in v]) for i, v, _ in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    for q, qv in sorted({(i, tuple(v)) for i, v in fine if i in queries}):
        scores = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in fine if i != q and len(v) == len(qv))[:k]
        out += [(q, n + 1, i, max(-2**63, min(2**63 - 1, -s))) for n, (s, i) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("dims,shard,block", [(1, 7, 3), (16, 10, 4), (64, 1000, 1000)])
def test_topk(spark, dims, shard, block):
    rng = np.random.default_rng(dims)
    rows = [(i, rng.normal(size=dims).round(2).tolist(), 0) for i in range(120)]
    rows += [(200 + i, rows[i][1], 0) for i in range(30)]  # ties
    rows += [(300, None, 0), (301, [], 0), (302, [float("nan")] * dims, 0), (303, [None] * dims, 0), (304, [float("inf")] * dims, 0),
             (305, [0.0] * dims, 0), (306, [1.0] * (dims + 1), 0), (307, [2.0] * (dims + 1), 0), (None, [1.0] * dims, 0), (308, [1e12] * dims, 0)]
    df = frame(spark, rows)
    got = maxscore(spark, df, df.where("vec_id % 10 = 0 or vec_id >= 300"), shard=shard, block=block)
    assert sorted(map(tuple, got.collect())) == best(rows, {i for i in range(0, 400) if i % 10 == 0 or i >= 300}, 5)


def test_topk_of_repeated_keys_and_nothing(spark):
    df = frame(spark, [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [0.5, 0.5], 0)])
    assert sorted(map(tuple, maxscore(spark, df, df).collect())) == [(1, 1, 2, 128 * 256), (2, 1, 1, 128 * 256), (2, 2, 1, 128 * 256)]
    assert maxscore(spark, df.limit(0), df.limit(0)).count() == 0


def test_topk_query_against_sql(spark, sf):
    ok, note = compare(QUERIES["op2_maxscore"](spark, sf), duck(sf), ORACLE["op2_maxscore"])
    assert ok, note


def test_nearest_lattice_point():
    assert len(ROOTS) == 240 and np.allclose((ROOTS ** 2).sum(axis=1), 2)
    x = np.random.default_rng(0).normal(size=(300, 8)) * 3
    point = nearest(x) / 2
    off = x - point
    assert ((off ** 2).sum(axis=1) <= 1 + 1e-9).all()  # the covering radius
    assert (off @ ROOTS.T <= 1 + 1e-9).all()  # inside the cell: no neighbour is nearer
    assert (np.isclose(point % 1, 0).all(axis=1) | np.isclose(point % 1, 0.5).all(axis=1)).all() and (point.sum(axis=1) % 2 == 0).all()


def plain_links(rows, least):
    fine = [(i, np.array(v, float), g) for i, v, g in rows
            if i is not None and g is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    return {(a[0], b[0]) for n, a in enumerate(fine) for b in fine[:n]
            if a[2] == b[2] and len(a[1]) == len(b[1]) and a[1] @ b[1] / np.sqrt((a[1] @ a[1]) * (b[1] @ b[1])) >= least}


@pytest.mark.parametrize("chunk", [2000, 7])
def test_links(spark, chunk):
    rng = np.random.default_rng(2)
    rows = []
    for g in range(25):
        base = rng.normal(size=32)
        for _ in range(int(rng.integers(1, 9))):
            rows.append((len(rows), (base + rng.normal(size=32) * 0.1).tolist(), int(rng.integers(0, 2))))
    dense = rng.normal(size=32)
    rows += [(1000 + i, (dense + rng.normal(size=32) * 0.05).tolist(), 1) for i in range(60)]
    rows += [(2000, None, 1), (2001, [0.0] * 32, 1), (2002, [None] * 32, 1), (2003, [float("nan")] * 32, 1), (2004, rows[0][1], None),
             (2005, rows[0][1][:5], 1), (2006, [1e-300] * 32, 1), (2007, [1e300] * 32, 1), (2008, [], 1)]
    want = plain_links([r for r in rows if r[0] not in (2006, 2007)], 0.93) | {(2007, 2006)}
    got = {r.vec_id: r for r in lattice_links(spark, frame(spark, rows + [(None, rows[0][1], 1)]), chunk=chunk).collect()}
    assert len(got) == len(rows) + 1 and (got[None].component_id, got[None].kept, got[None].n_links) == (None, False, 0)
    n = {i: sum(i in p for p in want) for i, _, _ in rows}
    assert all(got[i].n_links <= n[i] for i in n)
    assert sum(got[i].n_links for i in n) >= 0.97 * sum(n.values())
    root = {i: i for i in n}
    for _ in range(20):
        for a, b in want:
            root[a] = root[b] = min(root[a], root[b])
    assert sum(got[i].component_id == root[i] for i in n) >= 0.97 * len(n)
    assert all(got[i].kept == (got[i].component_id == i) for i in n)
    assert lattice_links(spark, frame(spark, rows[:1]).limit(0)).count() == 0


def test_links_of_repeated_keys(spark):
    got = lattice_links(spark, frame(spark, [(1, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (2, [2.0, 4.0], 0)])).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(1, 2, 1), (1, 2, 1), (2, 2, 1)]


def test_recall_on_the_given_table(spark, sf):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = plain_links(rows, 0.93)
    found = sum(r.n_links for r in QUERIES["op6_lattice"](spark, sf).collect())
    assert found <= 2 * len(want) and found >= 0.9 * 2 * len(want)


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(300):
        a, b = rng.normal(size=(2, 64))
        b -= (a @ b) / (a @ a) * a
        a, b = a / np.linalg.norm(a), b / np.linalg.norm(b)
        rows += [(2 * i, a.tolist(), 0), (2 * i + 1, (0.9301 * a + np.sqrt(1 - 0.9301**2) * b).tolist(), 0)]
    found = sum(r.n_links for r in lattice_links(spark, frame(spark, rows)).collect())
    assert found >= 0.9 * 2 * 300
