"""Components of large candidate groups against all pairs."""

import random

import numpy as np
import pytest

from strata.llm import crossings as module
from strata.llm.crossings import crossings, links_between
from strata.llm.simhash import keep_one
from test_simhash import roots_of


def families(rnd, n, shared):
    """Sets that share ``shared`` values, in families that drift apart one value at a time."""
    common, sets = list(range(shared)), []
    while len(sets) < n:
        own = [rnd.randrange(10**6, 10**9) for _ in range(rnd.choice([3, 10, 40]))]
        for _ in range(rnd.choice([1, 2, 12])):
            sets.append(np.unique(np.array(common + own, np.uint64)))
            own[rnd.randrange(len(own))] = rnd.randrange(10**6, 10**9)
    return sets[:n]


def alike(x, y):
    both = len(set(x.tolist()) & set(y.tolist()))
    return both >= 0.8 * (len(x) + len(y) - both)


def all_links(sets):
    return [(a, b) for a in range(len(sets)) for b in range(a) if alike(sets[a], sets[b])]


@pytest.mark.parametrize("seed", range(6))
def test_links_between_connects_what_all_pairs_do(seed):
    rnd = random.Random(seed)
    sets = families(rnd, 70, rnd.choice([0, 5, 30]))
    near = all_links(sets)
    known = [p for p in near if rnd.random() < 0.2]
    root = roots_of(range(len(sets)), known)
    label = np.array([root[k] for k in range(len(sets))])
    found = links_between(sets, label, np.zeros(len(sets), np.int64), 0.8)
    assert roots_of(range(len(sets)), known + found) == roots_of(range(len(sets)), near)
    side = np.array([rnd.randrange(2) for _ in sets])
    found = links_between(sets, label, side, 0.8)
    across = [(a, b) for a, b in near if side[a] != side[b]]
    assert roots_of(range(len(sets)), known + found) == roots_of(range(len(sets)), known + across)


@pytest.mark.parametrize("texts", [1_000, 7])
def test_blocks_lose_no_link(spark, monkeypatch, texts):
    monkeypatch.setattr(module, "BLOCK_TEXTS", texts)
    rnd = random.Random(texts)
    sets = families(rnd, 120, 8)
    near = all_links(sets)
    known = near[::3]
    root = roots_of(range(len(sets)), known)
    rows = [(g, k, len(sets[k]), root[k]) for g in (1, 2) for k in range(len(sets)) if g == 1 or k % 2]
    rows += [(3, k, len(sets[k]), 0) for k in range(4)]  # one component: nothing to do
    found = crossings(spark.createDataFrame(rows, "g long, w long, n long, root long"),
                      spark.createDataFrame([(k, s.tobytes()) for k, s in enumerate(sets)], "w long, set binary"), 0.8)
    got = [(r.a, r.b) for r in found.collect()]
    assert roots_of(range(len(sets)), known + got) == roots_of(range(len(sets)), near)
    empty = spark.createDataFrame([], "g long, w long, n long, root long")
    assert crossings(empty, spark.createDataFrame([], "w long, set binary"), 0.8).count() == 0


def test_large_group_with_a_shared_passage(spark):
    """Many texts share candidates without being alike; the alike ones among them are still found."""
    rnd = random.Random(2)
    passage = [f"p{i}" for i in range(60)]
    texts, near = [], []
    for _ in range(60):
        own = [f"w{rnd.randrange(10**6)}" for _ in range(40)]
        texts.append(" ".join(passage + own))
        for _ in range(3):
            changed = list(own)
            changed[rnd.randrange(40)] = "changed"
            texts.append(" ".join(passage + changed))
            near.append((len(texts) - 1, len(texts) - 1 - len(near) % 3 - 1))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in keep_one(docs).collect()) == sorted(set(roots_of(range(len(texts)), near).values()))
