"""Fingerprints bit by bit, components against all pairs, near copies against exact similarities."""

import random
import re

import numpy as np
import pytest
import xxhash

from strata.llm.common import components
from strata.llm.simhash import _sketches, embedding, fingerprint, keep_one, near_links, simhash_components


def slow_fingerprint(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots_of(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "one TWO", "a b c", "A b C a B c a b c", "É é x\x1cy Z", "w " * 500])
def test_fingerprint(text):
    assert fingerprint((text or "").encode(), 3) == slow_fingerprint(text)


def test_links_connect_what_all_pairs_do(spark):
    rng = np.random.default_rng(1)
    values = set(map(int, rng.integers(-2**63, 2**63, 300)))
    for x in list(values)[:60] + [0, -1]:
        at = x
        for _ in range(int(rng.integers(1, 8))):  # chains of one to three flipped bits
            for b in rng.choice(64, int(rng.integers(1, 4)), replace=False):
                at = (at & (2**64 - 1)) ^ (1 << int(b))
            at = at - 2**64 if at >= 2**63 else at
            values.add(at)
    values = sorted(values)
    near = [(a, b) for i, a in enumerate(values) for b in values[:i] if bin((a ^ b) & (2**64 - 1)).count("1") <= 2]
    links = near_links(spark.createDataFrame([(v,) for v in values], "fp long"))
    got = {(r.a, r.b) for r in links.collect()}
    assert got <= {(min(p), max(p)) for p in near}
    assert roots_of(values, got) == roots_of(values, near)
    found = {r.node: r.root for r in components(spark, links, "test").collect()}
    assert {v: found.get(v, v) for v in values} == roots_of(values, near)


def test_embedding_is_segment_counts(spark):
    values = [0, -1, 1, 2**62, -2**63, 0x0123456789ABCDEF]
    for r in spark.createDataFrame([(v,) for v in values], "fp long").select("fp", embedding(spark_col("fp")).alias("v")).collect():
        for s in range(16):
            assert (r.v >> 4 * s) & 15 == bin(((r.fp & (2**64 - 1)) >> 4 * s) & 15).count("1")


def spark_col(name):
    from pyspark.sql import functions as F

    return F.col(name)


def test_components_of_long_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(300)]
    hub = [(1000, 1001 + i) for i in range(500)]
    found = {r.node: r.root for r in components(spark, spark.createDataFrame(chain + hub + [(5, 5)], "a long, b long"), "chain").collect()}
    assert found == {**{i: 0 for i in range(301)}, **{i: 1000 for i in range(1000, 1501)}}
    assert components(spark, spark.createDataFrame([], "a long, b long"), "none").count() == 0


def test_query_against_all_pairs(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(10**9 + i, t) for i, t in enumerate([None, "", "x", "x"])] + [(None, "x"), (None, "alone and without a key")], "doc_id long, text string")
    docs = docs.union(extra)
    rows = [(r.doc_id, slow_fingerprint(r.text)) for r in docs.collect()]
    fps = sorted({fp for _, fp in rows})
    near = [(a, b) for i, a in enumerate(fps) for b in fps[:i] if bin(a ^ b).count("1") <= 2]
    root, least = roots_of(fps, near), {}
    for i, fp in rows:
        if i is not None:
            least[root[fp]] = min(least.get(root[fp], i), i)
    want = sorted(((i, f"{fp:016x}", least.get(root[fp])) for i, fp in rows), key=repr)
    assert sorted(map(tuple, simhash_components(docs).collect()), key=repr) == want
    assert simhash_components(docs.limit(0)).count() == 0


def test_keep_one_of_each_group(spark):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(5000)]
    texts, same = [], []
    for g in range(40):
        base = rnd.choices(words, k=rnd.choice([30, 120, 400]))
        group = [" ".join(base)]
        for _ in range(rnd.randrange(3)):
            other = list(base)
            other[rnd.randrange(len(base))] = "changed"
            group.append(" ".join(other) if rnd.random() < 0.7 else " ".join(base).upper())
        same.append(range(len(texts), len(texts) + len(group)))
        texts += group
    rows = [(i, t, 1, 2) for i, t in enumerate(texts)] + [(0, texts[0], 1, 2), (None, texts[0], 1, 2), (None, None, 1, 2), (999, "", 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int, words int")

    def shingles(t):
        w = t.lower().split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}

    kept = keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect())
    near = [(a, b) for g in same for a in g for b in g if a < b and
            len(shingles(texts[a]) & shingles(texts[b])) >= 0.8 * len(shingles(texts[a]) | shingles(texts[b]))]
    assert ids == sorted({*roots_of(range(len(texts)), near).values(), 999})
    assert keep_one(docs.limit(0)).count() == 0


@pytest.mark.parametrize("n", [5, 10, 20, 50, 200])
def test_recall_of_candidates_at_the_threshold(n):
    """Pairs of exactly 0.8, the smaller set within the larger: how many meet in a table, by the size of the union."""
    rnd, met = random.Random(n), 0
    for _ in range(600):
        words = [f"w{rnd.randrange(10**9)}" for _ in range(n + 4)]
        (one, size, _), (two, part, _) = (_sketches(" ".join(words[:k + 4]).encode(), 5, 5, 2) for k in (n, n * 4 // 5))
        assert (size, part) == (n, n * 4 // 5)
        met += any(bin(int(a) ^ int(b)).count("1") <= 2 for a, b in zip(one, two))
    assert met >= 0.975 * 600
