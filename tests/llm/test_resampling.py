"""Weights, scores and ranks against plain arithmetic on every feature."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from strata.llm.resampling import GainPlanes, feature_buckets, planes, resample, width, words

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    found = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return found, found + [f"{a} {b}" for a, b in zip(found, found[1:])]


def plain(rows, target, buckets, seed, share, least):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s = Counter(bucket(f) for _, t in rows for f in features(t)[1])
    t = Counter(bucket(f) for text in target for f in features(text)[1])
    up, down = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = [math.floor(1000 * math.log((t[b] + 1) * up / ((s[b] + 1) * down))) for b in range(buckets)]
    out = []
    for key, text in rows:
        found, feats = features(text)
        weight = sum(gain[bucket(f)] for f in feats) // len(feats) if feats else 0
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        out.append([key, len(feats), weight, score, None, len(found) >= least])
    chosen = sorted((r for r in out if r[5]), key=lambda r: (-r[3], -1 if r[0] is None else r[0], r[2], r[1]))
    for k, row in enumerate(chosen[:share.numerator * len(chosen) // share.denominator]):
        row[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


def documents(n, seed):
    rnd = random.Random(seed)
    vocabulary = ["the", "The", "été", "日本", "a1", "x-y", "z_", "42"] + [f"w{k}" for k in range(300)]
    rows = [(k, " ".join(rnd.choices(vocabulary, k=rnd.choice([0, 1, 2, 19, 20, 21, 60])))) for k in range(n)]
    rows += [(n, None), (n + 1, ""), (n + 2, " \n\x7f"), (n + 3, "again and " * 30000), (None, "no key " * 20)]
    rnd.shuffle(rows)
    return rows + [rows[3]] * 3


@pytest.mark.parametrize("buckets,seed,share,least", [(10000, 7, Fraction(25, 100), 20), (64, 3, Fraction(1, 3), 2), (10001, 7, Fraction(1), 1)])
def test_all_rows(spark, buckets, seed, share, least):
    rows, target = documents(300, seed), [" ".join(f"w{k}" for k in range(40)), None, "", "the été été"]
    docs = spark.createDataFrame([(*r, 5, "x") for r in rows], "doc_id long, text string, rank int, __score string").repartition(5)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = resample(spark, docs, goal, buckets=buckets, seed=seed, share=share, least_words=least)
    assert set(got.columns) == {"doc_id", "text", "__score", "n_features", "weight", "score", "rank"}
    got = sorted(map(tuple, got.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)
    assert got == plain(rows, target, buckets, seed, share, least)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    full = spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string")
    assert resample(spark, docs, full).count() == 0
    got = {r.doc_id: r for r in resample(spark, full, docs, share=Fraction(1), least_words=1).collect()}
    assert got[1].n_features == 3 and got[1]["rank"] == 1 and got[2].n_features == 0 and got[2]["rank"] is None


def test_planes_give_the_exact_sum():
    rng = np.random.default_rng(2)
    for buckets in (1, 63, 64, 10000):
        gain = rng.integers(-30000, 30000, buckets)
        gain[:1] = -(2**15)
        counts = rng.integers(0, 70000, (5, buckets))
        assert (GainPlanes(gain).sums(counts) == counts @ gain).all()
    assert width(np.array([0])) == 1 and width(np.array([-1])) == 1 and width(np.array([-8, 7])) == 3 and width(np.array([8])) == 4
    assert planes(np.array([1, 2, 3]), 2).tolist() == [[0xA0], [0x60]]


def test_pairs_have_the_bucket_of_their_text():
    found = words("Ab cd-é 日本9".encode())
    assert feature_buckets(found, 10000).tolist() == [zlib.crc32(f.encode()) % 10000 for f in ["ab", "cd", "é", "日本9", "ab cd", "cd é", "é 日本9"]]
