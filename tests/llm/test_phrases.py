"""Removed words against every window of every pair of documents."""

import hashlib
import random
import re

import numpy as np
import pytest

from strata.llm.phrases import Plan, Shard, Slice, rolled, without_repeated_phrases

WORD = re.compile("[^\x20\x09-\x0D]+")


def plain(rows, length):
    first = {}
    for key, text in rows:
        w = WORD.findall(text or "")
        for p in range(len(w) - length + 1 if key is not None else 0):
            s = tuple(w[p:p + length])
            first[s] = min(first.get(s, key), key)
    out = []
    for key, text in rows:
        w, seen, gone = WORD.findall(text or ""), set(), set()
        for p in range(len(w) - length + 1):
            s = tuple(w[p:p + length])
            if s in seen or key is not None and first[s] < key:
                gone |= set(range(p, p + length))
            seen.add(s)
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((key, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def texts(seed):
    rnd = random.Random(seed)
    words = ["".join(rnd.choices("abcdeéß日\x00\x1f\x85\xa0 ", k=rnd.randint(1, 6))) for _ in range(200)]
    passages = [" ".join(rnd.choices(words, k=rnd.randint(6, 90))) for _ in range(15)]
    out = [None, "", " \n\t", "a", "a " * 19, "a " * 20, "a " * 21, "a b " * 60, "b a\n" * 30, "x\x0by\x0c" * 40]
    for _ in range(150):
        parts = [" ".join(rnd.choices(words, k=rnd.randint(0, 60)))]
        for _ in range(rnd.randint(0, 4)):
            p = rnd.choice(passages).split(" ")
            a = rnd.randint(0, len(p) // 3)
            parts += [*p[a:rnd.randint(a, len(p))], *rnd.choices(words, k=rnd.randint(0, 12))]
        out.append(rnd.choice([" ", "\n", "  \t"]).join(parts))
    line = "the line that nearly every text of this table starts with word for word and that is long enough to make a window of its own as it has many words\n"
    return [line + t if t and rnd.random() < 0.7 else t for t in out] + rnd.choices(out, k=15)


@pytest.mark.parametrize("length,q,hot,shard_words,parts", [
    (20, 8, 1000, 100_000, 3), (20, 8, 20, 50, 3), (20, 8, 1, 1, 1), (20, 19, 5, 300, 7), (3, 1, 10, 100, 4), (62, 1, 30, 1000, 2)])
def test_every_removed_word(spark, length, q, hot, shard_words, parts):
    found = texts(length + hot)
    order = list(range(len(found)))
    random.Random(1).shuffle(order)
    rows = [*zip(order, found), (None, found[20]), (None, "a b " * 60), (3, found[30]), (3, found[31]), (3, found[31]), (-(2**63), found[40])]
    docs = spark.createDataFrame([(i, t, "c", 5, 1) for i, t in rows], "doc_id long, text string, kept string, n_words int, k int").repartition(parts)
    got = without_repeated_phrases(docs, length=length, q=q, hot=hot, shard_words=shard_words, digest=True)
    assert got.columns == ["doc_id", "k", "n_words", "n_removed", "kept"]
    assert sorted(map(tuple, got.drop("k").collect()), key=repr) == plain(rows, length)


def test_a_passage_in_a_third_of_all_rows(spark):
    rnd = random.Random(9)
    passage = " ".join(f"p{k}" for k in range(40))
    rows = [(k, " ".join(f"w{rnd.randint(0, 999)}" for _ in range(30)) + (f" {passage} " if k % 3 == 0 else " ") + f"end{k}") for k in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    for hot in (1000, 50):
        got = without_repeated_phrases(docs, hot=hot, digest=True)
        assert sorted(map(tuple, got.collect()), key=repr) == plain(rows, 20)


def test_text_and_other_columns(spark):
    passage = " ".join(f"p{k}" for k in range(25))
    docs = spark.createDataFrame([(1, f"one\n {passage}", "x"), (2, f"two {passage}  é three", "y"), (3, None, None)], "doc_id long, text string, found string")
    got = {r.doc_id: r for r in without_repeated_phrases(docs).collect()}
    assert got[1].kept == f"one {passage}" and got[2].kept == "two é three" and got[2].n_removed == 25 and got[2].found == "y" and got[3].kept == ""


def test_a_text_of_a_million_words(spark):
    rnd = random.Random(3)
    long = " ".join(str(rnd.randint(0, 10**6)) for _ in range(1_000_000))
    cut = " ".join(long.split()[500_000:500_050])
    docs = spark.createDataFrame([(2, long), (1, cut)], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in without_repeated_phrases(docs, digest=True).collect()}
    assert got == {1: 0, 2: 50}


def test_nothing(spark):
    assert without_repeated_phrases(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_equal_sequences_have_equal_hashes():
    rng = np.random.default_rng(1)
    codes = np.concatenate([np.arange(100), np.arange(50, 100)]).astype(np.uint64)
    for length in (1, 2, 7, 20, 33):
        h = rolled(codes, length, np.uint64(0x9E3779B97F4A7C15))
        assert len(h) == len(codes) - length + 1 and (h[50:101 - length] == h[100:151 - length]).all()
        assert len(np.unique(h[:101 - length])) == 101 - length
    assert len(rolled(rng.integers(0, 9, 3).astype(np.uint64), 4, np.uint64(3))) == 0


def test_slices_and_shards():
    plan = Plan(3, 2, 10, 10)
    own = Slice([b"a b  c\td", b"", b" x ", b"a b c"], plan)
    assert own.n_words.tolist() == [4, 0, 1, 3] and own.windows.tolist() == [0, 1, 5] and own.passage(0, 1) == b"a b c d"
    assert own.h1[0] == own.h1[5] and own.h1[1] != own.h1[0]
    shard = Shard(plan)
    for row in [(5, 1, 0, b"a b c d"), (4, 1, 7, b"b c d"), (6, 2, 0, b"a b c"), (6, 3, 0, b"b c d x")]:
        shard.add(*row)
    assert sorted(shard.confirmed()) == [(0, 1, 2), (1, 2, 3)]
    assert sorted(tuple(r.values()) for r in shard.answers().to_pylist()) == [(5, 1, 0, 2), (6, 2, 0, 1), (6, 3, 0, 1)]
