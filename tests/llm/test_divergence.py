"""Distances of sources against sums over all kept terms, one by one."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from strata.llm.divergence import Tree, divergence, words

WORD = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain(rows, least_docs, best):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    groups = set()
    for text, lang, source in rows:
        found = WORD.findall(lowered(text or ""))
        groups.add((lang or "", source or ""))
        counts[lang or "", source or ""].update(found)
        docs[lang or ""].update(set(found))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least_docs]

        def smoothed(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        own = {s: smoothed(counts[lang, s]) for g, s in groups if g == lang}
        usual = smoothed(sum((counts[lang, s] for s in own), Counter()))
        for s in own:
            pairs = [(sum(abs(own[s][t] - own[o][t]) for t in kept), o) for o in own if o != s]
            more = [(own[s][t] - usual[t], t) for t in kept if counts[lang, s][t] and own[s][t] > usual[t]]
            for part, found in (("pair", pairs), ("term", more)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(found) if part == "pair" or k < best]
    return sorted(out)


def documents(seed):
    rnd = random.Random(seed)
    common = ["the", "The", "é", "été", "日本語", "of", "AND", "x1y", "Ünder"]
    rows = []
    for _ in range(400):
        lang = rnd.choice(["en", "en", "fr", None, ""])
        source = rnd.choice(["a", "b", "c", "d", "é", None, "hot", "hot", "hot"])
        text = " ".join(rnd.choices(common + [f"w{chr(97 + rnd.randint(0, 25))}" for _ in range(6)], k=rnd.randint(0, 30)))
        rows.append((rnd.choice([text, text, text, None, ""]) if rnd.random() < 0.3 else text, lang, source))
    rows += [("rare words only", "de", "a"), (None, "de", "b"), ("alone " * 5, "it", "a")]
    return rows + rows[:20]


@pytest.mark.parametrize("seed,least_docs,best", [(1, 30, 50), (2, 5, 3), (3, 1, 50)])
def test_all_values_and_ranks(spark, seed, least_docs, best):
    rows = documents(seed)
    docs = spark.createDataFrame([(*r, 1, "t") for r in rows], "text string, lang string, source string, rank int, term string").repartition(5)
    got = sorted(map(tuple, divergence(docs, least_docs=least_docs, best=best).collect()))
    assert got == plain(rows, least_docs, best)


def test_sources_of_one_language_with_a_third_of_all_rows(spark):
    rows = [("one two three " * (k % 4 + 1), "en", "hot" if k % 3 == 0 else f"s{k % 40}") for k in range(600)]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    assert sorted(map(tuple, divergence(docs).collect())) == plain(rows, 30, 50)


def test_tree_counts_each_node_with_its_ancestors():
    rnd = random.Random(5)
    zero = {k: rnd.randint(1, 9) for k in range(1, 9)}
    paths = sorted(tuple((k, zero[k] + rnd.randint(1, 3), zero[k]) for k in range(1, 9) if rnd.random() < 0.6) for _ in range(300))
    tree, wanted = Tree(depth=2), Counter()
    for path in paths:
        tree.add(list(path), 2)
        for j, (b, p, z) in enumerate(path):
            for a, q, y in path[:j]:
                wanted[a, b] += 2 * (abs(q - p) - abs(q - z) - abs(y - p) + abs(y - z))
    tree.leave(0)
    got = {(int(a), b): int(s[a]) for b, s in tree.sums.items() for a in np.flatnonzero(s)}
    assert got == {k: v for k, v in wanted.items() if v}


def test_words():
    text = "Ab-cD é1É\x7f_日本X"
    assert [w.decode() for w in words(text.encode())] == WORD.findall(lowered(text))


def test_nothing(spark):
    assert divergence(spark.createDataFrame([], "doc_id long, text string, lang string, source string")).count() == 0
