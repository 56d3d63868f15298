"""Language spans against an exhaustive best path, and held-out accuracy of language and quality."""

import itertools
import zlib
from collections import Counter

import numpy as np
import pytest

from strata.llm.languages import Words, best_path, first_by_hash, identify, labelled_language, language_spans, learn, spans
from strata.llm import quality
from strata.llm.quality import classify
from strata.llm.quality import learn as learn_quality
from strata.llm.quality import scored, terms, vote

SAMPLES = {
    "en": "the cat and the dog were in the house with their old friend while it rained",
    "de": "der hund und die katze waren nicht im haus sondern auf der straße über nacht",
    "ru": "кошка и собака были в доме вместе со своим старым другом пока шёл дождь",
}


@pytest.fixture(scope="module")
def model(spark):
    rows = [(t, lang) for lang, t in SAMPLES.items()] + [(None, "en"), ("no language", None)]
    return learn(spark.createDataFrame(rows, "text string, lang string"))


def test_best_path_is_the_best(rng=np.random.default_rng(0)):
    for _ in range(60):
        scores, penalty = rng.normal(size=(6, 3)) * rng.choice([0.2, 1, 3]), float(rng.choice([0.1, 1, 4]))

        def value(path):
            return sum(scores[t, s] for t, s in enumerate(path)) - penalty * sum(a != b for a, b in zip(path, path[1:]))

        most = max(value(p) for p in itertools.product(range(3), repeat=6))
        assert abs(value(best_path(scores, penalty).tolist()) - most) < 1e-9


def test_mixed_text_is_labelled_in_spans(model):
    text = SAMPLES["en"] + ". " + SAMPLES["ru"] + "! " + SAMPLES["de"]
    found = spans(text, Words(model), 6.0)
    assert [f[0] for f in found] == ["en", "ru", "de"]
    assert text[found[1][1]:found[1][2]] == SAMPLES["ru"]


def test_script_narrows_the_candidates(model):
    words = Words(model)
    number = words.lookup([["абв", "abc"]])[0]
    ru = model.languages.index("ru")
    assert words.scores[number[0], ru] == 0 and words.scores[number[1], ru] == -30


def test_language_rows(spark, model):
    rows = [(1, None, "x", 1.0), (2, "", "x", 1.0), (3, "123 !?", "x", 1.0), (4, SAMPLES["de"], "x", 1.0), (4, SAMPLES["de"], "x", 1.0),
            (None, "the house " * 30_000, "x", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string, score double")
    got = [(r.doc_id, r.lang_pred, r.score) for r in labelled_language(docs, model).collect()]
    assert sorted(got, key=repr) == sorted([(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0), (4, "de", 1.0), (4, "de", 1.0), (None, "en", 1.0)], key=repr)
    assert language_spans(docs, model).count() == len(rows) and labelled_language(docs.limit(0), model).count() == 0
    nothing = learn(spark.createDataFrame([], "text string, lang string"))
    assert {r.lang_pred for r in labelled_language(docs, nothing).collect()} == {"und"}


def fold(key, folds):
    return zlib.crc32(str(key).encode()) % folds


def test_language_held_out(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    true = {r.doc_id: r.lang for r in docs.collect()}
    got = identify(docs).collect()
    assert len(got) == len(true) and all(r.held_out == (fold(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in got)
    held = [r.lang_pred == true[r.doc_id] for r in got if r.held_out]
    assert np.mean(held) >= 0.95


def test_quality_held_out(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    true = {r.doc_id: r.quality for r in labels.collect()}
    got = classify(docs, labels).collect()
    assert len(got) == docs.count()
    assert all(r.held_out == (fold(r.doc_id, 3) == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [(true[r.doc_id], r.score) for r in got if r.held_out and r.doc_id in true]
    good, bad = np.array([s for y, s in held if y]), np.array([s for y, s in held if not y])
    assert (good[:, None] > bad).mean() >= 0.95 and np.mean([(s >= 0.5) == y for y, s in held]) >= 0.93


def test_votes_are_exact_nearest_neighbours(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    space = learn_quality(docs, labels)
    counts = np.stack([terms(t.encode(), 4096) for t in ["Some words and more words", "a | b | c", ""]])
    x = np.log1p(counts) * space.idf
    x = (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)) @ space.basis
    for v, got in zip(x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9), vote(space, counts)):
        near = sorted(zip(space.vectors @ v, space.labels), key=lambda p: -p[0])[:25]
        weight = [max(c, 0) ** 8 for c, _ in near]
        want = (sum(w * y for w, (_, y) in zip(weight, near)) + 0.01 * space.prior) / (sum(weight) + 0.01)
        assert abs(got - want) < 1e-3


def test_quality_rows(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    space = learn_quality(docs, labels)
    rows = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "z" * 3_000_000, 5), (None, "one two", 5), (4, "one two", 5), (4, "one two", 5)],
                                 "doc_id long, text string, predicted int")
    got = scored(rows, space).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert {round(r.score, 9) for r in got if r.doc_id in (1, 2)} == {round(space.prior, 9)}
    assert scored(rows.limit(0), space).count() == 0
    nothing = learn_quality(docs.limit(0), labels)
    assert {r.score for r in scored(rows, nothing).collect()} == {0.5}


@pytest.mark.parametrize("most", [1, 3, 40, 1000])
def test_sample_by_hash_is_the_plain_one(spark, most):
    """One text holds a third of the rows; some languages have fewer rows than wanted; nulls are left out."""
    rows = [(f"text {i % 90}", "abc"[i % 3]) for i in range(300)] + [("copy", "a")] * 160 + [("rare", "d"), (None, "a"), ("x", None), ("", "b")]
    table = spark.createDataFrame(rows, "text string, lang string")
    hashed = [(r.lang, r.h, r.text) for r in table.where("text is not null and lang is not null").selectExpr("lang", "xxhash64(text) h", "text").collect()]
    want = Counter()
    for lang in {r[0] for r in hashed}:
        want.update((text, lang) for _, _, text in sorted(r for r in hashed if r[0] == lang)[:most])
    got = {(r.text, r.lang): r.n for r in first_by_hash(table, most).collect()}
    assert got == dict(want)
    assert first_by_hash(table.limit(0), most).count() == 0


@pytest.mark.parametrize("chunk", [5, 7, 64, 1000])
def test_a_text_is_counted_alike_in_any_chunks(monkeypatch, chunk):
    texts = [t.encode() for t in ["", "a", "abcd", " ".join(SAMPLES.values()) + " 12,345 " * 20 + "AAA  ..." * 9]]
    want = [terms(t, 4096) for t in texts]
    monkeypatch.setattr(quality, "CHUNK", chunk)
    assert all((terms(t, 4096) == w).all() for t, w in zip(texts, want))
