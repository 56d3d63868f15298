"""Each stage on planted rows, and the whole against plain versions of its stages."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from strata.llm.pretokens import tokenizer
from test_repeats import plain
from test_simhash import roots_of

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def word(rnd, lang):
    parts = {"en": ["th", "ing", "er", "an", "ou", "wh"], "de": ["sch", "ung", "ein", "ß", "ü", "keit"]}[lang]
    return "".join(rnd.choices(parts, k=rnd.randint(1, 5)))


@pytest.fixture(scope="module")
def docs(spark):
    rnd, rows = random.Random(3), []

    def add(text, lang):
        rows.append((len(rows), text, lang, "s", len(text or "")))

    passage = " ".join(word(rnd, "en") for _ in range(40))
    for lang in ("en", "de"):
        for _ in range(40):
            base = [word(rnd, lang) for _ in range(rnd.randint(5, 200))]
            add(" ".join(base), lang)
            if rnd.random() < 0.4:
                base[rnd.randrange(len(base))] = "changed"
                add(" ".join(base), lang)
            if rnd.random() < 0.3:
                add(" ".join(word(rnd, lang) for _ in range(30)) + passage + " " + word(rnd, lang), lang)
    add('password = "hunter2hunter2" and then ' + " ".join(word(rnd, "en") for _ in range(20)), "en")
    for text in (None, "", "123 456", rows[0][1], " ".join(word(rnd, "en") for _ in range(40_000))):
        add(text, "en")
    rows.append((None, "no key but a text of its own", None, None, None))
    rows.append(rows[3])
    clashing = {c: F.lit(1) for c in ("score", "lang_pred", "kept", "n_removed", "n_bytes", "fp", "words", "id", "spans", "batch")}
    return spark.createDataFrame(rows, SCHEMA).withColumns(clashing)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def shingles(text):
    w = text.lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}


def test_stages(spark, docs):
    columns, before = docs.columns, docs
    after = pipeline.language_id(spark, docs, "")
    assert after.columns == columns
    assert rows_of(after) == rows_of(docs.where("text rlike '[a-z]'"))

    before, after = after, pipeline.near_duplicates(spark, after, "")
    texts = {r.doc_id: r.text for r in before.collect() if r.doc_id is not None}
    sets = {i: shingles(t) for i, t in texts.items()}
    near = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    kept = sorted(r.doc_id for r in after.collect() if r.doc_id is not None)
    assert after.columns == columns and kept == sorted(set(roots_of(texts, near).values())) and after.where("doc_id is null").count() == 1

    before, after = after, pipeline.repeated_passages(spark, after, "")
    want = {r[0]: r for r in plain([(r.doc_id, r.text) for r in before.collect()], 50)}
    got = {r.doc_id: r for r in after.collect()}
    old = {r.doc_id: r.text for r in before.collect()}
    assert after.columns == columns and sum(w[2] > 0 for w in want.values()) >= 5
    for key, (_, n, gone, _, _) in want.items():
        assert (key in got) or gone
        if key in got:
            assert got[key].n_chars == len(got[key].text) and n - gone <= len(got[key].text.encode()) <= n - gone + 6
            assert gone or got[key].text == old[key]

    before, after = after, pipeline.secrets(spark, after, "")
    assert after.columns == columns and after.count() == before.count()
    assert after.where("text like '%hunter2hunter2%'").count() == 0 and after.where("text like 'password = \"[SECRET]\"%'").count() == 1

    packed = pipeline.pack(spark, after, "").collect()
    encode = tokenizer("byte_bpe_50k.json").encode
    assert sum(r.length for r in packed) == sum(len(encode(r.text, add_special_tokens=False).ids) + 1 for r in after.collect())


def test_language_id_without_labels(spark, docs):
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    after = pipeline.language_id(spark, unlabelled, "")
    assert after.columns == docs.columns and rows_of(after) == rows_of(unlabelled.where("text rlike '[a-z]'"))
    assert after.count() > 80


def test_null_and_empty_texts_stay_in_the_later_stages(spark):
    rows = [(1, None, "en", "s", 7), (2, "", "en", "s", 0), (3, None, None, None, None), (3, None, None, None, None), (None, None, "en", "s", 5)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for stage in (pipeline.repeated_passages, pipeline.secrets):
        assert rows_of(stage(spark, docs, "")) == sorted(rows, key=repr)


def test_every_stage_takes_nothing(spark, docs):
    for _, stage in pipeline.STAGES:  # clashing names of other columns are in docs, too
        assert stage(spark, docs.limit(0), "").count() == 0


def test_run(spark, sf):
    got = pipeline.run(spark, sf).collect()
    assert pipeline.ORACLE_SQL is None and 4 <= len(pipeline.STAGES) <= 5
    per = {}
    for r in got:
        per.setdefault(r.doc_id, []).append(r)
    assert all(sum(r.length for r in own) == own[0].doc_tokens for own in per.values())
