"""Removed bytes against every window of every pair of documents."""

import hashlib
import random

import pytest

from strata.llm.repeats import without_repeats


def plain(rows, length):
    first = {}
    for i, t in rows:
        data = (t or "").encode()
        if i is not None:
            for p in range(len(data) - length + 1):
                w = data[p:p + length]
                first[w] = min(first.get(w, i), i)
    out = []
    for i, t in rows:
        data = (t or "").encode()
        gone = bytearray(len(data))
        if i is not None:
            for p in range(len(data) - length + 1):
                if first[data[p:p + length]] < i:
                    gone[p:p + length] = b"\1" * length
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((i, len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def texts():
    rnd = random.Random(4)
    words = ["".join(rnd.choices("abcdeéß", k=rnd.randint(1, 8))) for _ in range(300)]
    passages = [" ".join(rnd.choices(words, k=rnd.randint(6, 60))) for _ in range(12)]
    out = [None, "", "short", "x" * 49, "x" * 50, "x" * 51, "x" * 400, "ab" * 200, "ba" * 100, "日本" * 60, "本日" * 60]
    for _ in range(120):
        parts = [" ".join(rnd.choices(words, k=rnd.randint(0, 80)))]
        for _ in range(rnd.randint(0, 3)):
            p = rnd.choice(passages)
            a = rnd.randint(0, len(p) // 3)
            parts += [p[a:rnd.randint(a, len(p))], " ".join(rnd.choices(words, k=rnd.randint(0, 20)))]
        out.append("".join(parts))
    line = "The line that nearly every text of this table starts with, word for word.\n"
    out = [line + t if t and rnd.random() < 0.7 else t for t in out]
    return out + rnd.choices(out, k=15)


@pytest.mark.parametrize("length,q,batch_bytes,common", [(50, 20, 2 << 20, 500), (50, 20, 1500, 500), (50, 20, 700, 3), (12, 5, 900, 2)])
def test_every_removed_byte(spark, length, q, batch_bytes, common):
    found = texts()
    order = list(range(len(found)))
    random.Random(1).shuffle(order)
    rows = [(i, t) for i, t in zip(order, found)] + [(None, found[20]), (3, found[30]), (3, found[31])]
    docs = spark.createDataFrame([(i, t, "c", 5) for i, t in rows], "doc_id long, text string, kept string, n_bytes int").repartition(3)
    got = without_repeats(docs, length=length, q=q, digest=True, batch_bytes=batch_bytes, common=common)
    assert sorted(map(tuple, got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()), key=repr) == plain(rows, length)


def test_kept_text_is_valid_and_other_columns_stay(spark):
    shared = "ééé" * 30
    docs = spark.createDataFrame([(1, "a" + shared, "x"), (2, "b" + shared + "é", "y"), (3, None, "z")], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in without_repeats(docs, length=51, q=20).collect()}
    assert got[1].kept == "a" + shared and got[1].lang == "x" and got[3].kept == ""
    assert got[2].kept.startswith("b") and set(got[2].kept[1:]) <= {"é"} and got[2].n_removed > 100


def test_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert without_repeats(docs).count() == 0
