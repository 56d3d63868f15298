"""Token counts and packing against the library's own encoding of whole texts."""

import random
import zlib
from array import array

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm.packing import SumOfSquares, pack
from strata.llm.pretokens import _OTHER, _SPLIT, PieceIds, byte_ranks, split, tokenizer
from strata.llm.token_counts import token_counts

NAME = "byte_bpe_50k.json"
TEXTS = [
    None, "", " ", "a", "Hello  world\n\n\n x", "it's we'll 'S don't''s", "tab\tend \r\n", "<|endoftext|>", "a<|endoftext|> b<|endoftext|>",
    "Überkeit — naïve ½ ² 3x x3", "日本語 テキスト", " \x1c\x85\xa0 odd", "😀 emoji 👩‍👩‍👧", "x" * 5000, "word " * 3000,
    "ñ" * 700, "the same text", "the same text", "____ __init__ a_b", "١٢٣ 12 ٣",
]
SCHEMA = "doc_id long, text string, row string, piece int, known long, start int"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "r", 1, 2, 3) for i, t in enumerate(TEXTS)] + [(None, "no key", "r", 1, 2, 3), (4, TEXTS[4], "r", 1, 2, 3)]
    return spark.createDataFrame(rows, SCHEMA)


def ids(text):
    return tokenizer(NAME).encode(text or "", add_special_tokens=False).ids


def test_plain_characters_split_as_the_library_does():
    plain = [chr(c) for c in range(0x250) if not _OTHER.search(chr(c))]
    assert len(plain) > 400
    for c in plain:
        for text in (f"a{c}b", f"1{c}{c} {c}x", f" {c}", f"{c}\n{c}'s", f"!{c}?"):
            own = [text[a:b] for _, (a, b) in tokenizer(NAME).pre_tokenizer.pre_tokenize_str(text)]
            assert _SPLIT.findall(text) == own, repr(c)


def test_pieces_get_the_ids_of_the_library():
    """Every piece of the vocabulary, and random ones of many scripts, one memo generation after the other."""
    rnd = random.Random(8)
    pieces = [t for t in (tokenizer(NAME).decode([i]) for i in range(tokenizer(NAME).get_vocab_size())) if t]
    ranges = ["abcdefghijklmnopqrstuvwxyz", "ABCXYZ'0123456789", " \n\t.,;!?-_()[]{}", "éèßüñøçğşžåłœ", "日本語中文字漢", "абвгдежз", "अआइई", "🙂👩‍🚀", "\x00\x7f\u2028"]
    pieces += ["".join(rnd.choices(rnd.choice(ranges) + rnd.choice(ranges), k=rnd.randint(1, 40))) for _ in range(20000)]
    assert byte_ranks(NAME) is not None and byte_ranks("word_bpe_49k.json") is None
    parts = list(dict.fromkeys(x for p in pieces for x in split(NAME, p)))
    want = [e.ids for e in tokenizer(NAME).encode_batch_fast(parts, add_special_tokens=False)]
    memo = PieceIds(NAME, most=100)
    for _ in range(2):
        assert [list(array("I", memo[p])) for p in parts] == want
    assert len(memo) <= 100 and len(memo.old) <= 100


def test_split_loses_nothing():
    assert all("".join(split(NAME, t)) == t for t in TEXTS if t)


@pytest.mark.parametrize("hot", [1, 1 << 17])
def test_counts_equal_encoding(spark, docs, hot):
    got = sorted(map(tuple, token_counts(spark, docs, hot=hot).collect()), key=repr)
    want = sorted(((r.doc_id, len((r.text or "").encode()), len(ids(r.text)), len(ids(r.text)) > 512) for r in docs.collect()), key=repr)
    assert got == want


def test_counts_of_nothing(spark, docs):
    assert token_counts(spark, docs.limit(0)).count() == 0


def check_packing(rows, texts_by_id, window):
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for got in sequences.values():
        at = 0
        for r in sorted(got, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    assert set(pieces) == set(texts_by_id)
    for key, text in texts_by_id.items():
        whole, at = np.array(ids(text) + [0], "<u4"), 0
        for r in sorted(pieces[key], key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(whole)
            assert r.ids_crc32 == zlib.crc32(whole[at:at + r.length].tobytes())
            at += r.length
        assert at == len(whole)
    return [sum(r.length for r in s) for s in sequences.values()]


@pytest.mark.parametrize("window,most_open", [(1024, 2048), (16, 3), (4, 1), (1, 1)])
def test_packing_holds_every_id_once(docs, window, most_open):
    own = docs.where("doc_id is not null").dropDuplicates(["doc_id"]).coalesce(1)
    fills = check_packing(pack(own, window=window, most_open=most_open).collect(), {r.doc_id: r.text for r in own.collect()}, window)
    assert sum(f < window for f in fills) <= 1  # one short sequence in a partition


def test_packing_of_null_keys_repeats_and_nothing(docs):
    assert pack(docs.where("doc_id is null")).count() == 1
    twice = docs.where("doc_id = 4")
    assert twice.count() == 2 and pack(twice).agg(F.sum("length")).first()[0] == 2 * (len(ids(TEXTS[4])) + 1)
    assert pack(docs.limit(0)).count() == 0


def test_level_has_the_least_sum_of_squares():
    rng, window = np.random.default_rng(3), 12
    packer = SumOfSquares(window, 10**6, lambda pieces: None)
    for size in rng.integers(1, window, 400):
        before, choices = packer.count.copy(), {}
        for h in [0, *np.flatnonzero(before)]:
            if h + size <= window:
                after = before.copy()
                after[h] -= h > 0
                after[h + size] += h + size < window
                choices[int(h)] = int((after[1:window] ** 2).sum())
        at = packer.level(int(size))
        assert choices[at] == min(choices.values())
        packer.add((("d", 0), 0, b"\0\0\0\0" * int(size)))
        assert int((packer.count[1:window] ** 2).sum()) == min(choices.values())


def test_whole_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    got = {r.doc_id: r.n_tokens for r in token_counts(spark, docs).collect()}
    assert got == {k: len(ids(t)) for k, t in texts.items()}
    check_packing(pack(docs).collect(), texts, 1024)
