"""Sampled segmentations: exact decoding, exact probabilities, and frequencies of sampling without replacement."""

import itertools
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm.queries import op1_segmentations
from strata.llm.segmentations import (
    Met, Pieces, decode, decoded, ids_of, lattice, sample_segmentations, segmented, segmented_flat, top_k, units_of, words_of,
)

NAME = "piece_bpe_32k.model"
TEXTS = [None, "", " ", "   ", "a", "the theory of other things", "  two  spaces ", "tab\tline\n", "日本語 😀 x", "x" * 700, "é" * 300, "word " * 400]


@pytest.fixture(scope="module")
def pieces():
    return Pieces(NAME)


def all_ways(word, pieces):
    """Every segmentation with its probability."""
    rank = {pieces.text[i]: -w for known in pieces.known for i, w in zip(known[1], known[2])}
    found = []

    def walk(at, got, weight):
        if at == len(word):
            found.append((tuple(got), weight))
        for n in range(1, min(pieces.longest, len(word) - at) + 1):
            if word[at:at + n] in rank:
                walk(at + n, [*got, word[at:at + n]], weight - rank[word[at:at + n]])

    walk(0, [], 0.0)
    top = max(w for _, w in found)
    total = sum(np.exp(w - top) for _, w in found)
    return {g: np.exp(w - top) / total for g, w in found}


def test_samples_decode_to_the_text(spark):
    rows = [(i, t, 9, "s") for i, t in enumerate(TEXTS)] + [(None, "no key", 9, "s"), (5, TEXTS[5], 9, "s")]
    df = spark.createDataFrame(rows, "conv_id long, text string, ids int, samples string")
    got = sample_segmentations(df.drop("ids"), ["conv_id"]).select("conv_id", "text", F.explode("samples").alias("s")).select("conv_id", "text", "s.*")
    found = decode(got).collect()
    assert all(r.decoded == (r.text or "") for r in found)
    per = {}
    for r in found:
        per.setdefault((r.conv_id, r.text), []).append(r)
    for (key, text), own in per.items():
        distinct = {(r["rank"], tuple(r.ids)) for r in own}
        assert len({ids for _, ids in distinct}) == len(distinct) and all(0 < r.inclusion <= 1 for r in own)
        by_rank = sorted({(r["rank"], r.perturbed) for r in own})
        assert [p for _, p in by_rank] == sorted((p for _, p in by_rank), reverse=True)
        if text and len(set(text)) > 8:
            assert len(distinct) == 4
    assert len(per[None, "no key"]) == 4 and len(per[5, TEXTS[5]]) == 8  # a repeated row, equal samples
    assert sample_segmentations(df.drop("ids").limit(0), ["conv_id"]).count() == 0


def test_units_cover_the_text():
    for t in TEXTS:
        assert "".join(units_of(t or "")) == ("▁" + t.replace(" ", "▁") if t else "")


def test_probabilities_and_all_segmentations(pieces):
    text = "then"
    ways = all_ways("▁then", pieces)
    [samples] = segmented([text], [12345], 10_000, pieces)
    assert len(samples) == len(ways)
    got = {tuple(pieces.text[i] for i in s[4]): np.exp(s[1]) for s in samples}
    assert got.keys() == ways.keys() and all(abs(got[g] - ways[g]) < 1e-9 for g in ways)
    assert all(s[3] == 1.0 for s in samples)


def test_order_is_sampling_without_replacement(pieces):
    """The first two samples of many keys follow the probabilities of drawing without replacement."""
    ways = all_ways("▁an", pieces)
    lat, n = lattice(["▁an"], pieces), 8_000
    seen = Counter()
    for seed in np.random.default_rng(1).integers(0, 2**63, n).tolist():
        samples, _ = top_k(lat, np.array([0]), seed, 2)
        seen[tuple(tuple(pieces.text[i] for i in ids_of(lat, s.edges, pieces)) for s in samples)] += 1
    for a, b in itertools.permutations(ways, 2):
        p = ways[a] * ways[b] / (1 - ways[a])
        assert abs(seen[a, b] / n - p) < 4.5 * np.sqrt(p * (1 - p) / n) + 1e-4, (a, b)


def test_inclusion_scores_are_unbiased(pieces):
    """Weights p / inclusion estimate the mean number of pieces over all segmentations."""
    ways = all_ways("▁thanin", pieces)
    lat = lattice(["▁thanin"], pieces)
    want = sum(p * len(g) for g, p in ways.items())
    found = []
    for seed in np.random.default_rng(2).integers(0, 2**63, 2000).tolist():
        samples, kappa = top_k(lat, np.array([0]), seed, 3)
        found.append(sum(np.exp(s.log_prob) / -np.expm1(-np.exp(s.log_prob - kappa)) * len(s.edges) for s in samples))
    assert abs(np.mean(found) - want) < 4.5 * np.std(found) / np.sqrt(len(found)) + 1e-3  # rare segmentations carry large weights


def test_whole_table(spark, sf):
    rows = spark.read.parquet(f"{sf}/conversations.parquet")
    got = decode(sample_segmentations(rows, ["conv_id", "turn"]).select("text", F.explode("samples.ids").alias("ids")))
    assert got.where("decoded <> text").count() == 0 and got.count() > rows.count()


def test_query_segments_every_document(spark, sf):
    """The registered query: all documents, the longest too, with ids that give the text again."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = op1_segmentations(spark, sf).select("doc_id", "rank", "ids", "n_pieces", "ids_crc32", "decodes").collect()
    assert all(r.decodes and len(r.ids) == r.n_pieces and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in got)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id for r in got} == set(texts) and len({(r.doc_id, r["rank"]) for r in got}) == len(got)
    longest = max((i for i in texts if texts[i]), key=lambda i: len(texts[i]))
    assert sum(r.doc_id == longest for r in got) == 4


def test_a_long_run_is_one_lattice(pieces):
    """Probabilities of a run without a space against a plain sum over all ways; pieces lie across every place."""
    text = "thenationinthan" * 60
    run = "▁" + text
    weight = {pieces.text[i]: w for known in pieces.known for i, w in zip(known[1], known[2])}
    total = np.full(len(run) + 1, -np.inf)
    total[-1] = 0.0
    for at in range(len(run) - 1, -1, -1):
        ways = [weight[run[at:b]] + total[b] for b in range(at + 1, min(at + pieces.longest, len(run)) + 1) if run[at:b] in weight]
        total[at] = np.logaddexp.reduce(ways)
    inside = set()
    for samples in segmented([text] * 20, list(range(20)), 4, pieces):
        for _, log_prob, _, _, ids in samples:
            own = [pieces.text[i] for i in ids]
            assert "".join(own) == run and abs(log_prob - (sum(weight[p] for p in own) - total[0])) < 1e-6
            ends = np.cumsum([len(p) for p in own])
            inside |= {256, 512, 768} - set(ends.tolist())
    assert inside == {256, 512, 768}


def test_texts_are_searched_side_by_side(pieces):
    """Many short texts at once cost a small part of what they cost one by one, and give the same samples."""
    texts = [f"the theory of {n} other things in {n % 7} nations" for n in range(300)]
    segmented(texts[:1], [0], 4, pieces)
    t0 = time.process_time()
    one = [segmented([t], [n], 4, pieces)[0] for n, t in enumerate(texts)]
    t1 = time.process_time()
    found = segmented(texts, list(range(300)), 4, pieces)
    assert time.process_time() - t1 < 0.2 * (t1 - t0)
    for a, b in zip(one, found):
        assert [s[4].tolist() for s in a] == [s[4].tolist() for s in b] and np.allclose([s[1:4] for s in a], [s[1:4] for s in b], rtol=1e-9)


def test_units_kept_and_dropped_give_the_same(pieces):
    """Samples do not depend on which units a worker has met, nor on how many it keeps."""
    texts = [" ".join(f"{w}{n % m}" for w in ("the", "nation", "日本", "theory") for m in (2, 3, 50)) for n in range(120)]
    want = segmented(texts, list(range(120)), 3, pieces)
    for most in (400, 2_500, 1_000_000):
        met = Met(pieces, most)
        for n in range(0, 120, 8):
            s = segmented_flat(pa.array(texts[n:n + 8]), np.arange(n, n + 8, dtype=np.uint64), 3, met)
            own = [x[4] for t in want[n:n + 8] for x in t]
            assert np.array_equal(s.ids, np.concatenate(own)) and np.diff(s.first).tolist() == [len(x) for x in own]


def test_words_are_units(pieces):
    texts = [*TEXTS, "▁", "▁▁a ▁b", " a", "a ", "a  b", "  ", ""]
    words, count = words_of(pa.array(texts, pa.string()))
    assert ["▁" + w for w in words.to_pylist()] == [u for t in texts for u in units_of(t or "")]
    assert count.tolist() == [len(units_of(t or "")) for t in texts]


def test_decoding_is_that_of_the_model(pieces):
    """Pieces joined from their bytes against the model, with bytes that are no character, controls and unknown pieces."""
    rng = np.random.default_rng(3)
    lists = [rng.integers(0, top, rng.integers(0, 9)).tolist() for top in (len(pieces.text), 270) for _ in range(500)] + [None, []]
    got = decoded(pa.array(lists, pa.list_(pa.int32())), pieces)
    assert got.to_pylist() == [None if ids is None else pieces.model.decode(ids) for ids in lists]
    with pytest.raises(IndexError):
        decoded(pa.array([[len(pieces.text)]], pa.list_(pa.int32())), pieces)
