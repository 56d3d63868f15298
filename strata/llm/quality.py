"""Quality by nearest neighbours in a latent-semantic space.

A text is a bag of terms: byte n-grams of its lower-cased words, n-grams of its shape (letters, capitals,
digits, marks) and how often words return. Term counts are weighted (log count times inverse document frequency) and
projected on the leading singular vectors of a bounded labelled sample. The sample's vectors are broadcast; every
document is compared with all of them in blocks, and the labels of its nearest neighbours vote with their
similarity.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import appended, texts_of
from strata.llm.grams import grams
from strata.llm.languages import held

SHAPE = np.frombuffer(b"".join(
    b" " if bytes([c]).isspace() else b"a" if bytes([c]).islower() or c >= 128 else b"A" if bytes([c]).isupper()
    else b"0" if bytes([c]).isdigit() else bytes([c]) for c in range(256)), np.uint8).tobytes()
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
CHUNK = 1 << 20  # bytes hashed at once


class Space(NamedTuple):
    idf: np.ndarray
    basis: np.ndarray  # terms x dimensions
    vectors: np.ndarray  # sample x dimensions, unit length
    labels: np.ndarray
    prior: float


def _collapsed(shape: bytes) -> bytes:
    """Runs of one class as one or two characters."""
    a = np.frombuffer(shape, np.uint8)
    keep = np.ones(len(a), bool)
    keep[2:] = (a[2:] != a[1:-1]) | (a[2:] != a[:-2])
    return a[keep].tobytes()


def _counts(data: bytes, orders: tuple[int, ...], buckets: int) -> np.ndarray:
    """Counts of all n-grams per bucket, those that end in one chunk at a time: none is lost or doubled at a cut."""
    out = np.bincount(grams([data[:CHUNK]], orders, buckets)[1], minlength=buckets)
    for at in range(CHUNK, len(data), CHUNK):
        for n in orders:
            out += np.bincount(grams([data[max(at - n + 1, 0):at + CHUNK]], (n,), buckets)[1], minlength=buckets)
    return out


def terms(text: bytes, buckets: int) -> np.ndarray:
    """Counts per bucket: a half for words, a quarter for shapes, the rest for how words return."""
    out = np.zeros(buckets, np.int64)
    half, quarter = buckets // 2, buckets // 4
    out[:half] = _counts(text.translate(LOWER), (4,), half)
    out[half:half + quarter] = _counts(_collapsed(text.translate(SHAPE)), (3, 5), quarter)
    words = text.split()
    seen: dict[bytes, int] = {}
    lags = np.zeros(quarter, np.int64)
    for i, w in enumerate(words):
        gap = i - seen.get(w, -10**9)
        lags[min(gap, 64)] += 1  # 64: new, or not seen for long
        seen[w] = i
    if words:  # shares of gaps, in 32 steps per power of two
        share = lags[:65] / len(words)
        lags[:] = 0
        lags[:65] = np.round(64 * share)
    out[half + quarter:] = lags
    return out


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts).astype(np.float32) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          per_label: int = 1000, buckets: int = 4096, dimensions: int = 48, seed: int = 7) -> Space:
    """The space of the ``per_label`` labelled texts of each label with the smallest hashes.

    Rows without key or label are left out; a key labelled twice counts with its smaller label. What reaches
    the driver is bounded by labels times ``per_label`` times ``buckets``.
    """
    known = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(key).alias("_key")).agg(F.min(label).alias("y"))
    share = known.agg(F.avg("y")).first()[0]
    order = Window.partitionBy("y").orderBy(F.xxhash64("_key"), "_key")
    ids = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("_key")).distinct()
    drawn = ids.join(known, "_key").select("_key", "y", F.row_number().over(order).alias("n")).where(F.col("n") <= per_label)
    # At most two labels times per_label keys are broadcast.
    sample = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(drawn.select("_key", "y")), "_key")
    sample = sample.groupBy("_key", "y").agg(F.min("text").alias("text"))

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        found = [terms(t, buckets) for t in texts_of(batch.column("text"))]
        used = [np.flatnonzero(f) for f in found]
        return [pa.array([u.tolist() for u in used], pa.list_(pa.int32())),
                pa.array([f[u].tolist() for f, u in zip(found, used)], pa.list_(pa.int64()))]

    got = appended(sample.select("_key", "y", "text"), "term array<int>, count array<long>", compute).drop("text").toPandas()
    got = got.sort_values("_key", kind="stable")
    counts = np.zeros((len(got), buckets), np.float32)
    for i, (t, c) in enumerate(zip(got.term, got["count"])):
        counts[i, np.asarray(t, int)] = c
    if not len(got):
        return Space(np.ones(buckets, np.float32), np.zeros((buckets, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0), 0.5)
    idf = np.log((1 + len(got)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 0.1
    x = weighted(counts, idf)
    k = min(dimensions, *x.shape)
    probe = x.T @ (x @ np.random.default_rng(seed).standard_normal((buckets, min(k + 16, *x.shape))).astype(np.float32))
    for _ in range(3):  # subspace iteration
        probe = x.T @ (x @ np.linalg.qr(probe)[0])
    q = np.linalg.qr(x @ np.linalg.qr(probe)[0])[0]
    basis = np.linalg.svd(q.T @ x, full_matrices=False)[2][:k].T.astype(np.float32)
    v = x @ basis
    return Space(idf, basis, v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9), got.y.to_numpy(float), float(share))


def vote(space: Space, counts: np.ndarray, neighbours: int = 25, sharpness: float = 8.0) -> np.ndarray:
    """Probability of label 1; the share of labels decides where no neighbour is similar."""
    if not len(space.labels):
        return np.full(len(counts), 0.5)
    v = weighted(counts, space.idf) @ space.basis
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
    near = v @ space.vectors.T
    k = min(neighbours, near.shape[1])
    top = np.argpartition(-near, k - 1, axis=1)[:, :k]
    weight = np.maximum(np.take_along_axis(near, top, 1), 0).astype(float) ** sharpness
    return np.clip(((weight * space.labels[top]).sum(1) + 0.01 * space.prior) / (weight.sum(1) + 0.01), 0, 1)


def scored(docs: DataFrame, space: Space, text: str = "text", buckets: int = 4096) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``; null counts as empty, and an empty text gets the prior.

    Rows pass one by one without a shuffle; columns of these names are replaced, all others stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(space))

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        texts, out = texts_of(batch.column(text)), []
        for at in range(0, len(texts), 256):
            out.append(vote(Space(*shared.value), np.stack([terms(t, buckets) for t in texts[at:at + 256]])))
        score = np.concatenate(out) if out else np.zeros(0)
        return [pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32))]

    return appended(docs, "score double, predicted int", compute)


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, score, predicted): learned from rows outside fold 1 of 3 by the key's checksum."""
    space = learn(docs.where(~held(F.col(key), 3, 1)), labels.where(~held(F.col(key), 3, 1)), key, text)
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return scored(rows, space).select(F.col("doc_id").alias(key), held(F.col("doc_id"), 3, 1).alias("held_out"), "score", "predicted")
