"""Importance resampling of documents towards a target distribution, with weights from bit planes.

A document's features are its words and pairs of neighbouring words, hashed into buckets by CRC-32. A bucket's gain is
the scaled log ratio of its smoothed share in the target to that in the corpus, and a document's weight the floored
mean gain of its features. Gumbel noise from a hash of the key turns weights into scores, and the highest scores are a
sample without replacement.

The sum of gains is bit-sliced. Bit i of all bucket counts of a document is one plane of ``buckets`` bits, bit j of all
gains (two's complement) another; the sum is that of 2**(i+j) times the set bits of both planes, where the gains' top
plane counts negatively. Only AND, popcount and sums of powers of two are needed, in integers.

Bucket counts of the corpus are a small aggregate that does not grow with it. Ranks come from a range partition
by score and key and the partitions' sizes, so no task sees all rows, and ties of scores need no group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import appended, frames, stored, texts_of

# Lower-cases A-Z, keeps 0-9, a-z and bytes from 0x80, and turns all others into spaces.
WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
AT_ONCE = 32  # documents whose planes are in memory


def words(text: bytes) -> list[bytes]:
    return text.translate(WORDS).split()


def feature_buckets(found: list[bytes], buckets: int) -> np.ndarray:
    """Buckets of all words and all pairs of neighbours (joined by a space) of a text, repeats included."""
    single = list(map(crc32, found))
    left = map(crc32, repeat(b" "), single)  # CRC-32 goes on where the first word's ended
    pairs = list(map(crc32, found[1:], left))
    return np.array(single + pairs, np.int64) % buckets


def _counted(text: str, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in frames(batches, 1 << 20):
            for t in texts_of(batch.column(text)):
                total += np.bincount(feature_buckets(words(t), buckets), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at, pa.int64()), "n": pa.array(total[at])})

    return run


def bucket_counts(docs: DataFrame, text: str, buckets: int) -> np.ndarray:
    """Features per bucket of a whole table: ``buckets`` numbers."""
    counted = docs.select(F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(_counted("text", buckets), "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(target share / corpus share)) per bucket, shares smoothed by one per bucket, in doubles."""
    s, t, buckets = corpus.tolist(), target.tolist(), len(corpus)
    up, down = float(sum(s) + buckets), float(sum(t) + buckets)
    return np.array([math.floor(1000 * math.log((b + 1) * up / ((a + 1) * down))) for a, b in zip(s, t)], np.int64)


def planes(numbers: np.ndarray, bits: int) -> np.ndarray:
    """(..., bits, words): bit i of each number of the last axis as a row of 64-bit words."""
    shifted = (numbers[..., None, :] >> np.arange(bits)[:, None]) & 1
    packed = np.packbits(shifted.astype(np.uint8), axis=-1)
    pad = -packed.shape[-1] % 8
    return np.pad(packed, [(0, 0)] * (packed.ndim - 1) + [(0, pad)]).view(np.uint64)


def width(numbers: np.ndarray) -> int:
    """Bits that hold every number without its sign."""
    return max(1, int(max(numbers.max(initial=0), -numbers.min(initial=0) - 1)).bit_length())


class GainPlanes:
    """Bit planes of signed gains, two's complement."""

    def __init__(self, gain: np.ndarray):
        bits = width(gain) + 1
        self.planes = planes(gain, bits)
        self.power = np.int64(1) << np.arange(bits)
        self.power[-1] *= -1

    def sums(self, counts: np.ndarray) -> np.ndarray:
        """The gains of each row of bucket counts, summed."""
        own = planes(counts, width(counts))
        out = np.zeros(len(counts), np.int64)
        for i in range(own.shape[1]):
            for plane, power in zip(self.planes, self.power):
                out += (power << i) * np.bitwise_count(own[:, i] & plane).sum(axis=-1, dtype=np.int64)
        return out


def weigh(docs: DataFrame, gain: np.ndarray, text: str, names: tuple[str, str, str]) -> DataFrame:
    """``docs`` with the numbers of words and features and the floored mean gain (0 without features)."""
    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        table = GainPlanes(gain)
        texts = texts_of(batch.column(batch.schema.get_field_index(text)))
        n_words, n_features, total = (np.zeros(len(texts), np.int64) for _ in range(3))
        for at in range(0, len(texts), AT_ONCE):
            found = [words(t) for t in texts[at:at + AT_ONCE]]
            n_words[at:at + AT_ONCE] = [len(f) for f in found]
            counts = np.stack([np.bincount(feature_buckets(f, len(gain)), minlength=len(gain)).astype(np.int32) for f in found])
            n_features[at:at + AT_ONCE] = counts.sum(axis=1, dtype=np.int64)
            total[at:at + AT_ONCE] = table.sums(counts)
        weight = total // np.maximum(n_features, 1)
        return [pa.array(a) for a in (n_words, n_features, weight)]

    return appended(docs, ", ".join(f"{n} long" for n in names), compute)


def noise(key: str, seed: int) -> Column:
    """Gumbel noise in thousandths, floored, from the first 32 bits of the SHA-256 of ``seed:key``; 0 bits for a null key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(spark: SparkSession, rows: DataFrame, chosen: str, order: list[Column], share: Fraction, rank: str) -> DataFrame:
    """``rows`` with ``rank`` 1, 2, 3, ... by ``order`` for the first floor(share * n) of the n ``chosen`` ones, null for others."""
    dealt = rows.repartitionByRange(F.col(chosen).desc(), *order).sortWithinPartitions(F.col(chosen).desc(), *order)
    # Written before use: the partition and place of a row are fixed from here on.
    placed = stored(spark, dealt.withColumn("__at", F.monotonically_increasing_id()), "resampling-order")
    part = F.shiftright("__at", 33)
    sizes = placed.where(chosen).groupBy(part.alias("__part")).count().collect()  # a row per partition
    before, offsets = 0, []
    for row in sorted(sizes, key=lambda r: r["__part"]):
        offsets.append((row["__part"], before))
        before += row["count"]
    drawn = share.numerator * before // share.denominator
    table = F.broadcast(spark.createDataFrame(offsets, "__part long, __before long"))
    place = F.col("__at").bitwiseAND((1 << 33) - 1) + F.col("__before") + 1
    found = placed.withColumn("__part", part).join(table, "__part", "left")
    return found.withColumn(rank, F.when(F.col(chosen) & (place <= drawn), place)).drop("__part", "__before", "__at")


def resample(
    spark: SparkSession, docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
    buckets: int = 10000, seed: int = 7, share: Fraction = Fraction(25, 100), least_words: int = 20, keep: list[str] | None = None,
    names: tuple[str, str, str, str] = ("n_features", "weight", "score", "rank"),
) -> DataFrame:
    """``docs`` (or its columns ``keep``) with n_features, weight, score and rank, or under other ``names``.

    ``rank`` numbers the drawn documents: of the n with at least ``least_words`` words, the floor(share * n) with the highest
    ``score``, ties to the smaller ``key``, then the smaller weight and feature count; it is null for all others.
    ``score`` is the weight plus Gumbel noise in thousandths. Words are runs of 0-9, A-Z (lower-cased) and characters
    beyond ASCII. Null and empty texts have no features, weight 0, and are never drawn. Rows with a null key are scored
    with the noise of an empty key. Repeated rows count as documents of their own, with equal scores and ranks that
    follow each other. Empty tables stay empty; with an empty ``target`` its shares are equal. Columns of ``docs`` with one of
    ``names`` are replaced.
    """
    gain = gains(bucket_counts(docs, text, buckets), bucket_counts(target, target_text, buckets))
    kept = [c for c in (docs.columns if keep is None else keep) if c not in names]
    rows = docs.select(F.col(f"`{key}`").alias("__key"), F.col(f"`{text}`").alias("__text"), F.struct(*[F.col(f"`{c}`") for c in kept]).alias("__row"))
    n_features, weight, score, rank = "__features", "__weight", "__score", "__rank"
    found = weigh(rows, gain, "__text", ("__words", n_features, weight)).drop("__text")
    found = found.withColumn(score, F.col(weight) + noise("__key", seed)).withColumn("__chosen", F.col("__words") >= least_words)
    found = stored(spark, found.drop("__words"), "resampling-scores")
    order = [F.col(score).desc(), F.col("__key"), F.col(weight), F.col(n_features)]
    out = ranked(spark, found, "__chosen", order, share, rank)
    return out.select("__row.*", *[F.col(c).cast("long").alias(n) for c, n in zip((n_features, weight, score, rank), names)])
