"""Token counts: pieces are counted once per distinct pre-token and joined to per-document frequencies.

1. Every task folds its texts into distinct pre-tokens with counts; one aggregate makes the vocabulary.
2. The library encodes each distinct pre-token once and keeps only the number of pieces.
3. The second pass over the texts folds each document into pre-token frequencies. Pre-tokens among the
   ``hot`` most frequent (short ones only, so their size is bounded by ``hot * hot_chars``) take their piece
   count from a broadcast table; all others are joined by a shuffle, where no key is frequent any more.
4. Frequencies times pieces are summed per document. Ids are never kept.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import frames, stored
from strata.llm.pretokens import split, tokenizer

FLUSH = 500_000  # distinct pre-tokens a task holds before it emits them
BLOCK = 8 << 20


def _vocabulary(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out():
            return pa.RecordBatch.from_pydict({"piece": pa.array(list(seen), pa.string()),
                                               "freq": pa.array(list(seen.values()), pa.int64())})

        for batch in frames(batches, BLOCK):
            for text in batch.column(0).to_pylist():
                if text:
                    seen.update(split(name, text))
                    if len(seen) >= FLUSH:
                        yield out()
                        seen.clear()
        if seen:
            yield out()

    return run


def _count_pieces(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(name)
        for batch in frames(batches, 1 << 20):
            found = encoder.encode_batch_fast(batch.column("piece").to_pylist(), add_special_tokens=False)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([len(e.ids) for e in found], pa.int32())], ["piece", "freq", "pieces"])

    return run


def _frequencies(name: str, hot):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, row = hot.value, TaskContext.get().partitionId() << 33
        kind = pa.list_(pa.struct([("piece", pa.string()), ("freq", pa.int32())]))
        for batch in frames(batches, BLOCK):
            ids, sizes, sums, rest = [], [], [], []
            for text in batch.column("text").to_pylist():
                total, tail = 0, []
                for piece, freq in Counter(split(name, text or "")).items():
                    pieces = known.get(piece)
                    if pieces is None:
                        tail.append({"piece": piece, "freq": freq})
                    else:
                        total += pieces * freq
                ids.append(row)
                sizes.append(len((text or "").encode()))
                sums.append(total)
                rest.append(tail)
                row += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), batch.column("id").cast(pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(sums, pa.int64()), pa.array(rest, kind)], ["row", "id", "n_bytes", "known", "rest"])

    return run


def vocabulary(spark: SparkSession, texts: DataFrame, text: str = "text", tokenizer_name: str = "byte_bpe_50k.json") -> DataFrame:
    """(piece, freq, pieces): every distinct pre-token of the column with its count and number of ids."""
    found = texts.select(F.col(text).alias("text")).where("text is not null and text <> ''").mapInArrow(
        _vocabulary(tokenizer_name), "piece string, freq long")
    distinct = found.groupBy("piece").agg(F.sum("freq").alias("freq"))
    return stored(spark, distinct.mapInArrow(_count_pieces(tokenizer_name), "piece string, freq long, pieces int"), "pieces")


def token_counts(
    spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text",
    tokenizer_name: str = "byte_bpe_50k.json", limit: int = 512, hot: int = 1 << 17, hot_chars: int = 48,
) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) for every row.

    Null text counts as empty: 0 bytes, 0 tokens. A null key stays null; repeated rows are counted each on
    their own, for rows are told apart by a number given in a stored table. Other columns of ``docs`` are not
    read, so clashing names do no harm. An empty table gives an empty result. ``hot`` bounds only what is
    broadcast, not what is counted.
    """
    pieces = vocabulary(spark, docs, text, tokenizer_name)
    top = pieces.where(F.length("piece") <= hot_chars).orderBy(F.desc("freq"), "piece").limit(hot)
    known = spark.sparkContext.broadcast({r.piece: r.pieces for r in top.select("piece", "pieces").toLocalIterator()})
    rows = stored(spark, docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(
        _frequencies(tokenizer_name, known),
        "row long, id long, n_bytes long, known long, rest array<struct<piece:string,freq:int>>"), "frequencies")
    tail = rows.select("row", F.explode("rest").alias("r")).select("row", "r.piece", "r.freq")
    tail = tail.join(pieces.select("piece", "pieces"), "piece").groupBy("row").agg(
        F.sum(F.col("freq").cast("long") * F.col("pieces")).alias("more"))
    total = F.col("known") + F.coalesce("more", F.lit(0))
    return rows.select("row", "id", "n_bytes", "known").join(tail, "row", "left").select(
        F.col("id").alias(key), "n_bytes", total.cast("long").alias("n_tokens"), (total > limit).alias("over_limit"))
