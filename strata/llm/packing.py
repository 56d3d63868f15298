"""Packing by sum of squares: each rest of a document goes to the fill level that keeps levels few and even.

Ids are cut into full windows; a document's rest of 1 to ``window - 1`` ids is placed online. A level array
counts the partly filled windows of each fill; a rest of size r may open a window (level 0) or go to any
occupied level h with ``h + r <= window``. The placement with the least sum of squared counts wins, ties to the
fullest level. When more than ``most_open`` windows are partly filled, and at the end of a partition, these are
closed: the emptiest give their ids, cut where needed, to the fullest, so that one window at most stays short.

Spark's input splits are packed side by side, without a shuffle, and a task holds ``most_open`` windows at most.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import frames
from strata.llm.pretokens import ids_of

EMIT = 20_000  # pieces per output batch
END = b"\0\0\0\0"  # id 0 closes a document


class SumOfSquares:
    """Level array and partly filled windows; full ones are handed to ``emit`` as lists of pieces."""

    def __init__(self, window: int, most_open: int, emit):
        self.window, self.most_open, self.emit = window, most_open, emit
        self.count = np.zeros(window + 1, np.int64)  # partly filled windows by fill; 0 and window stay 0
        self.open: dict[int, list[list]] = defaultdict(list)
        self.n = 0

    def level(self, size: int) -> int:
        """The fill a rest of ``size`` goes to; 0 opens a window."""
        fits = self.count[: self.window - size + 1]
        target = self.count[size:].copy()
        change = 2 * target + 1  # the level that is reached gains one window
        change[-1] = 0  # a full window leaves the array
        change[1:] -= 2 * fits[1:] - 1  # the level that is left loses one
        change[1:][fits[1:] == 0] = np.iinfo(np.int64).max
        return len(change) - 1 - int(np.argmin(change[::-1]))

    def add(self, piece: tuple) -> None:
        """``piece`` is (document, start, ids as bytes), shorter than a window."""
        size = len(piece[2]) // 4
        at = self.level(size)
        if at:
            pieces = self.open[at].pop()
            self.count[at] -= 1
            self.n -= 1
        else:
            pieces = []
        pieces.append(piece)
        if at + size == self.window:
            self.emit(pieces)
            return
        self.open[at + size].append(pieces)
        self.count[at + size] += 1
        self.n += 1
        if self.n > self.most_open:
            self.close(False)

    def close(self, last: bool) -> None:
        """Fill the fullest windows with the ids of the emptiest; a short one stays open unless ``last``."""
        held = [(fill, pieces) for fill in sorted(self.open) for pieces in self.open[fill]]
        self.open.clear()
        self.count[:] = 0
        self.n = 0
        low, high = 0, len(held) - 1
        while low <= high:
            fill, pieces = held[high]
            while fill < self.window and low < high:
                doc, start, ids = held[low][1].pop()
                take = min(self.window - fill, len(ids) // 4)
                pieces.append((doc, start, ids[:4 * take]))
                fill += take
                if 4 * take < len(ids):
                    held[low][1].append((doc, start + take, ids[4 * take:]))
                if not held[low][1]:
                    low += 1
            if fill == self.window or last:
                self.emit(pieces)
            else:
                self.open[fill].append(pieces)
                self.count[fill] = 1
                self.n = 1
            high -= 1


def _pack(name: str, window: int, most_open: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns: list[list] = [[] for _ in range(7)]
        sequence = TaskContext.get().partitionId() << 33

        def emit(pieces: list[tuple]) -> None:
            nonlocal sequence
            at = 0
            for (key, total), start, ids in pieces:
                n = len(ids) // 4
                for column, value in zip(columns, (key, start, n, zlib.crc32(ids), total, sequence, at)):
                    column.append(value)
                at += n
            sequence += 1

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], NAMES)
            for c in columns:
                c.clear()
            return batch

        packer = SumOfSquares(window, most_open, emit)
        for batch in frames(batches, 4 << 20):
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                ids = ids_of(name, text or "") + END
                total = len(ids) // 4
                full = total - total % window
                for start in range(0, full, window):
                    emit([((key, total), start, ids[4 * start:4 * (start + window)])])
                if full < total:
                    packer.add(((key, total), full, ids[4 * full:]))
                if len(columns[0]) >= EMIT:
                    yield out()
        packer.close(True)
        yield out()

    return run


NAMES = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack(
    docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer_name: str = "byte_bpe_50k.json",
    window: int = 1024, most_open: int = 2048,
) -> DataFrame:
    """One row per piece: (key, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    Every document ends with id 0; a null or empty text is that id alone. Null keys stay null, repeated rows
    are packed each. Only key and text are read. An empty table gives no row. The result is a function of the
    order of rows inside Spark's input partitions: give it files or a stored table, whose splits are read in
    the same order when a task is repeated. Sequence numbers start anew in each partition, above its number.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(_pack(tokenizer_name, window, most_open), ", ".join(f"{n} long" for n in NAMES)) \
        .withColumnRenamed("id", key)
