"""Exact repeated-substring removal by bucket refinement.

A position belongs to the bucket of the string that starts there; only buckets that hold several documents matter.

0. Documents are written once as batches of about ``batch_bytes`` bytes (all columns, compressed).
1. q-gram buckets. Every ``length``-byte window is represented by one of its q-grams, that of the smallest hash
   (leftmost among equals). Equal windows choose equal q-grams, and neighbouring windows mostly share one, so
   few positions are dealt. Each batch sends its distinct q-gram buckets by hash range; the range answers for each
   whether other batches hold it as well, or very many of them do. Buckets of one document end here.
2. Refinement. What is left is sorted on the bucket of the q-grams at all later offsets of the window, which is
   the bucket of the whole window: a batch sends, per surviving q-gram and distinct run of windows, the bytes of
   the run and its smallest document; a range sorts the windows by a 128-bit hash, and the smallest document of
   each bucket is known. Windows of very common q-grams are dealt one by one, by their own hash, so no
   range gathers the surroundings of a common line.
3. Reuse. The answers go back to the batches, where every occurrence inherits its bucket's answer, and removed
   windows are merged into runs of bytes.

Per batch and bucket at most one entry travels, so a passage that all documents share costs one entry per batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import RollingHash, frames, mixed, per_process, stored, texts_of

U = np.uint64
RANGES_PER_TASK = 4  # a task answers its hash ranges one after the other, so that few are in memory


def _squeezed(a: np.ndarray) -> bytes:
    """Numbers of one width as compressed byte planes."""
    raw = np.ascontiguousarray(a)
    planes = raw.view(np.uint8).reshape(len(raw), raw.itemsize).T.tobytes() if len(raw) else b""
    return len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _unsqueezed(data: bytes, kind) -> np.ndarray:
    size, kind = int.from_bytes(data[:8], "little"), np.dtype(kind)
    planes = np.frombuffer(pa.decompress(data[8:], size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(kind.itemsize, -1).T).reshape(-1).view(kind)


def _range_of(h: np.ndarray, ranges: int) -> np.ndarray:
    """Range of a 48-bit hash; ranges are intervals, so sorted hashes have sorted ranges."""
    return ((h >> U(16)) * U(ranges) >> U(32)).astype(np.int64)


class Runs(NamedTuple):
    """Runs of neighbouring windows with one q-gram: first and last start, owner and the q-gram's hash (48 bits)."""
    low: np.ndarray
    high: np.ndarray
    doc: np.ndarray
    gram: np.ndarray


class Batch:
    """The texts of one batch as a byte buffer, with rolling hashes and runs of windows."""

    def __init__(self, texts: list[bytes], ids: list[int | None], length: int, q: int):
        self.length, self.q = length, q
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.known = np.array([i is not None for i in ids], bool)
        self.ids = np.array([i or 0 for i in ids], np.int64)
        self.first, self.second = per_process("repeats", lambda: (RollingHash(101), RollingHash(202)))
        self.prefix = self.first.prefix(self.data)
        self.runs = self._runs()

    def _smallest(self, h: np.ndarray, width: int) -> np.ndarray:
        """Position of the smallest of 40 leading hash bits among ``width`` neighbours, leftmost if equal."""
        top = h & ~U(0xFFFFFF)
        if len(h) <= 1 << 24:
            best, step = top | np.arange(len(h), dtype=U), 1
            while 2 * step <= width:
                best = np.minimum(best[:-step], best[step:])
                step *= 2
            rest = width - step
            return ((np.minimum(best[:-rest], best[rest:]) if rest else best) & U(0xFFFFFF)).astype(np.int64)
        best, at, step = top, np.arange(len(h)), 1
        while step < width:
            step_by = min(step, width - step)
            right = best[step_by:] < best[:-step_by]
            best, at = np.where(right, best[step_by:], best[:-step_by]), np.where(right, at[step_by:], at[:-step_by])
            step += step_by
        return at

    def _runs(self) -> Runs:
        none = np.empty(0, np.int64)
        if len(self.data) < self.length:
            return Runs(none, none, none, none.astype(U))
        h = self.first.windows(self.prefix, self.q)
        at = self._smallest(h, self.length - self.q + 1)
        inside = np.zeros(len(at) + 1, np.int32)  # windows that stay inside a document with a key
        long = np.flatnonzero((self.sizes >= self.length) & self.known)
        np.add.at(inside, self.starts[long], 1)
        np.add.at(inside, self.starts[long] + self.sizes[long] - self.length + 1, -1)
        windows = np.flatnonzero(np.cumsum(inside[:-1]))
        if not len(windows):
            return Runs(none, none, none, none.astype(U))
        at = at[windows]
        cut = np.flatnonzero((np.diff(at) != 0) | (np.diff(windows) != 1)) + 1
        low, high = windows[np.r_[0, cut]], windows[np.r_[cut - 1, len(windows) - 1]]
        # The document that a start lies in: the last one that begins at or before it, empty ones aside.
        doc = np.searchsorted(self.starts, low, side="right") - 1
        # The chosen hashes are minima, so small; mixed anew they are even over the ranges.
        return Runs(low, high, doc, mixed(h[at[np.r_[0, cut]]]) >> U(16))

    def buckets(self) -> np.ndarray:
        """Distinct q-gram hashes, ascending."""
        return np.unique(self.runs.gram)

    def chosen(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Runs of normal and of very common q-grams, from the answers for ``buckets()``."""
        grams = self.buckets()
        at = np.searchsorted(grams, self.runs.gram)
        low, high = np.full(len(grams), 2**63 - 1), np.full(len(grams), -(2**63))
        np.minimum.at(low, at, self.ids[self.runs.doc])
        np.maximum.at(high, at, self.ids[self.runs.doc])
        code = np.maximum(codes, (low < high).astype(np.uint8))[at]  # two documents of this batch suffice
        return np.flatnonzero(code == 1), np.flatnonzero(code == 2)

    def entries(self, picked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(representative run, smallest document) per distinct run content, by q-gram; entry of each picked run."""
        low, end = self.runs.low[picked], self.runs.high[picked] + self.length
        content = self.second.spans(self._prefix2(), low, end)
        order = np.lexsort((content, self.runs.gram[picked]))
        c, g = content[order], self.runs.gram[picked][order]
        new = np.ones(len(order), bool)
        new[1:] = (c[1:] != c[:-1]) | (g[1:] != g[:-1])
        entry = np.empty(len(order), np.int64)
        entry[order] = np.cumsum(new) - 1
        least = np.full(int(new.sum()), 2**63 - 1)
        np.minimum.at(least, entry, self.ids[self.runs.doc[picked]])
        return picked[order[new]], least, entry

    def windows(self, picked: np.ndarray) -> tuple[np.ndarray, ...]:
        """Distinct windows of the picked runs: their two hashes and smallest document, sorted; then every
        window's start, document and number among the distinct ones."""
        n = self.runs.high[picked] - self.runs.low[picked] + 1
        start = np.repeat(self.runs.low[picked] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        doc = np.repeat(self.runs.doc[picked], n)
        h1 = self.first.spans(self.prefix, start, start + self.length)
        h2 = self.second.spans(self._prefix2(), start, start + self.length)
        order, group = _groups(h1, h2)
        number = np.empty(len(order), np.int64)
        number[order] = group
        least = np.full(int(group[-1]) + 1 if len(group) else 0, 2**63 - 1)
        np.minimum.at(least, number, self.ids[doc])
        first = order[np.flatnonzero(np.diff(group, prepend=-1))]
        return h1[first], h2[first], least, start, doc, number

    def _prefix2(self) -> np.ndarray:
        if not hasattr(self, "prefix2"):
            self.prefix2 = self.second.prefix(self.data)
        return self.prefix2

    def cover(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """True for each byte inside one of the intervals."""
        change = np.bincount(starts, minlength=len(self.data) + 1) - np.bincount(ends, minlength=len(self.data) + 1)
        return np.cumsum(change[:-1]) > 0


def _groups(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts equal pairs together, and the group number of each place in it."""
    order = np.argsort(h1, kind="stable")
    a, b = h1[order], h2[order]
    same = a[1:] == a[:-1]
    if (same & (b[1:] != b[:-1])).any():
        order = np.lexsort((h2, h1))
        a, b = h1[order], h2[order]
        same = a[1:] == a[:-1]
    new = np.ones(len(order), bool)
    new[1:] = ~(same & (b[1:] == b[:-1]))
    return order, np.cumsum(new) - 1


def _write_batches(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, held_bytes = TaskContext.get().partitionId() << 33, [], 0

        def out():
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_table(pa.Table.from_batches(held).combine_chunks())
            return pa.RecordBatch.from_pydict({"batch": pa.array([number], pa.int64()), "payload": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

        for batch in frames(batches, size // 4):
            held.append(batch)
            held_bytes += batch.nbytes
            if held_bytes >= size:
                yield out()
                number, held, held_bytes = number + 1, [], 0
        if held:
            yield out()

    return run


class Plan(NamedTuple):
    """What all tasks need to know."""
    key: str
    text: str
    length: int
    q: int
    ranges: int
    common: int

    def batch(self, payload: bytes) -> tuple[pa.Table, Batch, list[bytes]]:
        table = pa.ipc.open_stream(payload).read_all()
        texts = texts_of(table.column(self.text).combine_chunks())
        ids = table.column(self.key).cast(pa.int64()).to_pylist()
        return table, Batch(texts, ids, self.length, self.q), texts

    def deal(self, h: np.ndarray) -> list[tuple[int, int, int]]:
        """(range, from, to) of sorted hashes."""
        ranges = _range_of(h, self.ranges)
        cut = np.r_[0, np.flatnonzero(np.diff(ranges)) + 1, len(h)]
        return [(int(ranges[a]), int(a), int(b)) for a, b in zip(cut[:-1], cut[1:]) if b > a]

    def gathered(self, answers: list[dict] | None, kind, n: int, part: str) -> np.ndarray:
        """The answers of all ranges in order, one for each of ``n`` entries."""
        found = [_unsqueezed(a[part], kind) for a in sorted(answers or [], key=lambda a: a["range"])]
        out = np.concatenate([np.empty(0, kind), *found])
        assert len(out) == n, "answers must match the entries that were sent"
        return out


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in frames(batches, 1 << 20):
        yield from batch.to_pylist()


def _send_grams(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            grams = plan.batch(row["payload"])[1].buckets()
            dealt = plan.deal(grams)
            yield pa.RecordBatch.from_pydict({
                "range": pa.array([r for r, _, _ in dealt], pa.int32()), "batch": pa.array([row["batch"]] * len(dealt), pa.int64()),
                "grams": pa.array([_squeezed(np.diff(grams[a:b], prepend=U(0))) for _, a, b in dealt], pa.binary())})

    return run


def _by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    held: list[dict] = []
    for row in _rows(batches):
        if held and held[0]["range"] != row["range"]:
            yield held
            held = []
        held.append(row)
    if held:
        yield held


def _answer_grams(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_range(batches):
            each = [np.cumsum(_unsqueezed(r["grams"], U), dtype=U) for r in rows]
            every = np.concatenate(each)
            values, count = np.unique(every, return_counts=True)
            code = (count > 1).astype(np.uint8) + (count > plan.common)
            yield pa.RecordBatch.from_pydict({
                "batch": pa.array([r["batch"] for r in rows], pa.int64()), "range": pa.array([r["range"] for r in rows], pa.int32()),
                "codes": pa.array([_squeezed(code[np.searchsorted(values, e)].astype(np.uint8)) for e in each], pa.binary())})

    return run


def _send_windows(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            own = plan.batch(row["payload"])[1]
            normal, common = own.chosen(plan.gathered(row["answers"], np.uint8, len(own.buckets()), "codes"))
            runs, least, _ = own.entries(normal)
            h1, h2, w_least, *_ = own.windows(common)
            low, end = own.runs.low[runs], own.runs.high[runs] + plan.length
            out: dict[int, dict] = {}
            for r, a, b in plan.deal(own.runs.gram[runs]):
                data = b"".join(own.data[x:y].tobytes() for x, y in zip(low[a:b], end[a:b]))
                out[r] = {"size": _squeezed((end - low)[a:b].astype(np.uint16)), "least": _squeezed(least[a:b]),
                          "data": len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)}
            for r, a, b in plan.deal(h1 >> U(16)):
                out.setdefault(r, {}).update(h1=_squeezed(h1[a:b]), h2=_squeezed(h2[a:b]), w_least=_squeezed(w_least[a:b]))
            yield pa.RecordBatch.from_pydict({
                "range": pa.array(list(out), pa.int32()), "batch": pa.array([row["batch"]] * len(out), pa.int64()),
                **{name: pa.array([o.get(name) for o in out.values()], pa.binary()) for name in WINDOW_FIELDS}})

    return run


WINDOW_FIELDS = ["size", "least", "data", "h1", "h2", "w_least"]


def _answer_windows(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = per_process("repeats", lambda: (RollingHash(101), RollingHash(202)))
        for rows in _by_range(batches):
            h1s, h2s, docs, counts = [], [], [], []
            for r in rows:
                n_runs, n_windows = np.empty(0, np.int64), 0
                if r["size"] is not None:
                    size = _unsqueezed(r["size"], np.uint16).astype(np.int64)
                    raw = pa.decompress(r["data"][8:], int.from_bytes(r["data"][:8], "little"), codec="zstd", asbytes=True)
                    data, n_runs = np.frombuffer(raw, np.uint8), size - plan.length + 1
                    start = np.repeat(np.cumsum(size) - size - (np.cumsum(n_runs) - n_runs), n_runs) + np.arange(n_runs.sum())
                    h1s.append(first.spans(first.prefix(data), start, start + plan.length))
                    h2s.append(second.spans(second.prefix(data), start, start + plan.length))
                    docs.append(np.repeat(_unsqueezed(r["least"], np.int64), n_runs))
                if r["h1"] is not None:
                    h1s.append(_unsqueezed(r["h1"], U))
                    h2s.append(_unsqueezed(r["h2"], U))
                    docs.append(_unsqueezed(r["w_least"], np.int64))
                    n_windows = len(docs[-1])
                counts.append((n_runs, n_windows))
            doc = np.concatenate(docs)
            order, group = _groups(np.concatenate(h1s), np.concatenate(h2s))
            least = np.minimum.reduceat(doc[order], np.flatnonzero(np.diff(group, prepend=-1)))
            earlier = np.empty(len(doc), bool)
            earlier[order] = least[group] < doc[order]
            at, masks, flags = 0, [], []
            for n_runs, n_windows in counts:
                bits = np.zeros((len(n_runs), 32), bool)
                bits[np.arange(32) < n_runs[:, None]] = earlier[at:at + n_runs.sum()]
                at += int(n_runs.sum())
                masks.append(_squeezed(np.packbits(bits, axis=1, bitorder="little").view("<u4").reshape(-1)))
                flags.append(_squeezed(earlier[at:at + n_windows].astype(np.uint8)))
                at += n_windows
            yield pa.RecordBatch.from_pydict({
                "batch": pa.array([r["batch"] for r in rows], pa.int64()), "range": pa.array([r["range"] for r in rows], pa.int32()),
                "masks": pa.array(masks, pa.binary()), "flags": pa.array(flags, pa.binary())})

    return run


def _removed(plan: Plan, own: Batch, codes: list[dict] | None, answers: list[dict] | None) -> np.ndarray:
    """True for each byte of the batch that goes."""
    normal, common = own.chosen(plan.gathered(codes, np.uint8, len(own.buckets()), "codes"))
    runs, least, entry = own.entries(normal)
    masks = plan.gathered(answers, "<u4", len(runs), "masks")
    later = own.ids[own.runs.doc[normal]] > least[entry]
    whole, part = normal[later], normal[~later]
    bits = np.unpackbits(masks[entry[~later]].view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    at, offset = np.nonzero(bits)
    h1, _, w_least, start, doc, number = own.windows(common)
    gone = plan.gathered(answers, np.uint8, len(h1), "flags").astype(bool)[number] | (own.ids[doc] > w_least[number])
    starts = np.concatenate([own.runs.low[whole], own.runs.low[part][at] + offset, start[gone]])
    ends = np.concatenate([own.runs.high[whole] + plan.length, own.runs.low[part][at] + offset + plan.length, start[gone] + plan.length])
    return own.cover(starts, ends)


def _finish(plan: Plan, passed: list[str], names: list[str], digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            table, own, texts = plan.batch(row["payload"])
            removed = _removed(plan, own, row["codes"], row["answers"])
            kept, counts, spans = [], [], []
            for text, a, n in zip(texts, own.starts.tolist(), own.sizes.tolist()):
                gone = removed[a:a + n]
                counts.append(int(gone.sum()))
                spans.append(int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()))
                if not digest:
                    gone = _whole_characters(own.data[a:a + n], gone)
                kept.append(own.data[a:a + n][~gone].tobytes() if counts[-1] else text)
            rest = pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()) if digest else \
                pa.array([k.decode() for k in kept], pa.string())
            arrays = [table.column(c).combine_chunks() for c in passed]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(own.sizes), pa.array(counts, pa.int64()), pa.array(spans, pa.int64()), rest],
                [*passed, *names])

    return run


def _whole_characters(data: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """Marks shrunk so that no character is cut: one goes only if all its bytes do."""
    if not gone.any() or (data < 128).all():
        return gone
    number = np.cumsum((data & 0xC0) != 0x80) - 1
    number -= number[0]
    all_gone = np.bincount(number, gone) == np.bincount(number)
    return all_gone[number]


def without_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 50, q: int = 20, digest: bool = False,
    batch_bytes: int = 512 << 10, common: int = 500, names: tuple[str, ...] = ("n_bytes", "n_removed", "n_spans", "kept"),
) -> DataFrame:
    """``docs`` without ``text``, with n_bytes, n_removed, n_spans and ``kept``, or under other ``names``.

    A byte goes if it is covered by a string of ``length`` bytes that also starts in a document with a smaller
    key; all strings are judged on the input, and overlaps count. ``kept`` is the text that is left, where a
    character goes only if all its bytes do, or with ``digest`` the SHA-256 of the bytes that are left.
    Null and empty texts lose nothing and have 0 bytes. Documents with a null key neither lose nor cause
    anything; equal keys are one document to each other. All other columns stay, but those of the four new names;
    empty tables stay empty. ``length - q`` may be 31 at most. A q-gram in more than ``common`` batches is dealt by windows.
    """
    if not 0 < length - q <= 31:
        raise ValueError("q must be smaller than length, by 31 at most")
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = Plan(key, text, length, q, RANGES_PER_TASK * partitions, common)
    table = stored(spark, docs.mapInArrow(_write_batches(batch_bytes), "batch long, payload binary"), "repeats-batches")
    passed = [c for c in docs.columns if c not in (text, *names)]
    schema = T.StructType([docs.schema[c] for c in passed])
    for name in names[:3]:
        schema = schema.add(name, T.LongType())

    def asked(sent: DataFrame) -> DataFrame:
        return sent.repartition(partitions, "range").sortWithinPartitions("range", "batch")

    grams = asked(table.mapInArrow(_send_grams(plan), "range int, batch long, grams binary"))
    codes = grams.mapInArrow(_answer_grams(plan), "batch long, range int, codes binary")
    codes = codes.groupBy("batch").agg(F.collect_list(F.struct("range", "codes")).alias("codes"))
    known = table.join(codes.hint("shuffle_hash"), "batch", "left").withColumn("answers", F.col("codes"))
    sent = asked(known.select("batch", "payload", "answers").mapInArrow(
        _send_windows(plan), "range int, batch long, " + ", ".join(f"{n} binary" for n in WINDOW_FIELDS)))
    answers = sent.mapInArrow(_answer_windows(plan), "batch long, range int, masks binary, flags binary")
    answers = answers.groupBy("batch").agg(F.collect_list(F.struct("range", "masks", "flags")).alias("answers"))
    both = codes.join(answers, "batch", "left")
    last = table.join(both.hint("shuffle_hash"), "batch", "left").select("batch", "payload", "codes", "answers")
    return last.mapInArrow(_finish(plan, passed, list(names), digest), schema.add(names[3], T.StringType()))
