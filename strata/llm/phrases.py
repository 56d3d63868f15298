"""Removal of repeated word sequences with automata over recurring passages.

Every window of ``length`` words is represented by its anchor, the run of ``q`` words in it with the smallest hash
(leftmost among equals), so equal windows have equal anchors, and neighbouring windows mostly share one.

1. Candidates. A document sends its distinct anchors. Only those that several documents have can lie in a repeated
   window; the others end here. Anchors with more than ``hot`` occurrences are told apart.
2. Confirmation. Documents send, for each recurring anchor, the passage that its windows cover. A task takes anchors
   until it holds about ``shard_words`` words, counts the windows of their passages, and keeps those that recur.
3. Automata. The recurring windows of such a shard are compiled into one Aho-Corasick automaton over word numbers, and
   all passages of the shard stream through it. A hit is an exact occurrence; the first document of each window is
   the smallest key among its hits, and every hit in another document is a window to remove.
4. The answers go back to the documents, where repeats inside one document are found as well, and covered words go.

Hot anchors gather nowhere. Each of their windows travels alone, by two 64-bit hashes of its own, and only the smallest
key per slice of documents is sent; all others of the slice are decided on the spot, as are repeated whole passages.
A task reads such a window's keys in ascending order and keeps the first one in mind only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import RollingHash, frames, mixed, per_process, texts_of

U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
BASES = (U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F))
CHUNK = 1 << 20  # bytes whose word hashes are computed at once


class Plan(NamedTuple):
    """What all tasks need to know."""
    length: int
    q: int
    hot: int
    shard_words: int


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Two independent 64-bit hashes of each word, chunk by chunk."""
    made = per_process("phrases", lambda: (RollingHash(303), RollingHash(404)))
    out = [np.empty(len(start), U) for _ in made]
    at = 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(end, start[at] + CHUNK, side="right")))
        low = start[at]
        part = data[low:end[to - 1]]
        for rolling, hashes in zip(made, out):
            hashes[at:to] = rolling.spans(rolling.prefix(part), start[at:to] - low, end[at:to] - low)
        at = to
    return out


def rolled(codes: np.ndarray, length: int, base: np.uint64) -> np.ndarray:
    """Hashes of all runs of ``length`` numbers: a polynomial in ``base``, put together from runs of 1, 2, 4, ..."""
    n = max(len(codes) - length + 1, 0)
    out, at, m, block, power = np.zeros(n, U), 0, 1, codes, base
    while n:
        if length & m:
            out = out * power + block[at:at + n]
            at += m
        if 2 * m > length:
            break
        block, m, power = block[:-m] * power + block[m:], 2 * m, U(int(power) ** 2 % 2**64)
    return mixed(out)


def smallest(h: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest of ``width`` neighbours, leftmost if equal, for each place where they fit."""
    best, at, step = h, np.arange(len(h)), 1
    while step < width:
        by = min(step, width - step)
        right = best[by:] < best[:-by]
        best, at, step = np.where(right, best[by:], best[:-by]), np.where(right, at[by:], at[:-by]), step + by
    return at


class Runs(NamedTuple):
    """Runs of neighbouring windows with one anchor: first and last start, document and the anchor's hash."""
    low: np.ndarray
    high: np.ndarray
    doc: np.ndarray
    anchor: np.ndarray


class Slice:
    """The words of some documents: where they lie, their hashes, and the windows that lie in one document."""

    def __init__(self, texts: list[bytes], plan: Plan):
        self.plan = plan
        self.data = b"\n".join(texts)
        data = np.frombuffer(self.data, np.uint8)
        gap = np.r_[True, SPACE[data], True]
        change = np.flatnonzero(gap[1:] != gap[:-1])
        self.start, self.end = change[0::2], change[1::2]
        bounds = np.cumsum([len(t) + 1 for t in texts])
        self.doc = np.searchsorted(bounds, self.start, side="right")
        self.n_words = np.bincount(self.doc, minlength=len(texts))
        self.first = np.cumsum(self.n_words) - self.n_words
        self.codes = _hashes(data, self.start, self.end)
        reach = self.first + self.n_words - plan.length
        self.windows = np.flatnonzero(np.arange(len(self.doc)) <= reach[self.doc])
        self.h1, self.h2 = (rolled(c, plan.length, b) for c, b in zip(self.codes, BASES))

    def passage(self, low: int, high: int) -> bytes:
        """The words that the windows ``low`` to ``high`` cover, joined by one space."""
        return b" ".join(self.data[self.start[low]:self.end[high + self.plan.length - 1]].split())

    def runs(self) -> Runs:
        w = self.windows
        if not len(w):
            return Runs(w, w, w, w.astype(U))
        grams = rolled(self.codes[0], self.plan.q, BASES[0])
        at = smallest(grams, self.plan.length - self.plan.q + 1)[w]
        cut = np.flatnonzero((np.diff(at) != 0) | (np.diff(w) != 1)) + 1
        low, high = w[np.r_[0, cut]], w[np.r_[cut - 1, len(w) - 1]]
        return Runs(low, high, self.doc[low], grams[at[np.r_[0, cut]]])

    def contents(self, runs: Runs) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of what each run covers, by its first and last window and its length."""
        far = (runs.high - runs.low).astype(U)
        return tuple(mixed(h[runs.low] * BASES[1] + h[runs.high] + far) for h in (self.h1, self.h2))


def equal_groups(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts equal pairs (a, b) together, earlier places first, and the group of each place in it."""
    order = np.argsort(a, kind="stable")
    x, y = a[order], b[order]
    if ((x[1:] == x[:-1]) & (y[1:] != y[:-1])).any():
        order = np.lexsort((b, a))
        x, y = a[order], b[order]
    new = np.ones(len(order), bool)
    new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    return order, np.cumsum(new) - 1


def first_of_equals(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each place the first place with the same pair."""
    order, group = equal_groups(a, b)
    heads = order[np.flatnonzero(np.diff(group, prepend=-1))]
    out = np.empty(len(order), np.int64)
    out[order] = heads[group]
    return out


def _longs(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64) if a.dtype == U else a.astype(np.int64))


def _send_anchors(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames(batches, CHUNK):
            runs = Slice(texts_of(batch.column("text")), plan).runs()
            order, group = equal_groups(runs.anchor, runs.doc.astype(U))
            head = order[np.flatnonzero(np.diff(group, prepend=-1))]
            own = pa.array(runs.doc[head])
            yield pa.RecordBatch.from_arrays(
                [_longs(runs.anchor[head]), batch.column("k").take(own), batch.column("th").take(own),
                 pa.array(np.bincount(group, minlength=len(head)), pa.int64())], ["anchor", "k", "th", "n"])

    return run


SENT = "anchor long, other long, k long, th long, at int, mask long, passage binary"


def _send_passages(plan: Plan):
    """Passages (with ``passage``), windows of hot anchors (with ``other``) and decided runs (with ``mask``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames(batches, CHUNK):
            batch = batch.filter(batch.column("normal").is_valid())
            if not batch.num_rows:
                continue
            own = Slice(texts_of(batch.column("text")), plan)
            runs = own.runs()
            keys, same_text = (np.array(batch.column(c).to_pylist(), np.int64) for c in ("k", "th"))
            wanted = [np.zeros(len(runs.doc), bool), np.zeros(len(runs.doc), bool)]
            ends = np.searchsorted(runs.doc, np.arange(len(keys) + 1))
            for name, found in zip(("normal", "hot"), wanted):
                for d, anchors in enumerate(batch.column(name)):
                    if anchors.is_valid and len(anchors):
                        its = anchors.values.to_numpy().view(U)
                        found[ends[d]:ends[d + 1]] = np.isin(runs.anchor[ends[d]:ends[d + 1]], its)
            at_anchor, at_other, at_doc, at_low, at_mask, at_text = ([] for _ in range(6))

            def add(anchor, other, doc, low, mask, text):
                for held, new in zip((at_anchor, at_other, at_doc, at_low, at_mask, at_text), (anchor, other, doc, low, mask, text)):
                    held.append(new)

            def decide(a, b, doc, low, mask):
                """Places to send: of equal contents the smallest key, and there the first place. A later place in
                the same document is found there at the end; a larger key's is decided here."""
                order = np.lexsort((low, keys[doc]))
                first = order[first_of_equals(a[order], b[order])]
                larger = keys[doc[order]] > keys[doc[first]]
                later, peers = order[larger], (order == first) | ~larger & (same_text[doc[order]] != same_text[doc[first]])
                spread = mixed(low[later].astype(U) + keys[doc[later]].astype(U) * BASES[0])
                add(spread, None, doc[later], low[later], mask[later], None)
                return order[peers]

            picked = np.flatnonzero(wanted[0])
            part = Runs(*[x[picked] for x in runs])
            n = part.high - part.low + 1
            head = decide(*own.contents(part), part.doc, part.low, (np.int64(1) << n) - 1)
            add(part.anchor[head], None, part.doc[head], part.low[head], None, [own.passage(a, b) for a, b in zip(part.low[head].tolist(), part.high[head].tolist())])

            picked = np.flatnonzero(wanted[1])
            n = runs.high[picked] - runs.low[picked] + 1
            w = np.repeat(runs.low[picked] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            head = decide(own.h1[w], own.h2[w], own.doc[w], w, np.ones(len(w), np.int64))
            add(own.h1[w[head]], own.h2[w[head]], own.doc[w[head]], w[head], None, None)

            sizes = [len(d) for d in at_doc]
            doc = np.concatenate(at_doc)

            def column(parts, kind):
                return pa.chunked_array([pa.nulls(m, kind) if p is None else pa.array(p, kind) if isinstance(p, list) else _longs(p) for p, m in zip(parts, sizes)], kind).combine_chunks()

            take = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [column(at_anchor, pa.int64()), column(at_other, pa.int64()), batch.column("k").take(take), batch.column("th").take(take),
                 pa.array((np.concatenate(at_low) - own.first[doc]).astype(np.int32)), column(at_mask, pa.int64()), column(at_text, pa.binary())],
                ["anchor", "other", "k", "th", "at", "mask", "passage"])

    return run


class Shard:
    """The passages of some anchors: confirms recurring windows, compiles them and finds all occurrences."""

    def __init__(self, plan: Plan):
        self.plan, self.words, self.n_words = plan, {}, 0
        self.rows: list[tuple[int, int, int]] = []
        self.numbers: list[tuple[int, ...]] = []

    def add(self, k: int, th: int, at: int, passage: bytes) -> None:
        found = tuple([self.words.setdefault(w, len(self.words)) for w in passage.split()])
        self.rows.append((k, th, at))
        self.numbers.append(found)
        self.n_words += len(found)

    def confirmed(self) -> list[tuple[int, ...]]:
        """One copy of each window that occurs more than once, and perhaps others whose hash does."""
        length = self.plan.length
        flat = np.fromiter((n for p in self.numbers for n in p), U, self.n_words)
        sizes = np.array([len(p) for p in self.numbers])
        ends = np.cumsum(sizes)
        inside = np.ones(self.n_words, bool)
        for back in range(1, length):
            inside[ends - back] = False
        start = np.flatnonzero(inside)
        h = rolled(mixed(flat + U(1)), length, BASES[0])[start]
        _, first, count = np.unique(h, return_index=True, return_counts=True)
        start = start[first[count > 1]]
        row = np.searchsorted(ends, start, side="right")
        offset = start - (ends - sizes)[row]
        return [self.numbers[r][o:o + length] for r, o in zip(row.tolist(), offset.tolist())]

    def answers(self) -> pa.RecordBatch:
        """(k, th, at, mask) of the passages with a window that a smaller key has too."""
        import ahocorasick

        patterns = self.confirmed()
        automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for number, pattern in enumerate(patterns):
            automaton.add_word(pattern, number)
        hits: list[tuple[int, int, int]] = []
        least = [2**63] * len(patterns)
        if patterns:
            automaton.make_automaton()
            for row, passage in enumerate(self.numbers):
                k = self.rows[row][0]
                for end, number in automaton.iter(passage):
                    hits.append((row, end - self.plan.length + 1, number))
                    if k < least[number]:
                        least[number] = k
        masks: dict[int, int] = {}
        for row, offset, number in hits:
            if self.rows[row][0] > least[number]:
                masks[row] = masks.get(row, 0) | 1 << offset
        return answer_batch([(*self.rows[r], m) for r, m in masks.items()])


def answer_batch(rows: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    k, th, at, mask = zip(*rows) if rows else ((),) * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(k, pa.int64()), pa.array(th, pa.int64()), pa.array(at, pa.int32()), pa.array(mask, pa.int64())], ["k", "th", "at", "mask"])


def _answer(plan: Plan):
    """Rows sorted by (anchor, other, k): answers of whole shards, and of hot windows one by one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, last, window, least = Shard(plan), None, None, 0
        for batch in frames(batches, CHUNK):
            ready: list[tuple[int, int, int, int]] = []
            for anchor, other, k, th, at, mask, passage in zip(*[c.to_pylist() for c in batch.columns]):
                if mask is not None:
                    ready.append((k, th, at, mask))
                elif other is not None:
                    if (anchor, other) != window:
                        window, least = (anchor, other), k
                    elif k > least:
                        ready.append((k, th, at, 1))
                else:
                    if anchor != last and shard.n_words >= plan.shard_words:
                        yield shard.answers()
                        shard = Shard(plan)
                    last = anchor
                    shard.add(k, th, at, passage)
            if ready:
                yield answer_batch(ready)
        if shard.rows:
            yield shard.answers()

    return run


def _covered(own: Slice, marked: np.ndarray) -> np.ndarray:
    """True for each word inside a marked window."""
    change = np.zeros(len(own.doc) + 1, np.int32)
    at = np.flatnonzero(marked)
    change[at] += 1
    np.subtract.at(change, at + own.plan.length, 1)
    return np.cumsum(change[:-1]) > 0


def _finish(plan: Plan, names: list[str], digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames(batches, CHUNK):
            own = Slice(texts_of(batch.column("text")), plan)
            marked = np.zeros(len(own.doc), bool)
            w = own.windows
            if len(w):  # repeats inside a document
                each = mixed(own.doc[w].astype(U) * BASES[1])
                marked[w] = first_of_equals(own.h1[w] ^ each, own.h2[w] ^ each) != np.arange(len(w))
            for d, found in enumerate(batch.column("found")):
                if found.is_valid:
                    for at, mask in zip(*(found.values.field(f).to_numpy().tolist() for f in ("at", "mask"))):
                        low = own.first[d] + at
                        bits = [i for i in range(plan.length) if mask >> i & 1]
                        marked[low + np.array(bits)] = True
            gone = _covered(own, marked)
            removed = np.bincount(own.doc[gone], minlength=batch.num_rows)
            kept = []
            for d, (a, n) in enumerate(zip(own.first.tolist(), own.n_words.tolist())):
                words = own.data[own.start[a]:own.end[a + n - 1]].split() if n else []
                if removed[d]:
                    words = [x for x, g in zip(words, gone[a:a + n].tolist()) if not g]
                kept.append(b" ".join(words))
            rest = pa.array([hashlib.sha256(x).hexdigest() for x in kept]) if digest else pa.array(kept, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), _longs(own.n_words), _longs(removed), rest], ["row", *names])

    return run


def without_repeated_phrases(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 20, q: int = 8, digest: bool = False,
    hot: int = 1000, shard_words: int = 100_000, names: tuple[str, str, str] = ("n_words", "n_removed", "kept"),
) -> DataFrame:
    """``docs`` without ``text``, with n_words, n_removed and ``kept``, or under other ``names``.

    A word goes if it is covered by a window of ``length`` words whose sequence also starts earlier: in a document
    with a smaller key, or before it in the same document. Windows are judged on the input, so overlaps count and
    nothing depends on what is left. Words are runs without 0x20 and 0x09-0x0D, compared byte by byte. ``kept`` is the
    words left, joined by one space, or with ``digest`` the SHA-256 of that.

    Null and empty texts have 0 words and stay. Rows with equal keys are no earlier than each other, so repeated rows
    lose the same words. A row with a null key loses only what repeats inside it, and no other row loses anything because
    of it. All other columns stay, but those of the three new names; empty tables stay empty. ``length`` may be
    62 at most, and ``q`` smaller.
    """
    if not 0 < q < length <= 62:
        raise ValueError("q must be smaller than length, and length 62 at most")
    plan = Plan(length, q, hot, shard_words)
    passed = [c for c in docs.columns if c not in (text, *names)]
    rows = docs.select(
        F.col(f"`{key}`").cast("long").alias("k"), F.xxhash64(F.col(f"`{text}`")).alias("th"), F.col(f"`{text}`").cast("string").alias("text"),
        F.struct(F.lit(0).alias("__"), *[F.col(f"`{c}`") for c in passed]).alias("row"))
    known = rows.where("k IS NOT NULL AND text IS NOT NULL")

    # One row per document and anchor, in one shuffle: the window spills, so a common anchor costs its task rows only.
    anchors = known.select("k", "th", "text").mapInArrow(_send_anchors(plan), "anchor long, k long, th long, n long")
    same = Window.partitionBy("anchor")
    shared = anchors.withColumns({"docs": F.count(F.lit(1)).over(same), "n": F.sum("n").over(same)}).where("docs > 1")
    lists = shared.groupBy("k", "th").agg(
        F.collect_list(F.when(F.col("n") <= hot, F.col("anchor"))).alias("normal"),
        F.collect_list(F.when(F.col("n") > hot, F.col("anchor"))).alias("hot"))
    # Left, and with all columns, so that both joins of the documents use one shuffle of them.
    asked = rows.join(lists.hint("shuffle_hash"), ["k", "th"], "left").select("row", "k", "th", "text", "normal", "hot")
    sent = asked.mapInArrow(_send_passages(plan), SENT).repartition("anchor").sortWithinPartitions("anchor", "other", "k")
    answers = sent.mapInArrow(_answer(plan), "k long, th long, at int, mask long")
    found = answers.groupBy("k", "th").agg(F.collect_list(F.struct("at", "mask")).alias("found"))
    last = rows.join(found.hint("shuffle_hash"), ["k", "th"], "left").select("row", "text", "found")
    schema = T.StructType([last.schema["row"]])
    for name in names[:2]:
        schema = schema.add(name, T.LongType())
    out = last.mapInArrow(_finish(plan, list(names), digest), schema.add(names[2], T.StringType()))
    return out.select(*[F.col(f"row.`{c}`") for c in passed], *names)
