"""SentencePiece encoding and decoding with sampled segmentations: Gumbel top-k without replacement.

The lattice of a text has an edge for every vocabulary piece at every place; characters without a piece become
byte pieces. Piece weights fall with the rank in the vocabulary (1 over rank). Backward sums over the lattice
turn weights into the exact probability of each next piece, so a segmentation is drawn left to right.

Perturbed A-star search: every set of segmentations has a Gumbel variable at its log-probability, and that of a set
is the greatest of its parts. The first segmentation is a plain draw. At each of its places, the alternatives
together get one Gumbel variable, truncated at the value of the path they branch from; the greatest of all waits
at the top of the queue, is split again, and so on. The k segmentations found are distinct and come in the
order of their perturbed values. Given the (k+1)-th value ``kappa``, a segmentation of log-probability ``phi``
was included with probability ``1 - exp(-exp(phi - kappa))``, the inclusion score.

All uniforms are hashes of the row key and the place in the search, so a row's samples never change.

Many texts are searched side by side: one step draws the next piece of every unit of all texts that is not at its
end. Lattices are those of units, which texts share; a worker keeps the ones it has met up to a bound.
"""

from __future__ import annotations

import zlib
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import appended, mixed, per_process, tokenizer_file

SPACE = "▁"
U = np.uint64


class Beginnings(NamedTuple):
    """Beginnings of pieces by the hash of their code points, and one that is none at the end."""
    hashes: np.ndarray  # in order
    piece: np.ndarray  # -1 where it is no piece itself
    weight: np.ndarray
    shift: np.uint64
    slot: np.ndarray  # by the upper bits of a hash, the first with such bits or greater ones
    single: np.ndarray  # by code point, number of a character that begins a piece, from 1

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which hashes are those of a beginning, its number)."""
        at = self.slot[(h >> self.shift).astype(np.int64)]
        less = np.flatnonzero(self.hashes[at] < h)
        while len(less):
            at[less] += 1
            less = less[np.flatnonzero(self.hashes[at[less]] < h[less])]
        hit = np.flatnonzero(self.hashes[at] == h)
        return hit, at[hit]


class Pieces:
    """Vocabulary pieces by length and hash of their code points."""

    def __init__(self, name: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file(name))
        n = self.model.get_piece_size()
        self.text = [self.model.id_to_piece(i) for i in range(n)]
        special = [self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i) or self.model.is_unused(i) for i in range(n)]
        self.byte_ids = {int(self.text[i][3:5], 16): i for i in range(n) if self.model.is_byte(i)}
        ids = [i for i in range(n) if not special[i] and self.text[i]]
        self.longest = max(map(len, (self.text[i] for i in ids)), default=1)
        total = np.log(sum(1 / (r + 1) for r in range(len(ids))))
        self.log_byte = -np.log(len(ids) + 1.0) - total
        self.known = []
        for length in range(1, self.longest + 1):
            own = [(r, i) for r, i in enumerate(ids) if len(self.text[i]) == length]
            codes = np.array([[ord(c) for c in self.text[i]] for _, i in own], U).reshape(-1, length)
            h = np.zeros(len(own), U)
            for k in range(length):
                h = _step(h, codes[:, k])
            order = np.argsort(h)
            self.known.append((h[order], np.array([i for _, i in own], np.int64)[order],
                               np.array([-np.log(r + 1.0) - total for r, _ in own])[order]))

    @cached_property
    def index(self) -> Beginnings:
        """All beginnings of pieces."""
        known = {self.text[i]: (i, w) for _, ids, weights in self.known for i, w in zip(ids.tolist(), weights.tolist())}
        starts = sorted({t[:n] for t in known for n in range(1, len(t) + 1)}, key=len)
        size = np.array([len(t) for t in starts], np.int64)
        codes = np.frombuffer("".join(starts).encode("utf-32-le"), np.uint32).astype(U)
        first, h = np.cumsum(size) - size, np.zeros(len(starts), U)
        for n in range(self.longest):
            own = np.searchsorted(size, n, side="right")
            h[own:] = _step(h[own:], codes[first[own:] + n])
        order = np.argsort(h)
        found = [known.get(starts[n], (-1, 0.0)) for n in order.tolist()]
        shift = 63 - len(starts).bit_length()
        single = np.zeros(0x110000, np.int32)
        single[codes[first[size == 1]].astype(np.int64)] = np.argsort(order)[size == 1] + 1
        return Beginnings(np.r_[h[order], U(2**64 - 1)], np.array([i for i, _ in found] + [-1], np.int64), np.array([w for _, w in found] + [0.0]),
                          U(shift), np.searchsorted(h[order], np.arange(2 ** (64 - shift), dtype=U) << U(shift)), single)

    @cached_property
    def surface(self) -> pa.Array:
        """Bytes of each piece inside a text and, numbered on, at its beginning; null where the model says something else."""
        space, byte = self.model.piece_to_id(SPACE), {i: bytes([b]) for b, i in self.byte_ids.items()}
        inside: list[bytes | None] = [None] * len(self.text)
        begin = inside.copy()
        if space != self.model.unk_id():
            own = [i for i in range(len(self.text)) if i not in byte]
            for i, x, y in zip(own, self.model.decode([[space, i] for i in own]), self.model.decode([[i] for i in own])):
                text = self.text[i].replace(SPACE, " ")
                if x == text and y == text.removeprefix(" ") and not (self.model.is_unknown(i) or self.model.is_control(i) or self.model.is_unused(i)):
                    inside[i], begin[i] = x.encode(), y.encode()
            for i, b in byte.items():
                inside[i] = begin[i] = b
        return pa.array(inside + begin, pa.binary())


def _step(h: np.ndarray, code: np.ndarray) -> np.ndarray:
    return (h ^ code) * U(0x9E3779B97F4A7C15) ^ (h >> U(29))


def _ranges(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, 0 to n - 1) of ranges one after the other."""
    first = np.cumsum(n) - n
    return first, np.arange(n.sum()) - np.repeat(first, n)


class Lattice(NamedTuple):
    """Edges of distinct units, by place, the shortest piece first; the first edge of a place stands for it."""
    start: np.ndarray  # first place of each unit
    cdf: np.ndarray  # cumulative probability at the place
    to: np.ndarray  # next place, -1 at the end of the unit
    log_p: np.ndarray  # of the edge, given its place
    piece: np.ndarray  # id, or -1 - code point for byte pieces
    rank: np.ndarray  # number of the edge at its place
    width: np.ndarray  # edges of the place


def lattice(units: list[str], pieces: Pieces) -> Lattice:
    """Ways are summed for all places at one distance from the end of their unit at once, the longest unit first."""
    known = pieces.index
    codes = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)
    sizes = np.array([len(u) for u in units], np.int64)
    by_size = np.argsort(-sizes, kind="stable")
    end = np.cumsum(sizes)[by_size]
    longest = int(sizes.max(initial=0))
    n_at = np.cumsum(np.bincount(sizes, minlength=longest + 1)[::-1])[::-1][1:]  # units that have a place at each distance
    first_at = np.r_[0, 0, np.cumsum(n_at)]  # by distance, which is 1 at least
    left = np.repeat(np.arange(1, longest + 1), n_at)
    after = np.arange(len(codes)) - np.repeat(np.diff(first_at)[:-1], n_at)  # place of the next character
    after[:n_at[0] if len(codes) else 0] = -1
    codes = codes[end[np.arange(len(codes)) - np.repeat(first_at[1:-1], n_at)] - left].astype(U)  # in the order of places
    found = known.single[codes.astype(np.int64)] - 1
    q = hit = np.flatnonzero(found >= 0)
    piece, log_p = known.piece[found], known.weight[found]  # number -1 is that of no piece
    rest = np.flatnonzero(piece < 0)  # characters without a piece of their own have byte pieces instead
    if len(rest):
        n_bytes = 1 + (codes[rest] > 0x7F) + (codes[rest] > 0x7FF).astype(int) + (codes[rest] > 0xFFFF)
        piece[rest] = -1 - codes[rest].astype(np.int64)
        log_p[rest] = n_bytes * pieces.log_byte
    at, to, ids, weight, width = [], [after], [piece], [log_p], np.ones(len(codes), np.int64)
    p, h = hit, _step(np.zeros(len(hit), U), codes[hit])
    for n in range(2, pieces.longest + 1):
        more = np.searchsorted(p, first_at[min(n, longest + 1)])  # the others end here
        if more == len(p):
            break
        p, q = p[more:], after[q[more:]]
        h = _step(h[more:], codes[q])
        hit, found = known.find(h)
        p, q, h = p[hit], q[hit], h[hit]
        own = np.flatnonzero(known.piece[found] >= 0)
        found = found[own]
        at.append(p[own])
        to.append(after[q[own]])
        ids.append(known.piece[found])
        weight.append(known.weight[found])
        width[at[-1]] += 1
    first = np.r_[0, np.cumsum(width)]
    edge, taken = first[:-1], first[:-1] + 1
    edges = [edge]
    for places in at:
        edge = taken[places]
        edges.append(edge)
        taken[places] = edge + 1
    edge, n_edges = np.concatenate(edges), int(first[-1])
    piece, log_p, next_place = np.empty(n_edges, np.int64), np.empty(n_edges), np.empty(n_edges, np.int64)
    piece[edge], log_p[edge], next_place[edge] = np.concatenate(ids), np.concatenate(weight), np.concatenate(to)
    total = np.zeros(len(codes) + 1)  # log of the summed weight of all ways from a place to its unit's end, which is place -1
    for a, b in zip(first_at[1:-1].tolist(), first_at[2:].tolist()):
        e, f = first[a], first[b]
        value = log_p[e:f]
        value += total[next_place[e:f]]
        begin = first[a:b] - e
        top = np.maximum.reduceat(value, begin)
        total[a:b] = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, width[a:b])), begin))
    log_p -= np.repeat(total[:-1], width)
    # From here on unit by unit, so that a unit's edges lie side by side.
    row = np.empty(len(units), np.int64)
    row[by_size] = np.arange(len(units))
    unit_first, nth = _ranges(sizes)
    place = first_at[np.repeat(sizes, sizes) - nth] + np.repeat(row, sizes)
    width = width[place]
    own = np.r_[0, np.cumsum(width)]
    rank = np.arange(n_edges) - np.repeat(own[:-1], width)
    order = rank + np.repeat(first[place], width)
    moved = np.empty(len(codes) + 1, np.int64)
    moved[place], moved[-1] = own[:-1], -1
    log_p = log_p[order]
    cdf = np.cumsum(np.exp(log_p))
    cdf -= np.repeat(np.r_[0.0, cdf][own[:-1]], width)
    cdf[own[1:] - 1] = 1.0
    return Lattice(own[unit_first], np.minimum(cdf, 1.0), moved[next_place[order]], log_p, piece[order], rank, np.repeat(width, width))


class Met:
    """Lattices of the units met so far, side by side; units without their first mark.

    Up to ``most`` edges are kept. When they are full, those of units that came in several slices stay, half at most.
    """

    def __init__(self, pieces: Pieces, most: int = 1_500_000):
        self.pieces, self.most, self.edges = pieces, most, 0
        self.number: dict[str, int] = {}
        self.uses = np.zeros(most + 1, np.int32)
        i, size = np.int32, most + 1  # memory that is not written is not taken
        self.lat = Lattice(np.zeros(size, i), np.empty(size), np.empty(size, i), np.empty(size), np.empty(size, i), np.empty(size, np.int8), np.empty(size, np.int8))

    def _drop(self) -> None:
        n, least, lat = len(self.number), 2, self.lat
        size, uses = np.diff(lat.start[:n + 1]).astype(np.int64), self.uses[:n]
        while size[uses >= least].sum() > self.most // 2:
            least *= 2
        kept = np.flatnonzero(uses >= least)
        first, edge = _ranges(size[kept])
        back = np.repeat(lat.start[kept] - first, size[kept])
        edge += back + np.repeat(first, size[kept])
        to = lat.to[edge]
        lat.to[:len(edge)] = np.where(to < 0, -1, to - back)
        for own in (lat.cdf, *lat[3:]):
            own[:len(edge)] = own[edge]
        lat.start[:len(kept) + 1] = np.r_[first, len(edge)]
        words = list(self.number)
        self.number = {words[x]: n for n, x in enumerate(kept.tolist())}
        self.uses[:len(kept)] = uses[kept] // 2
        self.uses[len(kept):n] = 0
        self.edges = len(edge)

    def _add(self, words: list[str]) -> bool:
        """Whether there was room for them."""
        for x in range(0, len(words), 4096):
            own = words[x:x + 4096]
            more = lattice([SPACE + w for w in own], self.pieces)
            n, e, f = len(self.number), self.edges, self.edges + len(more.to)
            if f > self.most:
                return False
            self.lat.start[n:n + len(own) + 1] = np.r_[more.start, len(more.to)] + e
            self.lat.to[e:f] = np.where(more.to < 0, -1, more.to + e)
            for kept, new in zip((self.lat.cdf, *self.lat[3:]), (more.cdf, *more[3:])):
                kept[e:f] = new
            self.number.update(zip(own, range(n, n + len(own))))
            self.edges = f
        return True

    def of(self, words: list[str]) -> tuple[Lattice, np.ndarray]:
        """(lattice, number of each word's unit) of the distinct words of a slice."""
        if not self._add([w for w in words if w not in self.number]):
            self._drop()
            if not self._add([w for w in words if w not in self.number]):  # too many for what is kept
                return lattice([SPACE + w for w in words], self.pieces), np.arange(len(words))
        out = np.array([self.number[w] for w in words], np.int64)
        self.uses[out] += 1
        return self.lat, out


def _hashed(h: np.ndarray, *place: np.ndarray | int) -> np.ndarray:
    for p in place:
        h = mixed(h + np.atleast_1d(p).astype(U) * U(0x9E3779B97F4A7C15) + U(0x632BE59BD9B4E019))
    return h


def _unit_interval(h: np.ndarray) -> np.ndarray:
    return ((h >> U(11)).astype(float) + 0.5) / 2.0**53


def uniform(seed: int, *place: np.ndarray | int) -> np.ndarray:
    """Numbers in (0, 1), a function of the seed and the place."""
    return _unit_interval(_hashed(np.array([seed], U), *place))


def truncated(phi: np.ndarray, bound: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel variables at ``phi`` given that they are at most ``bound``."""
    with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
        value = np.exp(phi - bound)
        value -= np.log(u)
        value = phi - np.log(value, out=value)
    value[np.isnan(value)] = -np.inf
    return np.minimum(value, bound, out=value)


def _log1mexp(x: np.ndarray) -> np.ndarray:
    """log(1 - exp(x)) for x <= 0; -inf where nothing is left."""
    with np.errstate(divide="ignore", invalid="ignore"):
        out, near = np.log1p(-np.exp(x)), np.flatnonzero(x > -0.7)
        out[near] = np.where(x[near] > -1e-12, -np.inf, np.log(-np.expm1(x[near])))
        return out


def units_of(text: str) -> list[str]:
    """Runs of a space mark and what follows, of any length and each one lattice; together the normalised text."""
    if not text:
        return []
    out, held = [], ""
    for part in (SPACE + text.replace(" ", SPACE)).split(SPACE)[1:]:
        held += SPACE
        if part:
            out.append(held + part)
            held = ""
    if held:
        out.append(held)
    return out


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(``units_of`` all texts, each without its first mark; number of them in each text)."""
    split = pc.split_pattern(pc.replace_substring(texts, SPACE, " "), " ")
    words, count = split.flatten(), pc.fill_null(pc.list_value_length(split), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    empty = pc.equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    if empty.any():  # a space of several: its mark is held for what follows, at the end of a text those held are a unit
        owner, keep, last = np.repeat(np.arange(len(count)), count), ~empty, np.cumsum(count)[count > 0] - 1
        keep[last] = True
        kept = np.flatnonzero(keep)
        held = np.diff(kept, prepend=-1) - 1
        own = np.flatnonzero((held > 0) | ~empty[kept] | (count[owner[kept]] > 1))  # an empty text has no unit
        kept, held = kept[own], held[own]
        words, count = words.take(pa.array(kept)), np.bincount(owner[kept], minlength=len(count))
        several = np.flatnonzero(held)
        marked = [SPACE * h + words[n].as_py() for n, h in zip(several.tolist(), held[several].tolist())]
        words = pc.replace_with_mask(words, pa.array(held > 0), pa.array(marked, words.type))
    return words, count


class Sample(NamedTuple):
    edges: np.ndarray
    log_prob: float
    value: float  # perturbed log-probability


class Drawn(NamedTuple):
    """One path of each of many texts, from the edge it branched off on."""
    edges: np.ndarray
    first: np.ndarray  # first edge of each unit drawn
    unit: np.ndarray  # place of that unit in its text
    before: np.ndarray  # log-probability up to the edge
    waiting: np.ndarray  # Gumbel values of the alternatives at each edge
    begin: np.ndarray  # by text, its first edge here
    end: np.ndarray
    skipped: np.ndarray  # by text, edges of the path before those


def draw(lat: Lattice, h: np.ndarray, unit: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """(number of edges of each unit, edges by step, units they lie in) of draws from place ``at`` in each unit to its end."""
    h, own = _hashed(h, unit), np.arange(len(at))
    n, edges, owners = np.zeros(len(at), np.int64), [], []
    while len(at):
        u = _unit_interval(_hashed(h, len(edges)))
        less = np.flatnonzero(lat.cdf[at] < u)
        while len(less):
            at[less] += 1
            less = less[np.flatnonzero(lat.cdf[at[less]] < u[less])]
        edges.append(at)
        owners.append(own)
        at = lat.to[at]
        n[own] = len(edges)
        more = np.flatnonzero(at >= 0)
        at, own, h = at[more], own[more], h[more]
    return n, edges, owners


def top_k_each(lat: Lattice, units: np.ndarray, count: np.ndarray, seeds: np.ndarray, k: int) -> tuple[list[list[Sample]], np.ndarray]:
    """Of each of many texts, k distinct segmentations by falling perturbed value; and the value of the next one (kappa).

    ``units`` are those of all texts, ``count`` of them of each. An empty text has one segmentation, without edges.
    """
    samples: list[list[Sample]] = [[] if c else [Sample(np.empty(0, np.int64), 0.0, 0.0)] for c in count.tolist()]
    kappa = np.full(len(count), -np.inf)
    base, live = np.cumsum(count) - count, np.flatnonzero(count)
    value = -np.log(-np.log(_unit_interval(_hashed(seeds[live], 0, 0))))
    paths: list[Drawn] = []
    best, where = [], []  # by path and text, the greatest value that waits, and its edge
    tried: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # by branch and text: path, edge of the path, edge taken instead
    pick = j = unit = e = before_j = np.zeros(len(live), np.int64)
    place = np.full(len(live), -1)
    while len(live):
        head = int(bool(paths))  # paths but the first begin with the edge taken instead
        h = _hashed(seeds[live], len(paths) + 1)
        unit = unit + (place < 0) * head
        n = count[live] - unit
        first, own = _ranges(n)
        own += np.repeat(unit, n)
        at = lat.start[units[own + np.repeat(base[live], n)]]
        at[first[place >= 0]] = place[place >= 0]
        size, drawn, owners = draw(lat, np.repeat(h, n), own, at)
        offset = np.cumsum(size) - size + np.repeat(np.arange(1, len(live) + 1) * head, n)
        end = np.cumsum(np.bincount(np.repeat(np.arange(len(live)), n), size, len(live)).astype(np.int64) + head)
        begin = np.r_[0, end[:-1]]
        edges = np.empty(end[-1], np.int64)
        for step, (d, o) in enumerate(zip(drawn, owners)):
            edges[offset[o] + step] = d
        if head:
            edges[begin] = e
        log_p = lat.log_p[edges]
        other = _log1mexp(log_p)
        log_p[begin] += before_j
        total = np.empty(len(edges))
        spans = list(zip(begin.tolist(), end.tolist()))
        for a, b in spans:
            np.cumsum(log_p[a:b], out=total[a:b])
        before = np.r_[0.0, total[:-1]]
        before[begin] = before_j
        size = end - begin
        position = np.arange(len(edges)) + np.repeat(j - begin, size)
        u = _unit_interval(_hashed(np.repeat(h, size), position, 7))
        waiting = truncated(before + other, np.repeat(value, size), u)
        if head:
            waiting[begin] = -np.inf  # those places are waiting in the path it branched from
        by_text = np.zeros((3, len(count)), np.int64)
        by_text[:, live] = begin, end, j
        paths.append(Drawn(edges, offset, own, before, waiting, *by_text))
        for t, (a, b), v, q, m in zip(live.tolist(), spans, value.tolist(), pick.tolist(), j.tolist()):
            whole = np.concatenate((samples[t][q].edges[:m], edges[a:b])) if head else edges[a:b]
            samples[t].append(Sample(whole, float(total[b - 1]), v))
        best.append(np.full(len(count), -np.inf))
        where.append(np.zeros(len(count), np.int64))
        where[-1][live] = [a + int(waiting[a:b].argmax()) for a, b in spans]
        best[-1][live] = waiting[where[-1][live]]

        values = np.array([x[live] for x in best])
        pick = len(paths) - 1 - values[::-1].argmax(axis=0)
        value = values[pick, np.arange(len(live))]
        kappa[live] = value
        if len(paths) == k:
            break
        more = np.flatnonzero(value > -np.inf)
        live, pick, value = live[more], pick[more], value[more]
        i = np.array([x[live] for x in where])[pick, np.arange(len(live))]
        e, unit, j, before_j = (np.zeros(len(live), kind) for kind in (np.int64, np.int64, np.int64, float))
        chosen = [(paths[q], np.flatnonzero(pick == q)) for q in np.unique(pick).tolist()]
        for path, m in chosen:
            e[m], before_j[m], j[m] = path.edges[i[m]], path.before[i[m]], i[m] - path.begin[live[m]] + path.skipped[live[m]]
            unit[m] = path.unit[np.searchsorted(path.first, i[m], side="right") - 1]
        if not len(live):
            break
        a = e - lat.rank[e]
        b = a + lat.width[e]
        row, edge = np.arange(len(live)), a[:, None] + np.arange((b - a).max())
        p = np.where(edge < b[:, None], np.exp(lat.log_p[np.minimum(edge, b[:, None] - 1)]), 0.0)
        p[row, e - a] = 0
        for path, at, gone in tried:
            m = np.flatnonzero((path[live] == pick) & (at[live] == i))
            p[m, gone[live[m]] - a[m]] = 0
        h = _hashed(seeds[live], len(paths) + 1)
        goal = _unit_interval(_hashed(h, j, 3)) * p.sum(axis=1)
        found = np.minimum((np.cumsum(p, axis=1) < goal[:, None]).sum(axis=1), b - a - 1)
        while len(m := np.flatnonzero((found > 0) & (p[row, found] == 0))):
            found[m] -= 1
        p[row, found] = 0
        e = a + found
        # What is still untried at this place waits below the value just used.
        left = p.sum(axis=1)
        phi = before_j + np.where(left > 1e-15, np.log(np.maximum(left, 1e-300)), -np.inf)
        rest = truncated(phi, value, _unit_interval(_hashed(h, j, 5)))
        for path, m in chosen:
            path.waiting[i[m]] = rest[m]
        for t, q in zip(live.tolist(), pick.tolist()):
            x = int(paths[q].begin[t])
            where[q][t] = x + int(paths[q].waiting[x:int(paths[q].end[t])].argmax())
            best[q][t] = paths[q].waiting[where[q][t]]
        by_text = np.full((3, len(count)), -1)
        by_text[:, live] = pick, i, e
        tried.append(tuple(by_text))
        place = lat.to[e]
    return samples, kappa


def top_k(lat: Lattice, units: np.ndarray, seed: int, k: int) -> tuple[list[Sample], float]:
    """k distinct segmentations of a text by falling perturbed value, and the value of the next one (kappa)."""
    [samples], kappa = top_k_each(lat, units, np.array([len(units)]), np.array([seed], U), k)
    return samples, float(kappa[0])


def spelled(ids: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``ids`` with the byte pieces of characters; where those characters were, and by how many ids each one grew."""
    own = np.flatnonzero(ids < 0)
    if not len(own):
        return ids, own, own
    chars, where = np.unique(ids[own], return_inverse=True)
    parts = [[pieces.byte_ids[b] for b in chr(-1 - c).encode()] for c in chars.tolist()]
    more = np.array([len(p) - 1 for p in parts], np.int64)[where]
    size = np.ones(len(ids), np.int64)
    size[own] += more
    out, first = np.repeat(ids, size), own + np.cumsum(more) - more
    for k in range(max(map(len, parts))):
        one = np.array([p[k] if k < len(p) else -1 for p in parts], np.int64)[where]
        out[first[one >= 0] + k] = one[one >= 0]
    return out, own, more


def ids_of(lat: Lattice, edges: np.ndarray, pieces: Pieces) -> np.ndarray:
    return spelled(lat.piece[edges], pieces)[0]


class Segmented(NamedTuple):
    """Samples of texts, one after the other."""
    n: np.ndarray  # samples of each text
    log_prob: np.ndarray
    value: np.ndarray
    inclusion: np.ndarray
    first: np.ndarray  # first id of each sample, and one more
    ids: np.ndarray


def segmented_flat(texts: pa.Array, seeds: np.ndarray, k: int, met: Met) -> Segmented:
    """Samples of all texts."""
    words, count = words_of(texts)
    distinct = words.dictionary_encode()
    lat, number = met.of(distinct.dictionary.to_pylist())
    found, kappa = top_k_each(lat, number[distinct.indices.to_numpy(zero_copy_only=False)], count, seeds, k)
    n = np.array([len(own) for own in found], np.int64)
    every = [s for own in found for s in own]
    log_prob, value = np.array([s.log_prob for s in every]), np.array([s.value for s in every])
    below = np.repeat(kappa, n)
    with np.errstate(invalid="ignore"):
        inclusion = np.where(below > -np.inf, -np.expm1(-np.exp(np.minimum(log_prob - below, 50))), 1.0)
    size = np.array([len(s.edges) for s in every], np.int64)
    edges = np.concatenate([np.empty(0, np.int64), *(s.edges for s in every)])
    first = np.r_[0, np.cumsum(size)]
    ids, own, more = spelled(lat.piece[edges], met.pieces)
    first += np.r_[0, np.cumsum(more)][np.searchsorted(own, first)]
    return Segmented(n, log_prob, value, inclusion, first, ids)


def segmented(texts: list[str | None], seeds: list[int], k: int, pieces: Pieces) -> list[list[tuple]]:
    """Per text: (rank, log_prob, perturbed, inclusion, ids) of each sample."""
    s = segmented_flat(pa.array(texts, pa.string()), np.array(seeds, U), k, Met(pieces))
    last = np.cumsum(s.n)
    return [[(r + 1, float(s.log_prob[x]), float(s.value[x]), float(s.inclusion[x]), s.ids[s.first[x]:s.first[x + 1]]) for r, x in enumerate(range(b - c, b))]
            for b, c in zip(last.tolist(), s.n.tolist())]


def _pieces(name: str) -> Pieces:
    return per_process(("pieces", name), lambda: Pieces(name))


def sample_segmentations(
    rows: DataFrame, key: list[str], text: str = "text", k: int = 4, tokenizer_name: str = "piece_bpe_32k.model", seed: int = 0, digest: bool = False,
) -> DataFrame:
    """``rows`` with ``samples``: up to k distinct segmentations, each (rank, log_prob, perturbed, inclusion, ids).

    With ``digest``, ids come with their number and CRC-32 (little-endian 32-bit ids). Equal keys give
    equal uniforms, so repeated rows get equal samples; null keys count as a value of their own. Null and empty
    texts have one segmentation, the empty one, with inclusion 1. A text with fewer than k segmentations gives all of
    them. A column of the name ``samples`` is replaced, others stay; empty tables stay empty.
    """
    place = pa.struct([("rank", pa.int32()), ("log_prob", pa.float64()), ("perturbed", pa.float64()), ("inclusion", pa.float64()),
                       ("ids", pa.list_(pa.int32())), *([("n_pieces", pa.int64()), ("ids_crc32", pa.int64())] if digest else [])])
    last = "ids:array<int>" + ",n_pieces:bigint,ids_crc32:bigint" * digest

    held: list[Met] = []  # of one task, whose copy of this list it is

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        if not held:
            held.append(Met(_pieces(tokenizer_name)))
        seeds = batch.column("__seed").to_numpy(zero_copy_only=False).astype(np.int64).view(U)
        s = segmented_flat(batch.column(text), seeds, k, held[0])
        last = np.cumsum(s.n)
        ids = s.ids.astype("<i4")
        rank = np.arange(1, len(s.log_prob) + 1) - np.repeat(last - s.n, s.n)
        fields = [pa.array(rank.astype(np.int32)), pa.array(s.log_prob), pa.array(s.value), pa.array(s.inclusion),
                  pa.ListArray.from_arrays(pa.array(s.first.astype(np.int32)), pa.array(ids.astype(np.int32, copy=False)))]
        if digest:
            spans, data = s.first.tolist(), memoryview(ids)
            fields += [pa.array(np.diff(s.first)), pa.array([zlib.crc32(data[a:b]) for a, b in zip(spans, spans[1:])], pa.int64())]
        return [pa.ListArray.from_arrays(pa.array(np.r_[0, last].astype(np.int32)), pa.StructArray.from_arrays(fields, fields=list(place)))]

    seeded = rows.withColumn("__seed", F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in key]))
    return appended(seeded, f"samples array<struct<rank:int,log_prob:double,perturbed:double,inclusion:double,{last}>>", compute, most=1 << 17).drop("__seed")


def decoded(column: pa.Array, pieces: Pieces) -> pa.Array:
    """Texts of lists of ids. Rows of plain pieces are joined from their bytes, others decoded by the model one by one."""
    given, n = column.is_valid(), len(pieces.text)
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    first = np.r_[0, np.cumsum(size, dtype=np.int64)]
    ids = pc.fill_null(column.flatten(), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    other = np.flatnonzero((ids < 0) | (ids >= n))
    ids[first[:-1][size > 0]] += n  # pieces at the beginning
    ids[other] = 0
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pieces.surface.take(pa.array(ids))), b"")
    each = joined.is_null().to_numpy(zero_copy_only=False).copy()  # rows for the model
    each[np.searchsorted(first, other, side="right") - 1] = True
    try:
        text = joined.cast(pa.string())
    except pa.ArrowInvalid:  # byte pieces that are no characters
        for row in np.flatnonzero(~each).tolist():
            try:
                joined[row].as_py().decode()
            except UnicodeDecodeError:
                each[row] = True
        text = pc.if_else(pa.array(each), pa.scalar(None, pa.binary()), joined).cast(pa.string())
    each &= given.to_numpy(zero_copy_only=False)
    if each.any():
        said = [pieces.model.decode(column[row].as_py()) for row in np.flatnonzero(each).tolist()]
        text = pc.replace_with_mask(text, pa.array(each), pa.array(said, pa.string()))
    return pc.if_else(given, text, pa.scalar(None, pa.string())) if column.null_count else text


def decode(rows: DataFrame, ids: str = "ids", tokenizer_name: str = "piece_bpe_32k.model") -> DataFrame:
    """``rows`` with ``decoded``: the text of a column of ids; null ids give null."""
    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        column = batch.column(ids)
        block = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64) >> 17
        cuts = np.r_[0, np.flatnonzero(np.diff(block)) + 1, len(column)]  # of about 2^17 ids, one row at least
        return [pa.concat_arrays([decoded(column.slice(a, b - a), _pieces(tokenizer_name)) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())])]

    return appended(rows, "decoded string", compute)
