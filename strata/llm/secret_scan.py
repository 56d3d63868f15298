"""Secret scans: base patterns, and literals found by lexing assignments and propagating constants.

Source and configuration syntax is read as pairs of a name and a literal: ``name = "x"``, ``name: x``,
``name := x``, ``"name" => x``, ``section["name"] = x``. A value that is itself a name takes the literal
assigned to that name (last before it, else first after it), through any chain of assignments in the same text.
Each literal is scored by the words of its target names: sensitive words raise, harmless words lower the score, and
placeholders score nothing. An unquoted value takes the whole run of characters it begins; operators inside that run are
read too, with values that end at the next ``=`` (but for padding), ``&`` or, after a colon, ``:``. Every character is
read a bounded number of times, so time is linear in a text, whatever it holds. Plain words, digits alone and several words count only under strongly sensitive names. Literals at or above the threshold become spans of kind ``lexed`` unless a base span holds them.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import appended

KINDS = ["assign", "access", "hex", "lexed"]
WORDS = ["password", "passwd", "secret", "token", "api"]  # every match of the first pattern holds one of these
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")

OPERATOR = re.compile(r":=|=>|=|:")
BACKWARDS = re.compile(r"""\n?[ \t]*(?:(["'])([\w.\- ]+)\1|((?:\]["']?[\w.\-]+["']?\[)*[\w.\-]*[A-Za-z_]))""")  # a name, last character first
VALUE = re.compile(r"""[ \t]*(?:"((?:[^"\\\n]|\\.)*)"|'((?:[^'\\\n]|\\.)*)'|`([^`\n]*)`|["'`]?([^\s"'`,;(){}\[\]<>]+))""")
INNER = {c: re.compile(rf"""[ \t]*([^\s"'`,;(){{}}\[\]<>&={c}]+(?:==?(?![^\s"'`,;(){{}}\[\]<>&]))?)""") for c in ("", ":")}
PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
IDENTIFIER = re.compile(r"[A-Za-z_][\w.\-]*")
PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|\.+|-+|_+|change_?me.*|example.*|your[_-].*|none|null|true|false|undefined|todo.*|redacted.*|\$\{[^{}]*\}|\$\(?(?-i:[A-Z_][A-Z0-9_]*)\)?|%\(\w+\)s?|%(?-i:[A-Z_][A-Z0-9_]*)%?|<.*>|\{\{.*\}\})$")

# Sensitivity of the words of a target name.
SENSITIVE = {"password": 1.0, "passwd": 1.0, "pwd": 1.0, "pass": 0.7, "passphrase": 1.0, "secret": 1.0, "token": 0.9,
             "apikey": 1.0, "credential": 1.0, "credentials": 1.0, "auth": 0.75, "bearer": 0.8, "privatekey": 1.0,
             "accesskey": 1.0, "signature": 0.75, "salt": 0.75, "pin": 0.75, "webhook": 0.75, "dsn": 1.0}
PAIRS = {("api", "key"): 1.0, ("private", "key"): 1.0, ("access", "key"): 1.0, ("secret", "key"): 1.0,
         ("signing", "key"): 0.9, ("encryption", "key"): 1.0, ("client", "secret"): 1.0, ("connection", "string"): 1.0}
HARMLESS = {"public": 0.3, "example": 0.3, "path": 0.4, "file": 0.4, "url": 0.5, "name": 0.4, "length": 0.2, "count": 0.2,
            "type": 0.3, "expiry": 0.2, "hint": 0.2, "field": 0.3, "label": 0.3, "limit": 0.2, "max": 0.3, "min": 0.3}


STRONG = 0.8  # from this weight on, a name accepts literals of one kind of character or of several words
PIN = re.compile(r"[0-9]{4,12}")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    value_start: int  # where the secret itself begins
    score: float


def base_spans(text: str) -> list[Span]:
    found = []
    lower = text.lower()
    if any(w in lower for w in WORDS):
        found += [Span("assign", m.start(), m.end(), m.start(2), 1.0) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [Span("access", m.start(), m.end(), m.start(), 1.0) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [Span("hex", m.start(), m.end(), m.start(), 1.0) for m in HEX.finditer(text)]
    return found


def name_score(name: str) -> float:
    words = [w.lower() for w in PARTS.findall(name)]
    score = max([SENSITIVE.get(w, 0.0) for w in words] + [PAIRS.get(p, 0.0) for p in zip(words, words[1:])], default=0.0)
    for w in words:
        score *= HARMLESS.get(w, 1.0)
    return score


def literal_score(value: str, strong: bool = False) -> float:
    """0 for placeholders and short words, up to 1 for long mixed ones, or any long ones if the name is ``strong``."""
    if len(value) < 8 or PLACEHOLDER.match(value):
        return 0.0
    counts = Counter(value)
    entropy = -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values())
    kinds = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", r"[^\w\s]"))
    if not strong and (kinds < 2 or re.search(r"\s", value)):
        return min(0.4, entropy / 8)
    return min(1.0, entropy / 3.5)


def assignments(text: str) -> list[tuple[str, str, int, int, bool]]:
    """(name, value, start, end, is a bare name) of each pair, in order of the text."""
    pairs = []
    after = 0  # end of what the pairs so far have used up
    begin = 0  # end of the operator before
    run_end = 0  # end of the last run taken whole
    for op in OPERATOR.finditer(text):
        low, begin = max(after, begin), op.end()
        if op.start() < after:
            continue
        name = BACKWARDS.match(text[low:op.start()][::-1])  # no name holds an operator, so these slices never overlap
        if not name:
            continue
        inside = op.start() < run_end
        value = INNER[":" if op[0] == ":" else ""].match(text, op.end(), run_end) if inside else VALUE.match(text, op.end())
        if not value:
            continue
        group = value.lastindex
        bare = inside or group == 4
        pairs.append(((name[2] or name[3])[::-1], value[group], value.start(group), value.end(group),
                      bare and bool(IDENTIFIER.fullmatch(value[group]))))
        after = op.end() if bare else value.end()
        if group == 4:
            run_end = value.end()
    return pairs


def resolved(pairs: list[tuple[str, str, int, int, bool]]) -> list[int]:
    """For each pair the number of the one with its literal; a name nobody assigns, or only in a circle, stands for itself."""
    before: list[int | None] = []
    last: dict[str, int] = {}
    for n, (name, value, _, _, bare) in enumerate(pairs):
        before.append(last.get(value) if bare else None)
        last[name] = n
    source = list(before)
    first: dict[str, int] = {}
    for n in range(len(pairs) - 1, -1, -1):  # ``first`` holds the first assignment of each name after n
        name, value, _, _, bare = pairs[n]
        if bare and source[n] is None:
            source[n] = first.get(value)
        first[name] = n
    out: list[int | None] = [None] * len(pairs)
    for n in range(len(pairs)):
        way, seen, at = [], set(), n
        while out[at] is None and source[at] is not None and at not in seen:
            way.append(at)
            seen.add(at)
            at = source[at]
        if at in seen:  # a circle
            for m in way:
                out[m] = m
        else:
            end = out[at] = at if out[at] is None else out[at]
            for m in way:
                out[m] = end
    return out


def lexed_spans(text: str, threshold: float) -> list[Span]:
    if "=" not in text and ":" not in text:
        return []
    pairs = assignments(text)
    best: dict[tuple[int, int], float] = {}
    scores: dict[tuple[int, bool], float] = {}  # a literal may have any number of names
    for (name, *_), source in zip(pairs, resolved(pairs)):
        _, value, start, end, _ = pairs[source]
        weight = name_score(name)
        if weight:
            use = source, weight >= STRONG
            if use not in scores:
                scores[use] = literal_score(value, use[1])
            score = weight * scores[use]
            if PIN.fullmatch(value) and "pin" in map(str.lower, PARTS.findall(name)):
                score = max(score, weight)
            best[start, end] = max(best.get((start, end), 0.0), score)
    return [Span("lexed", a, b, a, s) for (a, b), s in best.items() if s >= threshold]


def scan(text: str | None, threshold: float = 0.6) -> list[Span]:
    """All spans of a text by start, then kind; positions in code points."""
    if not text:
        return []
    base = base_spans(text)
    starts = sorted((b.start, b.end) for b in base)
    reach = [-1, *accumulate((end for _, end in starts), max)]  # how far the first n base spans go
    own = [s for s in lexed_spans(text, threshold) if reach[bisect_right(starts, (s.start, len(text)))] < s.end]
    return sorted(base + own, key=lambda s: (s.start, KINDS.index(s.kind)))


def redacted(text: str | None, mask: str, threshold: float) -> str | None:
    """The text with every secret replaced; names of assignments stay."""
    out, at = [], 0
    for a, b in sorted((s.value_start, s.end) for s in scan(text, threshold)):
        if b > at:
            if a >= at:
                out.append(text[at:a] + mask)
            at = b
    return "".join(out) + text[at:] if out else text


SPANS = "array<struct<kind:string,start:bigint,end:bigint,value_start:bigint,score:double>>"


def secret_spans(docs: DataFrame, text: str = "text", threshold: float = 0.6) -> DataFrame:
    """``docs`` with a column ``spans``, an array of (kind, start, end, value_start, score).

    Null and empty texts have no span. Rows, keys and other columns pass unchanged, repeated rows each on
    their own; a column of the name ``spans`` is replaced. Empty tables stay empty.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                               ("value_start", pa.int64()), ("score", pa.float64())]))

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array([[s._asdict() for s in scan(t, threshold)] for t in batch.column(text).to_pylist()], kind)]

    return appended(docs, f"spans {SPANS}", compute)


def redact(docs: DataFrame, text: str = "text", mask: str = "[SECRET]", threshold: float = 0.6) -> DataFrame:
    """``docs`` with secrets in ``text`` replaced by ``mask``; columns, their order and all rows stay.

    Null and empty texts stay as they are, repeated rows each on their own; empty tables stay empty.
    """
    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array([redacted(t, mask, threshold) for t in batch.column(text).to_pylist()], pa.string())]

    return appended(docs, f"{text} string", compute).select([F.col(f"`{c}`") for c in docs.columns])


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def span_digest(docs: DataFrame, text: str = "text", threshold: float = 0.6) -> DataFrame:
    """``docs`` without its text, with counts per base kind, a hash of the base spans and all spans as text.

    Null texts count as empty ones: no span, the hash of nothing. Repeated rows and null keys pass each on
    their own, columns of the names given here are replaced, empty tables stay empty.
    """
    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        found = [scan(t, threshold) for t in batch.column(text).to_pylist()]
        counts = [pa.array([sum(s.kind == k for s in f) for f in found], pa.int64()) for k in KINDS[:3]]
        base = [hashlib.sha256(_joined([s for s in f if s.kind != "lexed"]).encode()).hexdigest() for f in found]
        return [*counts, pa.array(base, pa.string()), pa.array([_joined(f) for f in found], pa.string())]

    return appended(docs, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string", compute).drop(text)
