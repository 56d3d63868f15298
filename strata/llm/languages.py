"""Language ID: script ranges narrow the candidates, then Viterbi over per-word scores labels spans.

A word's score for a language is the log-probability of its byte n-grams (boundaries marked) under that
language's counts, learned from a bounded number of labelled texts per language. Languages that hardly ever use
the script of a word are not candidates for it. Words of a text form a chain whose states are languages; leaving
a language costs ``penalty``, and the best path labels every word. The text's language is the one whose spans
have the most letters, and the score is their share.
"""

from __future__ import annotations

import bisect
import re
import uuid
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import appended, per_process
from strata.llm.grams import grams

ORDERS = (1, 2, 3, 4, 5)
WORD = re.compile(r"[^\W\d_]+")  # runs of letters

# First code points of the ranges of scripts, ascending.
SCRIPTS = [(0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
           (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"), (0x0980, "indic"), (0x0E00, "thai"),
           (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"),
           (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "han"), (0xAC00, "hangul"),
           (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other")]
STARTS = [a for a, _ in SCRIPTS]
NAMES = sorted({s for _, s in SCRIPTS})


def script(word: str) -> int:
    return NAMES.index(SCRIPTS[bisect.bisect_right(STARTS, ord(word[0])) - 1][1])


class Model(NamedTuple):
    languages: list[str]
    weights: np.ndarray  # buckets x languages, log-probabilities
    candidates: np.ndarray  # scripts x languages, True where the language uses the script
    buckets: int


class Words:
    """Scores of words, remembered per process up to ``most`` words."""

    def __init__(self, model: Model, most: int = 150_000):
        self.model, self.most = model, most
        self._clear()

    def _clear(self) -> None:
        self.number: dict[str, int] = {}
        self.scores = np.zeros((1024, len(self.model.languages)), np.float32)

    def lookup(self, texts: list[list[str]]) -> list[np.ndarray]:
        if len(self.number) > self.most:
            self._clear()
        new = list(dict.fromkeys(w for words in texts for w in words if w not in self.number))
        for at in range(0, len(new), 20_000):
            self._add(new[at:at + 20_000])
        return [np.array([self.number[w] for w in words], np.int64) for words in texts]

    def _add(self, new: list[str]) -> None:
        model, first = self.model, len(self.number)
        owner, bucket = grams([b"^" + w.lower().encode() + b"$" for w in new], ORDERS, model.buckets)
        sums = np.stack([np.bincount(owner, model.weights[bucket, k], len(new)) for k in range(len(model.languages))], axis=1)
        allowed = model.candidates[[script(w) for w in new]]
        allowed[~allowed.any(axis=1)] = True  # a script nobody uses rules nobody out
        sums[~allowed] = -1e4
        sums -= sums.max(axis=1, keepdims=True)
        if first + len(new) > len(self.scores):
            self.scores = np.resize(self.scores, (2 * (first + len(new)), len(model.languages)))
        self.scores[first:first + len(new)] = np.maximum(sums, -30)
        self.number.update(zip(new, range(first, first + len(new))))


def best_path(scores: np.ndarray, penalty: float) -> np.ndarray:
    """States (columns) of the chain with the highest sum of scores less ``penalty`` per change."""
    n, k = scores.shape
    whole = scores.sum(axis=0, dtype=np.float64)
    best = int(whole.argmax())
    # If no run of words gains more than half the penalty in another language, one language is optimal.
    gain = np.cumsum(scores - scores[:, best:best + 1], axis=0, dtype=np.float64)
    low = np.minimum.accumulate(np.vstack([np.zeros((1, k)), gain[:-1]]), axis=0)
    if (gain - low).max() <= penalty / 2:
        return np.full(n, best)
    value, back = scores[0].astype(float).tolist(), np.empty((n, k), np.int16)
    states = range(k)
    for t, row in enumerate(scores.tolist()):
        if t == 0:
            continue
        top = max(states, key=value.__getitem__)
        moved = value[top] - penalty
        back[t] = [j if value[j] >= moved else top for j in states]
        value = [max(value[j], moved) + row[j] for j in states]
    path = np.empty(n, np.int64)
    path[-1] = max(states, key=value.__getitem__)
    for t in range(n - 1, 0, -1):
        path[t - 1] = back[t, path[t]]
    return path


def spans(text: str, words: Words, penalty: float) -> list[tuple[str, int, int, int]]:
    """(language, start, end, letters) of the maximal runs of one language, in code points."""
    found = list(WORD.finditer(text))
    if not found:
        return []
    path = best_path(words.scores[words.lookup([[m[0] for m in found]])[0]], penalty)
    cuts = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist(), len(path)]
    return [(words.model.languages[path[a]], found[a].start(), found[b - 1].end(), sum(len(m[0]) for m in found[a:b]))
            for a, b in zip(cuts, cuts[1:])]


def predict(texts: list[str | None], words: Words, penalty: float) -> list[tuple[str, float]]:
    """(language, score) of whole texts; ``und`` and 0 without a letter or without a learned language."""
    model = words.model
    split = [WORD.findall(t or "") if model.languages else [] for t in texts]
    out = []
    for found, numbers in zip(split, words.lookup(split)):
        if not found:
            out.append(("und", 0.0))
            continue
        letters = np.bincount(best_path(words.scores[numbers], penalty), [len(w) for w in found], len(model.languages))
        best = int(letters.argmax())
        out.append((model.languages[best], float(letters[best] / letters.sum())))
    return out


def first_by_hash(labelled: DataFrame, per_language: int) -> DataFrame:
    """(text, lang, n): the ``per_language`` rows of each language with the smallest hashes of their texts, ties by
    text, equal rows folded to one with their number ``n``. Rows without text or language are left out.

    A histogram of the hashes' leading 16 bits tells per language how far to read, so that only texts up to there are
    shuffled: those wanted and a 65,536th of the rest, copies folded before. The bounds have one row per language.
    """
    rows = labelled.where("text is not null and lang is not null").select("text", "lang", F.xxhash64("text").alias("h"))
    step = F.shiftright("h", 48)
    upto = F.sum("n").over(Window.partitionBy("lang").orderBy("step"))
    bounds = rows.groupBy("lang", step.alias("step")).agg(F.count("*").alias("n")).withColumn("upto", upto).groupBy("lang").agg(
        F.coalesce(F.min(F.when(F.col("upto") >= per_language, F.col("step"))), F.max("step")).alias("bound"))
    near = rows.join(F.broadcast(bounds), "lang").where(step <= F.col("bound"))
    order = Window.partitionBy("lang").orderBy("h", "text")
    texts = near.groupBy("lang", "h", "text").agg(F.count("*").alias("n")).select(
        "*", F.row_number().over(order).alias("place")).where(F.col("place") <= per_language)
    room = per_language - (F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
    return texts.select("text", "lang", F.least("n", room).alias("n")).where("n > 0")


def learn(labelled: DataFrame, per_language: int = 1000, buckets: int = 1 << 16) -> Model:
    """A model from (text, lang), the ``per_language`` texts of each language with the smallest hashes.

    Rows without text or language are left out. What reaches the driver is bounded by languages times buckets.
    """
    sample = first_by_hash(labelled, per_language)

    def count(batches):
        table: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang, n in zip(*(batch.column(c).to_pylist() for c in ("text", "lang", "n"))):
                words = list(dict.fromkeys(WORD.findall(text)))
                if words:
                    _, bucket = grams([b"^" + w.lower().encode() + b"$" for w in words], ORDERS, buckets)
                    table[lang] = table.get(lang, 0) + n * np.bincount(bucket, minlength=buckets)
                    scripts[lang] = scripts.get(lang, 0) + n * np.bincount([script(w) for w in words], minlength=len(NAMES))
        for lang in table:
            used = np.flatnonzero(table[lang])
            kept = np.flatnonzero(scripts[lang])
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * (len(used) + len(kept))), "bucket": pa.array(np.r_[used, -1 - kept]),
                "n": pa.array(np.r_[table[lang][used], scripts[lang][kept]].astype(np.int64))})

    counts = sample.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(counts.lang.unique())
    table, scripts = np.zeros((buckets, len(languages))), np.zeros((len(NAMES), len(languages)))
    for k, lang in enumerate(languages):
        own = counts[counts.lang == lang]
        grams_, seen = own[own.bucket >= 0], own[own.bucket < 0]
        table[grams_.bucket.to_numpy(), k] = grams_.n.to_numpy()
        scripts[-1 - seen.bucket.to_numpy(), k] = seen.n.to_numpy()
    weights = np.log((table + 0.5) / (table.sum(axis=0, keepdims=True) + 0.5 * buckets)) / 2
    used = scripts >= 0.001 * np.maximum(scripts.sum(axis=0, keepdims=True), 1)
    return Model(languages, weights.astype(np.float32), used, buckets)


def held(key: Column, folds: int, fold: int) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == fold, F.lit(False))


def _remembered(model: Model, spark: SparkSession):
    """A function for tasks that gives the model's word memo, one per worker process."""
    shared, name = spark.sparkContext.broadcast(tuple(model)), uuid.uuid4().hex
    return lambda: per_process(("languages", name), lambda: Words(Model(*shared.value)))


def labelled_language(docs: DataFrame, model: Model, text: str = "text", penalty: float = 12.0,
                      names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with a language and its score; a text that is null or has no letter is ``und`` with score 0.

    Rows pass one by one without a shuffle: repeated rows get equal labels, other columns stay, columns of
    the two ``names`` are replaced, empty tables stay empty.
    """
    words = _remembered(model, docs.sparkSession)

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        found = predict(batch.column(text).to_pylist(), words(), penalty)
        return [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]

    return appended(docs, f"{names[0]} string, {names[1]} double", compute)


def with_letters(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows whose text has a letter; columns and their order stay."""
    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array([WORD.search(t or "") is not None for t in batch.column(text).to_pylist()], pa.bool_())]

    return appended(docs, "__letters boolean", compute).where("__letters").select([F.col(f"`{c}`") for c in docs.columns])


def language_spans(docs: DataFrame, model: Model, text: str = "text", penalty: float = 12.0) -> DataFrame:
    """``docs`` with ``lang_spans``: (lang, start, end, letters) of each run of one language."""
    words = _remembered(model, docs.sparkSession)
    names = ["lang", "start", "end", "letters"]
    kind = pa.list_(pa.struct([("lang", pa.string()), *((n, pa.int64()) for n in names[1:])]))

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array([[dict(zip(names, s)) for s in spans(t or "", words(), penalty)] for t in batch.column(text).to_pylist()], kind)]

    return appended(docs, "lang_spans array<struct<lang:string,start:bigint,end:bigint,letters:bigint>>", compute)


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(key, held_out, lang_pred, score): learned from rows outside fold 2 of 4 by the key's checksum.

    A null key is in no fold, so such rows are learned from.
    """
    model = learn(docs.where(~held(F.col(key), 4, 2)).select(F.col(text).alias("text"), F.col(lang).alias("lang")))
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return labelled_language(rows, model).select(F.col("doc_id").alias(key), held(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")
