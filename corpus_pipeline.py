"""A corpus pipeline of five stages over ``documents``: each takes the table its predecessor wrote.

A stage is (name, function of (spark, docs, sf_dir)). All but the last return the columns of ``documents``, and any
others that came in, unchanged, whatever their names; the last returns packed pieces. Empty tables stay empty. ``run`` writes each stage's result to the shared folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import languages, packing, repeats, secret_scan, simhash
from strata.llm.common import stored, table

LEAST_SHARE = 0.5  # of a text's letters that its main language must have


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with one main language: rejects texts without a letter (null and empty ones too) and
    those whose most frequent language has less than ``LEAST_SHARE`` of the letters. The model is learned
    from the documents' own labels; rows keep theirs. Without any label to learn from no language can be told,
    and every text with a letter stays."""
    model = languages.learn(docs.select("text", "lang"))
    if not model.languages:
        return languages.with_letters(docs)
    found = languages.labelled_language(docs, model, names=("__lang", "__share"))
    return found.where((F.col("__lang") != "und") & (F.col("__share") >= LEAST_SHARE)).select([f"`{c}`" for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group of documents whose five-word shingles are 0.8 alike or more. Repeated
    rows and copies are such groups, null and empty texts one; a row without doc_id stays."""
    return simhash.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out passages of 50 bytes or more that a document with a smaller doc_id has too, and documents
    of which nothing is left. ``n_chars`` follows the text. Null and empty texts stay as they are, a null text with
    its ``n_chars``; repeated rows and rows of one doc_id take nothing from each other, rows without doc_id stay whole."""
    marked = docs.withColumn("__null", F.col("text").isNull())
    found = repeats.without_repeats(marked, names=("__bytes", "__removed", "__spans", "__kept"))
    found = found.where("__removed = 0 or trim(__kept) <> ''")
    text = F.when(~F.col("__null"), F.col("__kept"))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.coalesce(F.length(text).cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
    return found.select([changed[c].alias(c) if c in changed else F.col(f"`{c}`") for c in docs.columns])


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets; every document stays, repeated rows too. ``n_chars`` follows the text; null and empty texts stay
    as they are, a null text with its ``n_chars``."""
    masked = secret_scan.redact(docs)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all documents into windows of 1024 tokens. A null text is packed as an empty one, as its closing id alone;
    repeated rows and rows without doc_id are packed each on their own."""
    return packing.pack(docs)


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("secret scans", secrets),
    ("packing", pack),
]

ORACLE_SQL = None  # model scores, fingerprints and token ids are beyond SQL; see tests/llm/test_pipeline.py


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
