"""The registered queries of the operators and, where SQL can say it, their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    divergence, languages, lattice, packing, phrases, quality, repeats, resampling, secret_scan, segmentations, simhash, token_counts,
    topk,
)
from strata.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = segmentations.sample_segmentations(docs, ["doc_id"], digest=True)
    rows = found.select("doc_id", "text", F.explode("samples").alias("s")).select("doc_id", "text", "s.*")
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return segmentations.decode(rows).withColumn("decodes", same).drop("text", "decoded")


@query
def op2_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.maxscore(spark, vectors, vectors.where("vec_id % 50 = 0"))


ORACLE["op2_maxscore"] = """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(CAST(x AS DOUBLE))]) = 0),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.v, d.v)]) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id AND len(q.v) = len(d.v)),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.identify(table(spark, sf_dir, "documents"))


@query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.lattice_links(spark, table(spark, sf_dir, "embeddings"))


@query
def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.span_digest(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(spark, table(spark, sf_dir, "documents"))


@query
def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return repeats.without_repeats(docs, digest=True).withColumnRenamed("kept", "kept_sha256")


@query
def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


ORACLE["op11_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
w AS (
  SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS c FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
g AS (
  SELECT lang, source, coalesce(sum(c), 0) AS n FROM (SELECT DISTINCT lang, source FROM d)
  LEFT JOIN c USING (lang, source) GROUP BY lang, source),
p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.c, 0) AS c,
         1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.c, 0) + 5) // (g.n + 5 * v.v) AS p
  FROM g JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)),
q AS (
  SELECT t.lang, t.term, 1 + CAST(1000000000 AS HUGEINT) * (t.c + 5) // (n.n + 5 * v.v) AS q
  FROM (SELECT lang, term, sum(c) AS c FROM c GROUP BY lang, term) t
  JOIN (SELECT lang, sum(n) AS n FROM g GROUP BY lang) n USING (lang) JOIN v USING (lang)),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(apart.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source),
terms AS (
  SELECT p.lang, p.source, 'term' AS part, p.term AS item, p.p - q.q AS value
  FROM p JOIN q USING (lang, term) WHERE p.c > 0 AND p.p > q.q),
r AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM r WHERE part = 'pair' OR rank <= 50
"""


@query
def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])


ORACLE["op12_resampling"] = r"""
WITH crc AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c
    FROM (SELECT CAST(range AS BIGINT) AS i FROM range(256)))),
texts AS (
  SELECT 0 AS side, row_number() OVER () AS row, doc_id AS id, text FROM documents
  UNION ALL SELECT 1, row_number() OVER (), NULL, text FROM benchmark),
w AS (
  SELECT side, row, id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
f AS (
  SELECT side, row, unnest(list_concat(w, [p[1] || ' ' || p[2] FOR p IN list_zip(w[:-2], w[2:])])) AS f FROM w),
b AS (
  SELECT f, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes), lambda a, x: xor(a >> 8, t[xor(a & 255, x) + 1])), 4294967295) % 10000 AS b
  FROM (
    SELECT f, [CAST(16 * (instr('0123456789ABCDEF', h[2 * k + 1]) - 1) + instr('0123456789ABCDEF', h[2 * k + 2]) - 1 AS BIGINT)
               FOR k IN range(CAST(len(h) // 2 AS BIGINT))] AS bytes
    FROM (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM f))), crc),
fb AS (SELECT side, row, b, count(*) AS n FROM f JOIN b USING (f) GROUP BY ALL),
s AS (SELECT b, sum(n) AS n FROM fb WHERE side = 0 GROUP BY b),
t AS (SELECT b, sum(n) AS n FROM fb WHERE side = 1 GROUP BY b),
g AS (
  SELECT s.b, CAST(floor(1000 * ln(
    (coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)
    / ((s.n + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)))) AS BIGINT) AS g
  FROM s LEFT JOIN t USING (b)),
d AS (
  SELECT row, sum(n) AS n, sum(n * g) AS g FROM fb JOIN g USING (b) WHERE side = 0 GROUP BY row),
e AS (
  SELECT w.id AS doc_id, len(w.w) AS words, coalesce(d.n, 0) AS n_features,
         CASE WHEN d.n IS NULL THEN 0 ELSE (d.g - ((d.g % d.n) + d.n) % d.n) // d.n END AS weight,
         list_sum([(instr('0123456789abcdef', sha256('7:' || w.id)[k]) - 1) * 16 ** (8 - k) FOR k IN range(1, 9)]) AS h
  FROM w LEFT JOIN d USING (row) WHERE w.side = 0),
x AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS score FROM e),
r AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM x WHERE words >= 20
  QUALIFY rank <= (SELECT 25 * count(*) // 100 FROM x WHERE words >= 20))
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
       CAST(rank AS BIGINT) AS rank
FROM x LEFT JOIN r USING (doc_id)
"""


@query
def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return phrases.without_repeated_phrases(docs, digest=True).withColumnRenamed("kept", "kept_sha256")


ORACLE["op13_phrases"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS a, w FROM d WHERE len(w) >= 20),
p AS (SELECT doc_id, a, sha256(array_to_string(w[a:a + 19], ' ')) AS h FROM x),
r AS (SELECT doc_id, a, row_number() OVER (PARTITION BY h ORDER BY doc_id, a) AS k FROM p),
c AS (SELECT DISTINCT doc_id, unnest(range(a, a + 20)) AS i FROM r WHERE k > 1),
g AS (SELECT doc_id, list(i) AS gone FROM c GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string([w[i] FOR i IN range(1, len(w) + 1) IF gone IS NULL OR NOT list_contains(gone, i)], ' '), '')) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id)
"""
