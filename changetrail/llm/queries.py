"""The registered queries of this subpackage, each over a whole table, and their SQL counterparts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_pair_coding as bpe
from . import chat_perspectives as chat
from . import centroid_clusters, decontamination, language_id, lexical_search, line_dedup
from . import multiset_fingerprint, quality_model
from . import secret_scan, shingle_join, toxicity, url_rules
from .common import table

#: The rules of op5: host, path, verdict.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    return found.withColumn("base_sha256", F.sha2("base", 256)).drop("base")


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.predict(docs, language_id.train(docs))
    return found.withColumn("held_out", language_id.held_out(F.col("doc_id")))


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.components(table(spark, sf_dir, "documents"))


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_model.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "lang", "perplexity", "accepted")


def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return url_rules.judge(table(spark, sf_dir, "pages"), rules)


def benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


def severities(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.judge(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiset_fingerprint.edited_likeness(table(spark, sf_dir, "documents"))


def token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return bpe.decode(encoded, path).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroid_clusters.cluster(table(spark, sf_dir, "embeddings"))
    return found.withColumn("centroid_sha256", F.sha2("centroid", 256)).drop("centroid")


def ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_secrets": secrets,
    "op2_language": languages,
    "op3_near_duplicates": near_duplicates,
    "op4_quality": quality,
    "op5_url_rules": url_verdicts,
    "op6_benchmark_leaks": benchmark_leaks,
    "op7_perspectives": perspectives,
    "op8_toxicity": severities,
    "op9_fingerprints": fingerprints,
    "op10_bpe": token_ids,
    "op11_line_dedup": repeated_lines,
    "op12_centroid_clusters": centroid_clustering,
    "op13_lexical_search": ranked_search,
}

_NEAR_DUPLICATES = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, [x for x in regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+') if x <> ''] AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest([w[i:i + 4] for i in range(1, greatest(len(w) - 4, 1) + 1)]) AS s
  FROM words WHERE len(w) > 0
), sizes AS (
  SELECT w.doc_id, coalesce(s.n, 0) AS n_shingles
  FROM words w LEFT JOIN (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id) s USING (doc_id)
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT p.a, p.b FROM pairs p JOIN sizes x ON x.doc_id = p.a JOIN sizes y ON y.doc_id = p.b
  WHERE 100 * p.common >= 80 * (x.n_shingles + y.n_shingles - p.common)
), both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached AS (
  SELECT doc_id, doc_id AS other FROM sizes
  UNION
  SELECT r.doc_id, e.b FROM reached r JOIN both_ways e ON e.a = r.other
)
SELECT s.doc_id, s.n_shingles, min(r.other) AS component_id
FROM sizes s JOIN reached r USING (doc_id) GROUP BY s.doc_id, s.n_shingles
"""

ORACLE_SQL = {
    "op3_near_duplicates": _NEAR_DUPLICATES,
    "op5_url_rules": url_rules.oracle(RULES),
    "op7_perspectives": chat.ORACLE,
    "op11_line_dedup": line_dedup.ORACLE,
    "op12_centroid_clusters": centroid_clusters.ORACLE,
    "op13_lexical_search": lexical_search.ORACLE,
}
