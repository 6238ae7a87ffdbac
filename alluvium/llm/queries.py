"""The queries of this subpackage and their SQL, for the entry module."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import embed_dedup, langid, lexical, merkle, mixing, quality, quality_fm, secrets, sharding, simhash, suffix_dedup, token_files, word_bpe


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(_docs(spark, sf_dir))


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_docs(spark, sf_dir))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(_docs(spark, sf_dir))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_docs(spark, sf_dir))


def op5_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_bpe.encode_decode(_docs(spark, sf_dir))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_docs(spark, sf_dir))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_docs(spark, sf_dir))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rate(_docs(spark, sf_dir))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_docs(spark, sf_dir))


def op11_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_fm.classify(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(_docs(spark, sf_dir))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search_documents(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base counts of op 2, which SQL can tell."""
    return secrets.scan(_docs(spark, sf_dir)).select("doc_id", "n_assign", "n_access", "n_hex")


def quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts and the base verdict of op 8, which SQL can tell."""
    return quality.rate(_docs(spark, sf_dir)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def mix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes and targets of op 7, and what each source's documents give in all."""
    mixed = mixing.mix(_docs(spark, sf_dir))
    by_source = mixed.groupBy("source_size", F.round("target", 3).alias("target")).agg(F.count("*").alias("documents"), F.sum("size").alias("size"), F.sum("taken").alias("taken"))
    return by_source.withColumn("taken", F.abs(F.col("taken") - F.col("target")) <= 1).withColumnRenamed("taken", "near_target")


_W = "[^\\x20\\x09-\\x0D]+"
_SQL = {
    "secret_counts": """SELECT doc_id,
  CAST(len(list_filter(regexp_extract_all(t, '((?i:password|passwd|secret|token|api_?key))["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2), lambda x: length(x) >= 12)) AS BIGINT) AS n_assign,
  CAST(len(list_filter(regexp_extract_all(t, 'AKIA[A-Z0-9]+'), lambda x: length(x) >= 18)) AS BIGINT) AS n_access,
  CAST(len(list_filter(regexp_extract_all(t, '[0-9a-f]+'), lambda x: length(x) >= 16)) AS BIGINT) AS n_hex
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)""",
    "quality_counts": f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
  w AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM (SELECT r, regexp_extract_all(t, '{_W}') AS ws FROM d)),
  g AS (SELECT r, i, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o AS gram FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
  again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM g WHERE gram IS NOT NULL) WHERE n > 1),
  rep AS (SELECT r, count(DISTINCT i + k) AS n FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
  c AS (SELECT r, doc_id, len(regexp_extract_all(t, '{_W}')) AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d)
  SELECT doc_id, n_words, word_chars, n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
    n_words < 50 OR 100 * coalesce(rep.n, 0) > 50 * n_words AS base_failed FROM c LEFT JOIN rep USING (r)""",
    "mix_targets": f"""WITH s AS (SELECT source, count(*) AS documents, CAST(sum(len(regexp_extract_all(coalesce(text, ''), '{_W}'))) AS BIGINT) AS size FROM documents GROUP BY source),
  n AS (SELECT *, (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS w, 3.0 * size AS cap FROM s),
  l AS (SELECT b.cap / b.w AS full_at, ((SELECT sum(size) FROM n) - coalesce(sum(a.cap) FILTER (WHERE a.cap / a.w < b.cap / b.w), 0)) / sum(a.w) FILTER (WHERE a.cap / a.w >= b.cap / b.w) AS level
    FROM n AS b, n AS a GROUP BY b.source, b.cap, b.w)
  SELECT size AS source_size, round(least(cap, w * (SELECT min_by(level, full_at) FROM l WHERE level <= full_at)), 3) AS target, documents, size, TRUE AS near_target FROM n""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (
        op1_suffix_dedup,
        op2_secret_scans,
        op3_token_files,
        op4_sharding,
        op5_word_bpe,
        op6_simhash,
        op7_mixing,
        op8_quality_rules,
        op9_embedding_dedup,
        op10_language_id,
        op11_quality_fm,
        op12_merkle_manifest,
        op13_lexical_search,
        secret_counts,
        quality_counts,
        mix_targets,
    )
    return {f.__name__: f for f in ops}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
