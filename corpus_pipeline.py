"""Corpus pipeline: quality rules, SimHash near-dedup, secret scans, mixing, BPE encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from alluvium.llm import mixing, quality, secrets, simhash, word_bpe
from alluvium.llm.common import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that their group's adaptive thresholds reject go, and null texts and texts without a word; a short text
    may stay. Equal rows go or stay together; an empty table gives no rows."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8 or more) stays, that with the least
    doc_id, a null one last. Texts without a word are one group; an empty table gives no rows."""
    return simhash.keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The values of secrets give way to a mark; every row stays, a null text as null. An empty table gives no rows."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each epoch in which a document is taken; null sources are one source. An empty table gives no rows."""
    return mixing.mixed_documents(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document: counts and digests of ids and of the decoded text. A null or empty text has none; equal
    rows give equal results; an empty table gives no rows."""
    return word_bpe.encode_decode(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_dedup),
    ("secret scans", secret_scan),
    ("mixing sources", mix_sources),
    ("bpe encoding", bpe),
]

#: The fingerprints, sketches and tokens can't be written in SQL; tests/llm/test_brute.py holds run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over documents, each written as Parquet and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
