"""Ranked lexical search over a document-sharded inverted index.

An index is a table with a row for each shard of at most SHARD_DOCS documents: the shard's terms by hash, where each
term's postings begin, and the postings, which document and which impact, one after the other (compressed sparse rows). An
impact is the part of a score that a term's count and its document's length fix, a whole number computed once. What a
search adds is each term's weight, by the number of documents that hold it, which the shards' row lengths sum to.

A search sends blocks of items to the tasks. A shard's scores of an item are one dense array, to which a term's postings
are added at a time; argpartition finds the k-th score, and those equal to it are cut by doc_id. A task goes on with the
best k of each item over all its shards, and the tasks' lists are merged in two steps.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import scratch_path

TOP = 20
#: A shard's documents at most, and the bytes of text with which it is full.
SHARD_DOCS, SHARD_BYTES = 4096, 8 << 20
#: A row is a shard and may have some 10 MB, and Spark reads a row group at a time: one ends once it has so many bytes, looked
#: at after each row (Parquet looks after 100), so a task holds a shard or two however many its file has.
_WRITE = {
    "compression": "zstd", "parquet.block.size": 8 << 20, "parquet.block.size.row.check.min": 1, "parquet.block.size.row.check.max": 1,
    "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1, "parquet.enable.dictionary": "false",
}
#: Items that are searched for at a time at most, and the bytes of their texts with which a block is full.
BLOCK_ITEMS, BLOCK_BYTES = 2_000, 4 << 20
#: The tasks' lists of an item are merged in so many parts first.
MERGED = 64
#: Documents whose doc_id is null come last among equal scores.
NO_ID = 2**63 - 1

# Fixed values of the scores: 100 - 25, 25, 1000, 12 and the scale of impacts.
KEPT, SLOPE, TF, LENGTH, SCALE = 75, 25, 1000, 12, 1_000_000_000

#: Bytes of terms: digits, letters and all of other scripts; capitals of ASCII are made small, all else ends a term.
_TERM = bytes((c + 32 if 65 <= c <= 90 else c) if 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_IN_TERM = np.frombuffer(_TERM, np.uint8) != 32

INDEX = "n_docs int, doc_ids binary, hashes binary, ends binary, terms binary, starts binary, docs binary, impacts binary"


def terms(raw: bytes) -> list[bytes]:
    return raw.translate(_TERM).split()


def _hash(term: bytes) -> int:
    return xxhash.xxh64_intdigest(term)


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) of a partition -> one row: documents with a term, terms in all."""
    documents = total = 0
    for batch in batches:
        for raw in batch.column(0):
            inside = _IN_TERM[np.frombuffer(raw.as_buffer() or b"", np.uint8)]
            n = int(inside[:1].sum() + (inside[1:] & ~inside[:-1]).sum())
            documents, total = documents + (n > 0), total + n
    yield pa.record_batch([pa.array([documents]), pa.array([total])], ["documents", "terms"])


def impacts(tf: np.ndarray, length: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What a term that occurs tf times adds to the score of a document of so many terms, for each unit of its weight."""
    m = KEPT + (SLOPE * length * documents) // total
    return (SCALE * tf) // (TF * tf + LENGTH * m)


class _Shard:
    """Documents as they come, until they fill a shard."""

    def __init__(self):
        self.ids, self.lengths, self.at, self.docs, self.tf, self.size = [], [], [], [], [], 0
        self.vocabulary: dict[bytes, int] = {}

    def add(self, doc_id: int | None, raw: bytes) -> None:
        words = terms(raw)
        if words:
            number = self.vocabulary
            counts = Counter(words)
            self.at.append(np.fromiter((number.setdefault(w, len(number)) for w in counts), np.int32, len(counts)))
            self.tf.append(np.fromiter(counts.values(), np.int64, len(counts)))
            self.docs.append(np.full(len(counts), len(self.ids), np.int32))
            self.ids.append(NO_ID if doc_id is None else doc_id)
            self.lengths.append(len(words))
        self.size += len(raw)

    @property
    def full(self) -> bool:
        return len(self.ids) >= SHARD_DOCS or self.size >= SHARD_BYTES

    def row(self, documents: int, total: int) -> tuple | None:
        if not self.ids:
            return None
        words = list(self.vocabulary)
        hashes = np.fromiter(map(_hash, words), np.uint64, len(words))
        by_hash = np.argsort(hashes, kind="stable")
        rank = np.empty(len(words), np.int32)
        rank[by_hash] = np.arange(len(words))
        at, docs, tf = rank[np.concatenate(self.at)], np.concatenate(self.docs), np.concatenate(self.tf)
        order = np.argsort(at, kind="stable")
        docs, tf = docs[order], tf[order]
        starts = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(words)))])
        impact = impacts(tf, np.array(self.lengths, np.int64)[docs], documents, total)
        ordered = [words[i] for i in by_hash]
        ends = np.cumsum([len(w) for w in ordered])
        return (
            len(self.ids), np.array(self.ids, np.int64).tobytes(), hashes[by_hash].tobytes(), ends.astype(np.int64).tobytes(), b"".join(ordered),
            starts.astype(np.int64).tobytes(), docs.astype(np.uint16).tobytes(), impact.astype(np.int32).tobytes(),
        )


def _record(row: tuple) -> pa.RecordBatch:
    names = [c.split()[0] for c in INDEX.split(", ")]
    return pa.record_batch([pa.array([v], pa.int32() if n == "n_docs" else pa.binary()) for v, n in zip(row, names)], names)


def _indexed(documents: int, total: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard()
        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                shard.add(doc_id, raw.as_py() or b"")
                if shard.full:
                    if row := shard.row(documents, total):
                        yield _record(row)
                    shard = _Shard()
        if row := shard.row(documents, total):
            yield _record(row)

    return run


@dataclass(frozen=True)
class Index:
    """A written index: its folder, how many documents have a term, and how many terms they have in all."""

    path: str
    documents: int
    terms: int

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(INDEX).parquet(self.path)


def build(docs: DataFrame, path: str | None = None) -> Index:
    """Index all of docs (doc_id, text). Texts are read twice: for the two sums that impacts need, then for the shards. No
    row is shuffled, so a shard has the documents of one task."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "lexical-index")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    n = rows.select("text").mapInArrow(_lengths, "documents long, terms long").agg(F.coalesce(F.sum("documents"), F.lit(0)).alias("documents"), F.coalesce(F.sum("terms"), F.lit(0)).alias("terms")).first()
    rows.mapInArrow(_indexed(n["documents"], n["terms"]), INDEX).write.options(**_WRITE).parquet(path)
    return Index(path, n["documents"], n["terms"])


class _Lookup:
    """A block's distinct terms, by hash; two that share a hash are told apart by their bytes."""

    def __init__(self, words: list[bytes]):
        order = sorted(range(len(words)), key=lambda i: _hash(words[i]))
        self.words, self.number = [words[i] for i in order], np.array(order, np.int64)
        self.hashes = np.fromiter(map(_hash, self.words), np.uint64, len(words))

    def found(self, batch: pa.RecordBatch, row: int) -> Iterator[tuple[int, int]]:
        """(number of a word of the block, its row in the shard) for each that the shard has."""
        hashes, ends = (np.frombuffer(batch.column(c)[row].as_buffer(), t) for c, t in (("hashes", np.uint64), ("ends", np.int64)))
        text = batch.column("terms")[row].as_buffer()
        for i, at in enumerate(np.searchsorted(hashes, self.hashes)):
            while at < len(hashes) and hashes[at] == self.hashes[i]:
                if text[int(ends[at - 1]) if at else 0 : int(ends[at])].to_pybytes() == self.words[i]:
                    yield int(self.number[i]), int(at)
                    break
                at += 1


def _frequencies(lookup: _Lookup):
    """Shards of a partition -> for each word of the block that some shard has: word, documents that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(lookup.words), np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                starts = np.frombuffer(batch.column("starts")[row].as_buffer(), np.int64)
                for word, at in lookup.found(batch, row):
                    total[word] += starts[at + 1] - starts[at]
        held = np.flatnonzero(total)
        yield pa.record_batch([pa.array(held.astype(np.int32)), pa.array(total[held])], ["word", "df"])

    return run


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The places of the k highest scores above 0, equal ones by ascending id; in no order."""
    some = np.flatnonzero(scores > 0)
    if len(some) <= k:
        return some
    kept = scores[some]
    least = kept[np.argpartition(kept, len(kept) - k)[len(kept) - k]]
    above, tied = some[kept > least], some[kept == least]
    return np.concatenate([above, tied[np.argsort(ids[tied], kind="stable")[: k - len(above)]]])


def _searched(lookup: _Lookup, items: list[dict[int, int]], weights: np.ndarray, k: int):
    """Shards of a partition -> (item, doc_id, score, part) of the partition's best k of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        top = [(none, none)] * len(items)
        for batch in batches:
            for row in range(batch.num_rows):
                get = lambda c, t: np.frombuffer(batch.column(c)[row].as_buffer(), t)  # noqa: E731, B023
                starts, docs, impact, ids = get("starts", np.int64), get("docs", np.uint16), get("impacts", np.int32), get("doc_ids", np.int64)
                here = {}
                for word, at in lookup.found(batch, row):
                    one = slice(starts[at], starts[at + 1])
                    here[word] = (docs[one], impact[one].astype(np.int64) * weights[word])
                scores = np.zeros(len(ids), np.int64)
                for q, words in enumerate(items):
                    scores[:] = 0
                    for word, times in words.items():
                        if word in here:
                            at, part = here[word]
                            scores[at] += part * times
                    at = best(scores, ids, k)
                    if len(at):
                        old, old_ids = top[q]
                        both, both_ids = np.concatenate([old, scores[at]]), np.concatenate([old_ids, ids[at]])
                        keep = best(both, both_ids, k)
                        top[q] = both[keep], both_ids[keep]
        sizes = [len(s) for s, _ in top]
        found = [np.concatenate([t[i] for t in top]) if top else none for i in (0, 1)]
        part = np.full(sum(sizes), TaskContext.get().partitionId() % MERGED, np.int32)
        yield pa.record_batch([pa.array(np.repeat(np.arange(len(top), dtype=np.int32), sizes)), pa.array(found[1]), pa.array(found[0]), pa.array(part)], ["item", "doc_id", "score", "part"])

    return run


def _blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """Items (item_id, text) block by block; no more than one block and a partition are on the driver."""
    block, size = [], 0
    for r in items.toLocalIterator():
        block.append((r["item_id"], bytes(r["text"] or b"")))
        size += len(block[-1][1])
        if len(block) >= BLOCK_ITEMS or size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def search(index: Index, items: DataFrame, k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: each item's k best documents with a score above 0, equal scores by ascending doc_id.

    Every row of items is an item of its own, also one that repeats another. A null or empty text finds nothing; a null
    item_id is carried; documents that repeat a doc_id are ranked each, those with a null one last among equal scores; texts
    of any length count whole; an empty table on either side gives no rows; other columns are ignored.
    """
    spark = items.sparkSession
    schema = "item_id long, rank int, doc_id long, score long"
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").cast("binary").alias("text"))
    path = scratch_path(spark, "lexical-found")
    written = False
    for number, block in enumerate(_blocks(rows) if index.documents else ()):
        found = _block(index, spark, [i for i, _ in block], [terms(t) for _, t in block], k)
        if found is not None:
            found.write.parquet(f"{path}/block={number}")
            written = True
    return spark.read.schema(schema).parquet(path).select("item_id", "rank", "doc_id", "score") if written else spark.createDataFrame([], schema)


def _block(index: Index, spark: SparkSession, ids: list[int | None], texts: list[list[bytes]], k: int) -> DataFrame | None:
    words = sorted({w for t in texts for w in t})
    if not words:
        return None
    number = {w: i for i, w in enumerate(words)}
    lookup, shards = _Lookup(words), index.read(spark)
    df = np.zeros(len(words), np.int64)
    for r in shards.select("hashes", "ends", "terms", "starts").mapInArrow(_frequencies(lookup), "word int, df long").groupBy("word").agg(F.sum("df").alias("df")).collect():  # at most a row a word of the block
        df[r["word"]] = r["df"]
    weights = np.array([math.floor(1000 * math.log((2 * index.documents + 2) / (2 * int(n) + 1))) for n in df], np.int64)
    items = [dict(Counter(number[w] for w in t)) for t in texts]
    found = shards.mapInArrow(_searched(lookup, items, weights, k), "item int, doc_id long, score long, part int")
    order = [F.col("score").desc(), F.col("doc_id").asc()]
    parts = found.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).where(F.col("rank") <= k)
    ranked = parts.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
    named = F.broadcast(spark.createDataFrame(list(enumerate(ids)), "n int, item_id long"))  # BLOCK_ITEMS rows at most
    doc_id = F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id")
    return ranked.join(named, F.col("item") == F.col("n")).select("item_id", "rank", doc_id, "score")


def search_documents(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """Index docs in the shared folder and search for items; see search() for odd rows."""
    return search(build(docs), items, k)
