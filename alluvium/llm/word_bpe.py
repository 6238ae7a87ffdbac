"""BPE encoding and decoding through a table of distinct words.

Documents are dealt into blocks. Each block's distinct words go, packed, to buckets by a hash of the word; a bucket
encodes each of its words once, whatever the number of blocks that have it, and answers every block with the ids.
The block joins them back by position and decodes each word through the id-to-piece table. A word that all blocks
share reaches its bucket once a block, so no bucket grows with the number of its occurrences. Rows that repeat both
doc_id and text are counted first, and where there are many of them one is encoded and its result repeated.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, each_copy, materialize, shuffle_partitions, text_of
from .pretoken import CaselessWords, default_path

#: Blocks per shuffle partition: more blocks deal more evenly, fewer share more words.
BLOCKS = 2
#: Rows with one doc_id and text, from so many on, are encoded once: a block would hold them all.
MANY = 1000


def _packed(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _unpacked(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _by_bucket(words: set[str], buckets: int) -> dict[int, list[str]]:
    """The same lists in the same order wherever the same texts meet."""
    out: dict[int, list[str]] = {}
    for w in sorted(words):
        out.setdefault(zlib.crc32(w.encode("utf-8", "surrogatepass")) % buckets, []).append(w)
    return out


def _distinct(path: str, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, found = CaselessWords(path).split, {}
        for batch in batches:
            for block, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                found.setdefault(block, set()).update(split(text))
        for block in sorted(found):
            rows = _by_bucket(found.pop(block), buckets)
            yield pa.record_batch(
                [pa.array(list(rows), pa.int32()), pa.array([block] * len(rows), pa.int32()), pa.array([_packed("\n".join(w).encode("utf-8", "surrogatepass")) for w in rows.values()], pa.binary())],
                ["bucket", "block", "words"],
            )

    return run


def _encode(path: str):
    """Rows (bucket, block, words) of whole buckets -> (block, bucket, counts, ids) in the words' order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, rows = CaselessWords(path), []
        for batch in batches:
            rows += [(a, b, _unpacked(w).decode("utf-8", "surrogatepass")) for a, b, w in zip(*(batch.column(i).to_pylist() for i in range(3)))]
        by_bucket: dict[int, list] = {}
        for bucket, block, words in rows:
            by_bucket.setdefault(bucket, []).append((block, words))
        del rows
        for bucket, asked in by_bucket.items():
            distinct = list({w for _, words in asked for w in words.split("\n")})
            known = {}
            for at in range(0, len(distinct), 20_000):
                part = distinct[at : at + 20_000]
                known.update((w, np.array(i, "<u4").tobytes()) for w, i in zip(part, tok.encode_words(part)))
            for block, words in asked:
                ids = [known[w] for w in words.split("\n")]
                counts = np.fromiter((len(x) // 4 for x in ids), "<u4", len(ids))
                packed = np.frombuffer(b"".join(ids), "<u4")
                small = lambda a: a.astype("<u2").tobytes() if not len(a) or a.max() < 65536 else b"\0" + a.tobytes()
                yield pa.record_batch(
                    [pa.array([block], pa.int32()), pa.array([bucket], pa.int32()), pa.array([_packed(small(counts))], pa.binary()), pa.array([_packed(small(packed))], pa.binary())],
                    ["block", "bucket", "counts", "ids"],
                )

    return run


def _wide(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u4", offset=1) if len(data) % 2 else np.frombuffer(data, "<u2").astype("<u4")


def _assemble(path: str, buckets: int, texts_out: bool, kept: list[str]):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        tok = CaselessWords(path)
        pieces = tok.pieces()
        split = [tok.split(t) for t in docs.column("text").to_pylist()]
        words = _by_bucket({w for s in split for w in s}, buckets)
        ids_of: dict[str, bytes] = {}
        text_of_word: dict[str, str] = {}
        for bucket, counts, ids in zip(*(answers.column(c).to_pylist() for c in ("bucket", "counts", "ids"))):
            counts, ids = _wide(_unpacked(counts)).tolist(), _wide(_unpacked(ids))
            flat, raw, at = ids.tolist(), ids.tobytes(), 0
            for w, n in zip(words[bucket], counts, strict=True):
                ids_of[w] = raw[at * 4 : (at + n) * 4]
                text_of_word[w] = " ".join([pieces[i] for i in flat[at : at + n]])
                at += n
        n_tokens, id_sha, text_sha, id_out, text_out = [], [], [], [], []
        for s in split:
            raw = b"".join([ids_of[w] for w in s])
            decoded = " ".join([text_of_word[w] for w in s])
            n_tokens.append(len(raw) // 4)
            id_sha.append(hashlib.sha256(raw).hexdigest())
            text_sha.append(hashlib.sha256(decoded.encode()).hexdigest())
            if texts_out:
                id_out.append(np.frombuffer(raw, "<u4").astype(np.int32))
                text_out.append(decoded)
        out = {c: docs.column(c) for c in kept} | {"n_tokens": pa.array(n_tokens, pa.int64()), "ids_sha256": pa.array(id_sha, pa.string()), "decoded_sha256": pa.array(text_sha, pa.string())}
        if texts_out:
            out |= {"ids": pa.array(id_out, pa.list_(pa.int32())), "decoded": pa.array(text_out, pa.string())}
        return pa.table(out)

    return run


def encode_decode(docs: DataFrame, tokenizer: str | None = None, outputs: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every row of docs; with `outputs` also ids and decoded.

    A null or empty text has no tokens and decodes to the empty string; null and repeated doc_ids are rows like any
    other; an empty table gives no rows; other columns are ignored. A text of any length is split whole, in one task,
    which holds the texts of its block. Special tokens' strings in a text are special
    tokens, as in the library. The number of blocks and buckets follows spark.sql.shuffle.partitions.
    """
    spark = docs.sparkSession
    path = tokenizer or default_path("word_bpe_49k.json")
    parts = shuffle_partitions(spark)
    rows = _counted(docs)
    kept = [c for c in rows.columns if c != "text"]
    block = F.pmod(F.xxhash64(F.lit("block"), F.col("doc_id"), F.xxhash64("text")), F.lit(parts * BLOCKS)).cast("int")
    dealt = rows.select(block.alias("block"), "doc_id", "text", *kept[1:]).repartition(parts, "block")
    words = dealt.mapInArrow(_distinct(path, parts), "bucket int, block int, words binary")
    answers = words.repartitionById(parts, F.col("bucket")).mapInArrow(_encode(path), "block int, bucket int, counts binary, ids binary")
    schema = ", ".join([*[f"{c} long" for c in kept], "n_tokens long, ids_sha256 string, decoded_sha256 string"]) + ", ids array<int>, decoded string" * outputs
    done = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_assemble(path, parts, outputs, kept), schema)
    return each_copy(done, "copies", "copy").drop("copies", "copy") if len(kept) > 1 else done


def _counted(docs: DataFrame) -> DataFrame:
    """doc_id and text of every row, or where MANY or more rows are equal, one of them with their number in copies."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    counts = rows.groupBy(F.col("doc_id").alias("m_id"), F.xxhash64("text").alias("m_key")).agg(F.count("*").alias("copies"))
    many = materialize(counts.where(F.col("copies") >= MANY), "bpe-many")
    n = many.count()
    if not n:
        return rows
    same = F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.xxhash64("text") == F.col("m_key"))
    joined = rows.join(broadcast_if_small(many, n), same, "left")
    once = joined.where("copies IS NOT NULL").groupBy("m_id", "m_key").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.first("copies").alias("copies"))
    single = joined.where("copies IS NULL").select("doc_id", "text", F.lit(1).cast("long").alias("copies"))
    return single.unionByName(once.select("doc_id", "text", "copies"))
