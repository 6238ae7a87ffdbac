"""Token ids as binary shards with Elias-Fano document boundaries.

Shard files, in ascending doc_id order:
- `NNNNN.ids`: the ids of the shard's documents, concatenated, little-endian, 2 bytes each if the vocabulary allows,
  otherwise 4. Each document ends with the end id.
- `NNNNN.ef`: b"ALTK", version, bytes an id, number of documents with a null doc_id (they come first), then two
  Elias-Fano lists: where each document ends in the ids, and the other documents' ids (doc_id), both sorted.
Where a shard starts in the whole array is the sum of the lengths before it, kept in `manifest`: one row a shard.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import elias_fano
from .common import scratch_path, shuffle_partitions, text_of
from .pretoken import byte_level_words, default_path, load

MAGIC = "<4sBBQ"
#: A shard holds about so many bytes of text, or less where the cluster asks for more parts.
SHARD_TEXT = 64 << 20
#: At most so many cut points between shards are sent to the tasks.
MOST_SHARDS = 1 << 17


#: Documents whose boundaries are read at a time.
BLOCK = 4096
#: Schemes of Hadoop's file systems that pyarrow knows under another name.
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme and host that Spark would write it to, so that tasks meet in the same place."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _fs(path: str):
    """pyarrow's file system for a qualified path, and the path in it."""
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}:{rest}")


def _encode(path: str, end_id: int, dtype: str, cuts: np.ndarray, leading: int):
    """(doc_id, text) -> (shard, doc_id, ids). Null doc_ids are dealt to the `leading` first shards in turn, and so are equal
    ones that fill several shards to these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, turn, end = byte_level_words(path, dtype), 0, np.array([end_id], dtype).tobytes()
        for batch in batches:
            ids = [words.encode(t or "") + end for t in batch.column(1).to_pylist()]
            doc = batch.column(0)
            known = doc.is_valid().to_numpy(zero_copy_only=False)
            value = np.where(known, doc.fill_null(0).to_numpy(zero_copy_only=False), -(2**63))
            lo, hi = np.searchsorted(cuts, value, "left"), np.searchsorted(cuts, value, "right")
            nth = np.arange(len(value)) + turn
            shard = np.where(known, leading + lo + nth % (hi - lo + 1), nth % max(leading, 1))
            turn += len(value)
            yield pa.record_batch([pa.array(shard.astype(np.int32)), doc, pa.array(ids, pa.binary())], ["shard", "doc_id", "ids"])

    return run


def _write(folder: str, dtype: str):
    """Sorted (shard, doc_id, ids) of whole shards -> files and a manifest row each. A repeated task writes other
    names; only those in the manifest are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = _fs(folder)
        fs.create_dir(at)
        width = np.dtype(dtype).itemsize
        now, out, name, lengths, doc_ids, nulls, rows = None, None, "", [], [], 0, []

        def close():
            if now is None:
                return
            out.close()
            ends = np.cumsum(np.array(lengths, np.int64))
            with fs.open_output_stream(f"{at}/{name}.ef") as f:
                f.write(struct.pack(MAGIC, b"ALTK", 1, width, nulls) + elias_fano.encode(ends) + elias_fano.encode(np.array(doc_ids, np.int64)))
            rows.append((now, name, len(lengths), int(ends[-1])))

        for batch in batches:
            shards, docs, ids = (batch.column(i).to_pylist() for i in range(3))
            for s, d, x in zip(shards, docs, ids):
                if s != now:
                    close()
                    now, name, lengths, doc_ids, nulls = s, f"{s:05d}-{uuid.uuid4().hex[:8]}", [], [], 0
                    out = fs.open_output_stream(f"{at}/{name}.ids")
                out.write(x)
                lengths.append(len(x) // width)
                if d is None:
                    nulls += 1
                else:
                    doc_ids.append(d)
        close()
        yield pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.string(), pa.int64(), pa.int64()))], ["shard", "name", "n_docs", "n_ids"])

    return run


def write_tokens(docs: DataFrame, folder: str | None = None, tokenizer: str | None = None, end_id: int = 0) -> tuple[str, list[tuple]]:
    """Encode every text and write the shards; returns the folder and the manifest [(shard, name, n_docs, n_ids)].

    A null or empty text gives the end id alone; null doc_ids come first, over as many shards as their texts fill; equal doc_ids stand next to each other, by
    their ids; an empty table writes no shard; other columns are ignored; a text of any length is encoded whole. The manifest is one short row per shard of
    up to 64 MB of text, and the cut points between shards are quantiles of doc_id, at most MOST_SHARDS.
    """
    spark = docs.sparkSession
    path = tokenizer or default_path("byte_bpe_50k.json")
    folder = qualified(spark, folder or scratch_path(spark, "tokens"))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    size = F.octet_length("text") + 1
    none = F.col("doc_id").isNull()
    total = ids.agg(F.sum(size).alias("n"), F.count("*").alias("rows"), F.coalesce(F.sum(F.when(none, size)), F.lit(0)).alias("null_n"), F.count_if(none).alias("nulls")).first()
    if not total["rows"]:
        return folder, []
    shards = min(MOST_SHARDS, max(shuffle_partitions(spark), -(-int(total["n"]) // SHARD_TEXT)))
    # null doc_ids get their share of the shards, one at least; known ones the others
    some = total["nulls"] < total["rows"]
    leading = min(max(1, round(shards * total["null_n"] / total["n"])), max(1, shards - some)) if total["nulls"] else 0
    known = max(1, shards - leading) if some else 0
    found = ids.agg(F.percentile_approx("doc_id", F.lit([i / known for i in range(1, known)]), max(10_000, 10 * known))).first()[0] if known > 1 else []
    cuts = np.array(found or [], np.int64)
    dtype = "<u2" if max(load(path).get_vocab_size(True), end_id + 1) <= 65536 else "<u4"
    encoded = ids.mapInArrow(_encode(path, end_id, dtype, cuts, leading), "shard int, doc_id long, ids binary")
    dealt = encoded.repartitionById(leading + known, F.col("shard")).sortWithinPartitions("shard", "doc_id", "ids")
    made = dealt.mapInArrow(_write(folder, dtype), "shard int, name string, n_docs long, n_ids long")
    return folder, sorted(tuple(r) for r in made.collect())


def _read(folder: str, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = _fs(folder)
        for batch in batches:
            for name, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with fs.open_input_file(f"{at}/{name}.ef") as f:
                    head = f.read()
                magic, version, width, nulls = struct.unpack_from(MAGIC, head)
                if magic != b"ALTK" or version != 1:
                    raise ValueError(f"{name}.ef is not a boundary file")
                ends = elias_fano.EliasFano(head, struct.calcsize(MAGIC))
                doc_ids = elias_fano.EliasFano(head, ends.end)
                last = 0
                with fs.open_input_stream(f"{at}/{name}.ids") as f:
                    for i in range(0, ends.n, block):
                        stops = ends.select(i, i + block)
                        starts = np.concatenate([[last], stops[:-1]]).astype(np.int64)
                        last = int(stops[-1])
                        crcs = np.zeros(len(stops), np.int64)
                        for k, n in enumerate((stops - starts).tolist()):
                            ids = np.frombuffer(f.read(n * width), f"<u{width}")
                            if len(ids) != n:
                                raise ValueError(f"{name}.ids ends early")
                            crcs[k] = zlib.crc32(ids.astype("<u4").tobytes())
                        none = min(max(nulls - i, 0), len(stops))
                        docs = pa.concat_arrays([pa.nulls(none, pa.int64()), pa.array(doc_ids.select(max(i - nulls, 0), max(i + len(stops) - nulls, 0)), pa.int64())])
                        yield pa.record_batch([docs, pa.array(starts + before), pa.array(stops - starts), pa.array(crcs)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def read_tokens(spark: SparkSession, folder: str, manifest: list[tuple], block: int = BLOCK) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files; boundaries by select, `block` at a time."""
    before, rows = 0, []
    for _, name, _, n in sorted(manifest):
        rows.append((name, before))
        before += n
    parts = spark.createDataFrame(rows, "name string, before long").repartition(max(1, len(rows)))
    return parts.mapInArrow(_read(qualified(spark, folder), block), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame) -> DataFrame:
    """Write docs as token shards in the shared folder and read them back; see write_tokens for odd rows."""
    folder, manifest = write_tokens(docs)
    return read_tokens(docs.sparkSession, folder, manifest)
