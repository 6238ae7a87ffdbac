"""Removal of repeated 100-byte strings by a distributed difference-cover suffix comparison.

A difference cover samples positions so that any two equal strings have a sampled position at the same offset. The
textbook cover, two of every three positions, sorts eight bytes and more for most positions of the corpus; here the
cover is content-defined: of the 32-byte strings in each 100-byte window the one with the least hash is sampled (the
leftmost of equals), so equal windows sample the same offset and about one position in 35 is kept.

1. Each sampled position stands for the run of windows that chose it. The triple (first window, last window, length)
   names the run, and sorting the named samples puts equal runs side by side, the earliest first: every other one
   repeats it in full.
2. Names are at least 100 bytes deep, the depth asked for, so the recursion on names ends at its first level.
3. The remaining suffixes are the windows of first runs whose sample also occurs with another name, that is, at the
   borders of repeats. They are named by their 100 bytes, merged and sorted among themselves.
4. Equal neighbours in either order are repeats of the earliest.

Names are 128-bit hashes of the bytes, in any order that puts equals together. Each task drops its own repeats before
the shuffle, so a string that all documents hold reaches its bucket once a task. Names are dealt by their sample, so
that one bucket sees whether a sample has several; the names of a sample that a look at some documents finds in many
runs, as of a short line that many documents share, are dealt one by one, since it is known to have several.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keyed, materialize, shuffle_partitions

LENGTH, GRAM = 100, 32
WINDOW = LENGTH - GRAM + 1  # 32-byte strings in a window
PIECE = 1 << 20  # windows that are hashed at a time
NULL_ID = -(2**63)
#: Documents that the look for hot samples aims at, at least, and its share beyond; a sample is hot from so many names
#: in it on, and at most so many samples are. Only the dealing hangs on them, never a result.
LOOK, LOOK_SHARE, HOT, MOST_HOT = 4000, 256, 8, 200_000

_SPANS = "doc_id long, text_key long, lo long, n int, kind int"
_ROWS = "bucket int, kind int, names binary, samples binary, doc_ids binary, text_keys binary, los binary, ns binary"
_C = np.uint64(0x9E3779B97F4A7C15)
_D = np.uint64(0xD6E8FEB86659FD93)
_E = np.uint64(0xA0761D6478BD642F)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * _C
    return x ^ (x >> np.uint64(32))


def _join(a: np.ndarray, b: np.ndarray, by: int) -> np.ndarray:
    """Hashes of strings: a's, then b's that start `by` bytes on."""
    n = max(0, min(len(a), len(b) - by))
    return _mix(a[:n] * _D + b[by : by + n])


def _hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the 4-byte and the 32-byte strings at every position."""
    h = data.astype(np.uint64) + np.uint64(1)
    four = None
    for by in (1, 2, 4, 8, 16):
        h = _join(h, h, by)
        if by == 2:
            four = h
    return four, h


def _names(parts: list[np.ndarray]) -> np.ndarray:
    """Two 64-bit hashes, mixed apart, of each row of the parts."""
    halves = []
    for by, seed in ((_D, np.uint64(0)), (_E, np.uint64(0x589965CC75374CC3))):
        h = parts[0] ^ seed
        for part in parts[1:]:
            h = _mix(h * by + part)
        halves.append(_mix(h))
    return np.stack(halves, axis=1)


def _parts(four: np.ndarray, gram: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """What the 100-byte strings at the positions `at` are made of."""
    return [gram[at], gram[at + 32], gram[at + 64], four[at + 96]]


def _changes(name: np.ndarray) -> np.ndarray:
    """Which rows of sorted names differ from the one before; the first does."""
    return np.concatenate([[True], (name[1:] != name[:-1]).any(axis=1)])


def _order(name: np.ndarray, *then: np.ndarray) -> np.ndarray:
    """By name, then by the others, the first of them foremost."""
    return np.lexsort((*then[::-1], name[:, 1], name[:, 0]))


def sample_runs(data: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, ...]:
    """(first window, windows, name, sample) of each run; data: bytes, valid: which positions start a window."""
    if len(data) < LENGTH or not valid.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 2), np.uint64), np.zeros(0, np.uint32)
    four, gram = _hashes(data)
    least = (gram >> np.uint64(24) << np.uint64(24)) | np.arange(len(gram), dtype=np.uint64)
    for by in (1, 2, 4, 8, 16, 32):
        least = np.minimum(least[:-by], least[by:])
    least = np.minimum(least[: len(least) - (WINDOW - 64)], least[WINDOW - 64 :])
    at = np.flatnonzero(valid[: len(least)])
    chosen = (least[at] & np.uint64(0xFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (at[1:] != at[:-1] + 1)]))
    lo, hi = at[new], at[np.concatenate([new[1:], [len(at)]]) - 1]
    n = hi - lo + 1
    name = _names([*_parts(four, gram, lo), *_parts(four, gram, hi), n.astype(np.uint64)])
    sample = (_mix(gram[chosen[new]] * _D + np.uint64(7)) >> np.uint64(32)).astype(np.uint32)
    return lo, n, name, sample


class _Found:
    """What a task has found, until it deals it to buckets."""

    def __init__(self):
        self.columns: list[tuple[np.ndarray, ...]] = []

    def add(self, name, sample, doc_id, text_key, lo, n):
        self.columns.append((name, sample, doc_id, text_key, lo, n))

    def dealt(self, buckets: int, hot: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        """The first of each name by its bucket (kind 0); the task's own repeats by document (kind 1). Buckets go by
        name, or if `hot` is given, by sample for all but these samples."""
        if not self.columns:
            return
        name, sample, doc_id, text_key, lo, n = (np.concatenate(c) for c in zip(*self.columns))
        self.columns.clear()
        order = _order(name, doc_id, text_key, lo)
        first = _changes(name[order])
        for kind, rows in ((0, order[first]), (1, order[~first])):
            key = name[rows, 0] if kind == 0 else text_key[rows].view(np.uint64)
            if kind == 0 and hot is not None:
                key = np.where(np.isin(sample[rows], hot), key, sample[rows].astype(np.uint64))
            bucket = (key % np.uint64(buckets)).astype(np.int32)
            rows = rows[np.lexsort((lo[rows], text_key[rows], doc_id[rows], bucket))]
            bucket = np.sort(bucket)
            cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(rows) else []
            for a, b in zip(cuts[:-1], cuts[1:]):
                r = rows[a:b]
                blobs = (name[r] if kind == 0 else name[:0], sample[r] if kind == 0 else sample[:0], doc_id[r], text_key[r], lo[r].astype("<i8" if lo[r].max() >= 2**31 else "<i4"), n[r].astype("<u1"))
                yield pa.record_batch(
                    [pa.array([bucket[a]], pa.int32()), pa.array([kind], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in blobs]],
                    ["bucket", "kind", "names", "samples", "doc_ids", "text_keys", "los", "ns"],
                )


def _new_documents(batch: pa.RecordBatch, seen: set) -> list[int]:
    """Rows of the batch whose (doc_id, text_key) the task hasn't had: repeated rows are one document."""
    out = []
    for i, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
        if key not in seen:
            seen.add(key)
            out.append(i)
    return out


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Parts of batches, so that few texts are held as Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _found_samples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The runs of each batch of new documents: name, sample, doc_id, text_key, lo, n."""
    seen: set = set()
    for batch in _slices(batches):
        take = _new_documents(batch, seen)
        if len(take) < batch.num_rows:
            batch = batch.take(pa.array(take, pa.int64()))
        if not batch.num_rows:
            continue
        doc_id, text_key = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        texts = [t.encode("utf-8", "surrogatepass") for t in batch.column(2).to_pylist()]
        data = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.cumsum([len(t) for t in texts])
        starts = ends - [len(t) for t in texts]
        del texts
        for at in range(0, len(data), PIECE):
            part = data[at : at + PIECE + LENGTH - 1]
            valid = np.ones(min(PIECE, len(part)), bool)
            for d in range(int(np.searchsorted(ends, at, "right")), len(ends)):
                if starts[d] >= at + PIECE + LENGTH:
                    break
                valid[max(0, max(starts[d], ends[d] - LENGTH + 1) - at) : max(0, ends[d] - at)] = False
            lo, n, name, sample = sample_runs(part, valid)
            d = np.searchsorted(ends, lo + at, "right")
            yield name, sample, doc_id[d], text_key[d], lo + at - starts[d], n


def _sampled(buckets: int, hot: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _Found()
        for columns in _found_samples(batches):
            found.add(*columns)
        yield from found.dealt(buckets, hot)

    return run


def _names_of_samples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for name, sample, *_ in _found_samples(batches):
        pairs = np.unique(np.stack([sample.astype(np.uint64), name[:, 0]], axis=1), axis=0)
        yield pa.record_batch([pa.array(pairs[:, 0].astype(np.int64)), pa.array(pairs[:, 1].astype(np.int64))], ["sample", "name"])


def hot_samples(rows: DataFrame) -> np.ndarray:
    """Samples with HOT names or more in some of the documents, in rising order."""
    share = max(1, min(rows.count() // LOOK, LOOK_SHARE))
    some = rows.where(F.octet_length("text") >= LENGTH).where(F.pmod(F.xxhash64(F.lit("look"), "text_key"), F.lit(share)) == 0)
    names = some.mapInArrow(_names_of_samples, "sample long, name long").distinct().groupBy("sample").agg(F.count("*").alias("n"))
    hot = names.where(F.col("n") >= HOT).orderBy(F.desc("n"), "sample").limit(MOST_HOT).collect()
    return np.sort(np.array([r["sample"] for r in hot], np.uint32))


def _gathered(batches: Iterator[pa.RecordBatch]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """A bucket's rows: columns of firsts (name, sample, doc_id, text_key, lo, n), and of known repeats (the last four)."""
    types = (np.uint64, np.uint32, np.int64, np.int64, None, np.uint8)
    kept: tuple[list, list] = ([], [])
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns[1:])):
            n = len(row[6])
            cols = [np.frombuffer(x, t or f"<i{len(x) // max(n, 1)}") for x, t in zip(row[1:], types)]
            cols[0], cols[4] = cols[0].reshape(-1, 2), cols[4].astype(np.int64)
            kept[row[0]].append(cols)
    merge = lambda rows, at: [np.concatenate([r[i] for r in rows]) if rows else np.zeros(0, types[i] or np.int64) for i in at]
    return merge(kept[0], range(6)), merge(kept[1], range(2, 6))


def _spans(doc_id, text_key, lo, n, kind: int, size: int = 1 << 17) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(lo), size):
        cols = [doc_id[at : at + size], text_key[at : at + size], lo[at : at + size], n[at : at + size].astype(np.int32)]
        yield pa.record_batch([*[pa.array(c) for c in cols], pa.array(np.full(len(cols[0]), kind, np.int32))], ["doc_id", "text_key", "lo", "n", "kind"])


def _compared(hot: np.ndarray | None = None):
    """Sorts a bucket's names: repeats of an earlier run are kind 0; with `hot`, first runs whose sample has another name kind 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (name, sample, doc_id, text_key, lo, n), known = _gathered(batches)
        yield from _spans(*known, 0)
        if not len(name):
            return
        order = _order(name, doc_id, text_key, lo)
        name, sample, doc_id, text_key, lo, n = (c[order] for c in (name, sample, doc_id, text_key, lo, n))
        first = _changes(name)
        head = np.flatnonzero(first)[np.cumsum(first) - 1]
        again = ~first & ~((doc_id == doc_id[head]) & (text_key == text_key[head]) & (lo == lo[head]))  # not the same place of a repeated row
        yield from _spans(doc_id[again], text_key[again], lo[again], n[again], 0)
        if hot is not None:
            f = np.flatnonzero(first)
            _, number, count = np.unique(sample[f], return_inverse=True, return_counts=True)
            f = f[(count[number] > 1) | np.isin(sample[f], hot)]
            yield from _spans(doc_id[f], text_key[f], lo[f], n[f], 1)

    return run


def _windows(buckets: int):
    """(doc_id, text_key, text, los, ns): the windows of the runs, by their 100 bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, seen = _Found(), set()
        for batch in _slices(batches):
            rows = set(_new_documents(batch, seen))
            cuts, sizes, place = [], [], []
            total = 0

            def hashed():
                data = np.frombuffer(b"".join(cuts), np.uint8)
                four, gram = _hashes(data)
                d, k, lo, n = (np.array(x) for x in zip(*place))
                start = np.cumsum(sizes) - sizes
                step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                name = _names(_parts(four, gram, np.repeat(start, n) + step))
                found.add(name, np.zeros(len(name), np.uint32), np.repeat(d, n), np.repeat(k, n), np.repeat(lo, n) + step, np.ones(len(name), np.int64))

            for i, (d, k, text, los, ns) in enumerate(zip(*(c.to_pylist() for c in batch.columns))):
                if i not in rows:
                    continue
                raw = text.encode("utf-8", "surrogatepass")
                for lo, n in zip(los, ns):
                    cuts.append(raw[lo : lo + n + LENGTH - 1])
                    sizes.append(n + LENGTH - 1)
                    place.append((d, k, lo, n))
                    total += n + LENGTH
                if total > PIECE:
                    hashed()
                    cuts, sizes, place, total = [], [], [], 0
            if place:
                hashed()
        yield from found.dealt(buckets)

    return run


def cut(text: str, los: list[int], ns: list[int]) -> tuple[bytes, int, int]:
    """What is left of the bytes, how many went, in how many runs."""
    raw = text.encode("utf-8", "surrogatepass")
    if not los:
        return raw, 0, 0
    lo = np.array(los)
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], (lo + np.array(ns) + LENGTH - 1)[order]
    reach = np.maximum.accumulate(hi)
    new = np.concatenate([[True], lo[1:] > reach[:-1]])
    a, b = lo[new], reach[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(lo) - 1]])]
    left, at = [], 0
    for x, y in zip(a.tolist(), b.tolist()):
        left.append(raw[at:x])
        at = y
    left.append(raw[at:])
    return b"".join(left), int((b - a).sum()), len(a)


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        out = []
        for text, los, ns in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
            left, removed, runs = cut(text, los or [], ns or [])
            out.append((len(left) + removed, removed, runs, hashlib.sha256(left).hexdigest()))
        cols = [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))]
        yield pa.record_batch([batch.column(0), *cols], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _rows(docs: DataFrame) -> DataFrame:
    return keyed(docs).select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc_id"), "text_key", "text")


def _repeats(rows: DataFrame) -> DataFrame:
    buckets = shuffle_partitions(rows.sparkSession)
    hot = hot_samples(rows)
    sampled = rows.where(F.octet_length("text") >= LENGTH).mapInArrow(_sampled(buckets, hot), _ROWS)
    named = materialize(sampled.repartitionById(buckets, F.col("bucket")).mapInArrow(_compared(hot), _SPANS), "suffix-runs")
    unsettled = named.where("kind = 1").groupBy(F.col("doc_id").alias("u_id"), F.col("text_key").alias("u_key")).agg(F.collect_list(F.struct("lo", "n")).alias("u"))
    open_rows = rows.join(unsettled, (F.col("doc_id") == F.col("u_id")) & (F.col("text_key") == F.col("u_key"))).select("doc_id", "text_key", "text", "u.lo", "u.n")
    merged = open_rows.mapInArrow(_windows(buckets), _ROWS).repartitionById(buckets, F.col("bucket")).mapInArrow(_compared(), _SPANS)
    return named.where("kind = 0").unionByName(merged).select("doc_id", "text_key", "lo", "n")


def repeats(docs: DataFrame) -> DataFrame:
    """doc_id (a null one as NULL_ID), text_key, lo, n: windows lo .. lo + n - 1 (bytes) of the document occur earlier."""
    return _repeats(_rows(docs))


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of docs.

    Earlier means a smaller doc_id (null: before all), or the same document at an earlier start; documents that
    share a doc_id but not the text stand in the order of their text's hash; rows repeated in full are one document
    and get the same result each. A null or short text loses nothing; an empty table gives no rows; other columns
    are ignored. A text of any length is read whole by one task, in pieces of a million windows. Both joins take the texts from the same exchange, so they are shuffled once.
    """
    rows = _rows(docs)
    found = _repeats(rows).groupBy(F.col("doc_id").alias("r_id"), F.col("text_key").alias("r_key")).agg(F.collect_list(F.struct("lo", "n")).alias("r"))
    joined = rows.join(found, (F.col("doc_id") == F.col("r_id")) & (F.col("text_key") == F.col("r_key")), "left")
    doc_id = F.nullif(F.col("doc_id"), F.lit(NULL_ID)).alias("doc_id")
    return joined.select(doc_id, "text", F.col("r.lo").alias("los"), F.col("r.n").alias("ns")).mapInArrow(_finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
