"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A document's features are its words and the shapes of its words (letters, capitals and digits as classes, runs as one),
each hashed to a bucket and weighted by its share; the statistics of quality.features() in logarithmic bins; and the
metadata columns that the caller names, in logarithmic bins too. Every pair of features interacts through the product of
two short vectors; the sum over all pairs is taken in time linear in the features, as half the difference between the
square of the summed vectors and the sum of their squares.

It is learned from a bounded sample of labelled rows (SAMPLE of each label, by hash of doc_id and text), whose buckets and
weights, not texts, go to the driver; a fifth of the sample calibrates the scores. Scoring reads whole texts in tasks.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import quality
from .common import text_of

BUCKETS = 1 << 13
FACTORS = 8
#: Labelled documents of each label to learn from. A document weighs 6 bytes a bucket it has: 48 KB at most, about 2 KB
#: for one of 300 words.
SAMPLE = 6_000
EPOCHS, RATE, BATCH, PENALTY, SEED = 10, 0.1, 64, 1e-5, 5
THRESHOLD = 0.3
#: Documents that are scored at a time, and the bytes of text beyond which fewer are.
CHUNK, CHUNK_BYTES = 256, 4 << 20

_CLASS = bytes(
    ord("A") if 65 <= c <= 90 else ord("a") if 97 <= c <= 122 or c >= 128 else ord("0") if 48 <= c <= 57 else c for c in range(256)
)
_RUN = re.compile(rb"(.)\1+", re.S)
_STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *quality.FEATURES)


def _bucket(kind: bytes, value: bytes) -> int:
    return zlib.crc32(kind + value) & (BUCKETS - 1)


def _bin(value: float) -> int:
    """The nearest half power of two; 0 has a bin of its own."""
    return -99 if value <= 0 else round(2 * math.log2(value))


def features(text: str, metadata: dict[str, float | None]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted buckets and their weights; never none, since every text has statistics."""
    raw = text.encode("utf-8", "surrogatepass")
    weights: Counter[int] = Counter()
    for kind, counts in ((b"w", Counter(raw.split())), (b"s", Counter(raw.translate(_CLASS).split()))):
        if kind == b"s":
            shapes: Counter[bytes] = Counter()
            for shape, n in counts.items():
                shapes[_RUN.sub(rb"\1", shape)] += n
            counts = shapes
        length = math.sqrt(sum(n * n for n in counts.values())) or 1.0
        for value, n in counts.items():
            weights[_bucket(kind, value)] += n / length
    for name, value in zip(_STATISTICS, quality.features(text)):
        if name not in ("word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"):  # their shares are there
            weights[_bucket(b"q", f"{name}:{_bin(value)}".encode())] += 0.5
    for name, value in metadata.items():
        weights[_bucket(b"m", f"{name}:{'-' if value is None else _bin(value)}".encode())] += 0.25
    at = np.fromiter(weights, np.uint16, len(weights))
    order = np.argsort(at)
    return at[order], np.fromiter(weights.values(), np.float32, len(weights))[order]


def _flat(rows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All buckets, all weights, and where each row starts."""
    starts = np.cumsum([0, *[len(at) for at, _ in rows[:-1]]])
    return np.concatenate([at for at, _ in rows]).astype(np.int64), np.concatenate([x for _, x in rows]).astype(np.float64), starts


@dataclass
class Machine:
    bias: float
    linear: np.ndarray  # BUCKETS
    factors: np.ndarray  # BUCKETS x FACTORS
    slope: float = 1.0
    shift: float = 0.0

    def raw(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        at, x, starts = _flat(rows)
        vx = self.factors[at] * x[:, None]
        total = np.add.reduceat(vx, starts)
        squares = np.add.reduceat(vx * vx, starts)
        return self.bias + np.add.reduceat(self.linear[at] * x, starts) + 0.5 * (total * total - squares).sum(1)

    def scores(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        return _sigmoid(self.slope * self.raw(rows) + self.shift)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[int]) -> Machine:
    """Learn from a bounded list of rows by stochastic gradient descent with a step size of its own for each weight.

    With one label or none there is nothing to tell apart: every score is the share of ones, (n1 + 1) / (n + 2)."""
    y = np.array(labels, np.float64)
    prior = (y.sum() + 1) / (len(y) + 2)
    rng = np.random.default_rng(SEED)
    machine = Machine(math.log(prior / (1 - prior)), np.zeros(BUCKETS), np.zeros((BUCKETS, FACTORS)))
    if len(set(labels)) < 2:
        return machine
    machine.factors = rng.normal(0, 0.05, (BUCKETS, FACTORS))
    held = np.arange(len(y)) % 5 == 4 if len(y) >= 50 else np.zeros(len(y), bool)
    train = np.flatnonzero(~held)
    seen_linear, seen_factors = np.full(BUCKETS, 1e-2), np.full((BUCKETS, FACTORS), 1e-2)
    for _ in range(EPOCHS):
        order = rng.permutation(train)
        for begin in range(0, len(order), BATCH):
            b = order[begin : begin + BATCH]
            at, x, starts = _flat([rows[k] for k in b])
            counts = np.diff([*starts, len(at)])
            vx = machine.factors[at] * x[:, None]
            total = np.add.reduceat(vx, starts)
            z = machine.bias + np.add.reduceat(machine.linear[at] * x, starts) + 0.5 * (total * total - np.add.reduceat(vx * vx, starts)).sum(1)
            error = (_sigmoid(z) - y[b]) / len(b)
            each = np.repeat(error, counts) * x
            grad_linear = np.bincount(at, each, BUCKETS) + PENALTY * machine.linear
            pull = each[:, None] * (np.repeat(total, counts, 0) - vx)
            grad_factors = np.stack([np.bincount(at, pull[:, f], BUCKETS) for f in range(FACTORS)], 1) + PENALTY * machine.factors
            seen_linear += grad_linear**2
            seen_factors += grad_factors**2
            machine.linear -= RATE * grad_linear / np.sqrt(seen_linear)
            machine.factors -= RATE * grad_factors / np.sqrt(seen_factors)
            machine.bias -= RATE * error.sum()
    _calibrate(machine, [rows[k] for k in np.flatnonzero(held)] if held.any() else rows, y[held] if held.any() else y)
    return machine


def _calibrate(machine: Machine, rows: list, y: np.ndarray) -> None:
    """Slope and shift of the scores by Newton's method, toward smoothed labels so that a clean split stays finite."""
    z = machine.raw(rows)
    n1, n0 = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = _sigmoid(a * z + b)
        w = np.maximum(p * (1 - p), 1e-9)
        g = np.array([(z * (p - target)).sum() + 1e-3 * (a - 1), (p - target).sum() + 1e-3 * b])
        h = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        size = min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        a, b = a - size * step[0], b - size * step[1]
        if np.abs(step).max() < 1e-8:
            break
    machine.slope, machine.shift = float(max(a, 1e-3)), float(b)


def _featured(names: tuple[str, ...]):
    """(text, *metadata, label, draw, key) -> buckets and weights, packed, with the last three."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [features(t or "", dict(zip(names, m))) for t, *m in zip(*(batch.column(i).to_pylist() for i in range(1 + len(names))))]
            packed = [pa.array([x[i].tobytes() for x in made], pa.binary()) for i in (0, 1)]
            yield pa.record_batch([*packed, *batch.columns[1 + len(names) :]], ["buckets", "weights", *batch.schema.names[1 + len(names) :]])

    return run


def _scored(machine: Machine, names: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            step = CHUNK if whole.nbytes <= CHUNK_BYTES else max(1, CHUNK * CHUNK_BYTES // whole.nbytes)
            for batch in (whole.slice(at, step) for at in range(0, whole.num_rows, step)):
                rows = [features(t or "", dict(zip(names, m))) for t, *m in zip(*(batch.column(2 + i).to_pylist() for i in range(1 + len(names))))]
                score = machine.scores(rows)
                predicted = (score >= THRESHOLD).astype(np.int32)
                yield pa.record_batch([batch.column(0), batch.column(1), pa.array(score), pa.array(predicted)], ["doc_id", "held_out", "score", "predicted"])

    return run


def held_out_column() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")), F.lit(5)) == 0, F.lit(False))


def _metadata(names: tuple[str, ...]) -> list[Column]:
    return [F.col(n).cast("double").alias(f"m{i}") for i, n in enumerate(names)]


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", metadata: tuple[str, ...] = ("n_chars",), sample: int = SAMPLE) -> Machine:
    """A machine from at most `sample` whole documents of each label, those of least hash among the documents with the
    `sample` doc_ids of least hash.

    A label other than 0 or 1 teaches nothing; a doc_id with both labels teaches both; rows repeated in full count once. No
    text is shuffled: the doc_ids of the sample, bounded as it is, go to the scan of the documents.
    """
    spark = docs.sparkSession
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where("doc_id IS NOT NULL AND label IN (0, 1)")
    marked = marked.where(~held_out_column()).distinct().withColumn("draw", _draw("quality-fm ids", "doc_id"))
    ids = _least(marked.where(_within(marked.groupBy("label").agg(F.count("*").alias("n")).collect(), sample)).collect(), sample, "doc_id")
    if not ids:
        return fit([], [])
    side = F.broadcast(spark.createDataFrame([(r["doc_id"], r["label"]) for r in ids], "l_id long, label int"))  # 2 * sample rows at most
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), *_metadata(metadata))
    known = rows.join(side, F.col("doc_id") == F.col("l_id")).withColumn("key", F.xxhash64("doc_id", "text")).withColumn("draw", _draw("quality-fm", "key"))
    counts = known.groupBy("label").agg(F.approx_count_distinct("key").alias("n")).collect()
    chosen = known.where(_within(counts, sample)).select("text", *[f"m{i}" for i in range(len(metadata))], "label", "draw", "key")
    made = chosen.mapInArrow(_featured(metadata), "buckets binary, weights binary, label int, draw double, key long").dropDuplicates(["label", "key"])
    picked = _least(made.collect(), sample, "key")
    return fit([(np.frombuffer(r["buckets"], np.uint16), np.frombuffer(r["weights"], np.float32)) for r in picked], [r["label"] for r in picked])


def _draw(salt: str, column: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(salt), column), F.lit(1 << 40)).cast("double") / float(1 << 40)


def _within(sizes: list, sample: int) -> Column:
    """Whether a row of (label, draw) is among about half as many again as the sample takes, by the label's size n."""
    if not sizes:
        return F.lit(False)
    return F.col("draw") < F.create_map(*[F.lit(x) for r in sizes for x in (r["label"], min(1.0, 1.5 * sample / max(r["n"], 1)))])[F.col("label")]


def _least(rows: list, sample: int, key: str) -> list:
    """The rows of least draw of each label, at most sample; in the order of their draws."""
    ordered = sorted(rows, key=lambda r: (r["draw"], r[key], r["label"]))
    return sorted((r for k in (0, 1) for r in [r for r in ordered if r["label"] == k][:sample]), key=lambda r: (r["draw"], r[key], r["label"]))


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", metadata: tuple[str, ...] = ("n_chars",), sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs; score: the calibrated chance of label 1.

    The metadata columns must not tell the label, the language or the source. A null or empty text is scored as one
    without words; a null doc_id is never held out and teaches nothing; null metadata is a value of its own; a text of any
    length counts whole; repeated rows get the same score; without labels every score is 0.5; an empty table gives no
    rows; other columns are ignored.
    """
    machine = train(docs, labels, label, metadata, sample)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out_column().alias("held_out"), text_of().alias("text"), *_metadata(metadata))
    return rows.mapInArrow(_scored(machine, metadata), "doc_id long, held_out boolean, score double, predicted int")
