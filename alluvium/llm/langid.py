"""Language ID: averaged hashed subword embeddings with a linear softmax, trained by SGD in numpy.

A text's letters, lower-cased and with every other run of characters as one blank, give byte n-grams of 2 to 4;
each hashes to a bucket, each bucket has an embedding, and the mean of a text's embeddings goes through a linear
softmax. Training sees a bounded sample of every language (SAMPLE documents, by hash of doc_id and text), whose bucket
counts, not texts, go to the driver; prediction sees whole texts. A temperature fitted on a part of the sample calibrates the scores, and the score below which few of that
part's documents lie is the rejection threshold.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


BUCKETS = 1 << 13
DIM = 16
GRAMS = (2, 3, 4)
#: Documents a language to learn from; beyond MANY languages fewer of each, so that all fit the driver, FEWEST at least.
#: A document weighs 6 bytes a bucket it has, so 48 KB at most whatever its length: 230 MB for MANY * SAMPLE of them.
SAMPLE = 600
MANY = 8
FEWEST = 20
EPOCHS, RATE, BATCH, SEED = 12, 0.5, 32, 7
HELD_OUT_QUANTILE = 0.005
UNDETERMINED = "und"

_OTHER = re.compile(r"[\W\d_]+")


def bucket_counts(text: str) -> np.ndarray:
    """How often each bucket's n-grams occur in the whole text."""
    raw = np.frombuffer((" " + _OTHER.sub(" ", text.lower()) + " ").encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    total = np.zeros(BUCKETS, np.int64)
    h = raw
    for n in range(2, max(GRAMS) + 1):
        if len(raw) < n:
            break
        h = h[:-1] * np.uint32(0x01000193) + raw[n - 1 :]
        if n in GRAMS:
            mixed = (h ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
            total += np.bincount(mixed >> np.uint32(32 - BUCKETS.bit_length() + 1), minlength=BUCKETS)
    return total


def _sparse(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that occur and their shares."""
    counts = bucket_counts(text)
    at = np.flatnonzero(counts)
    return at.astype(np.uint16), (counts[at] / max(counts.sum(), 1)).astype(np.float32)


def _dense(rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    out = np.zeros((len(rows), BUCKETS), np.float32)
    for k, (at, share) in enumerate(rows):
        out[k, at] = share
    return out


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


@dataclass
class Model:
    langs: list[str]
    logits: np.ndarray  # embeddings times softmax weights: BUCKETS x languages
    bias: np.ndarray
    temperature: float
    reject_below: float

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        """counts: documents x BUCKETS."""
        mean = counts / np.maximum(counts.sum(1, keepdims=True), 1)
        return softmax((mean @ self.logits + self.bias) / self.temperature)


def _shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, lang, draw, key) -> the buckets and their shares, packed, with the last three."""
    for batch in batches:
        rows = [_sparse(t) for t in batch.column(0).to_pylist()]
        packed = [pa.array([x[i].tobytes() for x in rows], pa.binary()) for i in (0, 1)]
        yield pa.record_batch([*packed, *batch.columns[1:]], ["buckets", "shares", *batch.schema.names[1:]])


def fit(x: list[tuple[np.ndarray, np.ndarray]], labels: list[str]) -> Model:
    """Learn from a bounded list of sparse rows (buckets, shares); every fifth document calibrates. One language or none
    learns nothing but its name."""
    langs = sorted(set(labels))
    if not langs:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 0.0)
    y = np.array([langs.index(x) for x in labels])
    rng = np.random.default_rng(SEED)
    emb, out, bias = rng.normal(0, 0.5, (BUCKETS, DIM)), np.zeros((DIM, len(langs))), np.zeros(len(langs))
    cal = np.arange(len(y)) % 5 == 4 if len(y) >= 50 else np.zeros(len(y), bool)
    train = np.flatnonzero(~cal)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(train)
        for at in range(0, len(order), BATCH):
            b = order[at : at + BATCH]
            xb = _dense([x[k] for k in b])
            hidden = xb @ emb
            z = hidden @ out + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(b)), y[b]] -= 1
            grad_hidden = p @ out.T
            out -= rate * hidden.T @ p / len(b) * 4
            bias -= rate * p.mean(0)
            emb -= rate * 40 * (xb.T @ grad_hidden) / len(b) * 4
    model = Model(langs, (emb @ out), bias, 1.0, 0.0)
    held = np.flatnonzero(cal) if cal.any() else np.arange(len(y))
    truth = y[held]
    raw = np.concatenate([_dense([x[k] for k in held[at : at + 128]]) @ model.logits + bias for at in range(0, len(held), 128)])

    def loss(t: float) -> float:
        return -np.log(np.maximum(softmax(raw / t)[np.arange(len(truth)), truth], 1e-12)).mean()

    model.temperature = min(np.geomspace(0.05, 20, 60), key=loss)
    model.reject_below = float(np.quantile(softmax(raw / model.temperature).max(1), HELD_OUT_QUANTILE))
    return model


def _predict(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = [], []
            texts = batch.column(1).to_pylist()
            for at in range(0, len(texts), 128):
                part = texts[at : at + 128]
                some = [t is not None and any(map(str.isalpha, t)) and bool(model.langs) for t in part]
                p = model.probabilities(np.stack([bucket_counts(t) if s else np.zeros(BUCKETS, np.int64) for t, s in zip(part, some)])) if model.langs else None
                for i, s in enumerate(some):
                    langs.append(model.langs[int(p[i].argmax())] if s else UNDETERMINED)
                    scores.append(float(p[i].max()) if s else 0.0)
            rejected = [l == UNDETERMINED or s < model.reject_below for l, s in zip(langs, scores)]
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected)], ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    return run


def held_out_column():
    return F.coalesce(F.pmod(F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of every language, from at most sample whole documents of each.

    The documents are those with the least hash of doc_id and text; rows repeated in full count once, so one hot row
    or doc_id pushes no other out. Texts without a letter teach nothing.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), held_out_column().alias("held_out"))
    known = rows.where("NOT held_out AND lang IS NOT NULL AND text IS NOT NULL").where(F.col("text").rlike(r"\p{L}")).withColumn("text_key", F.xxhash64("text"))
    known = known.withColumn("key", F.xxhash64(F.lit("langid"), "doc_id", "text_key"))
    counts = known.groupBy("lang").agg(F.approx_count_distinct("key").alias("n")).collect()
    if not counts:
        return fit([], [])
    each = min(sample, max(FEWEST, MANY * sample // len(counts)))
    # half as many again as asked for pass, since n is an estimate; the exact bound follows
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, 1.5 * each / max(r["n"], 1)))])
    draw = F.pmod(F.xxhash64(F.lit("draw"), "key"), F.lit(1 << 40)).cast("double") / float(1 << 40)
    chosen = known.withColumn("draw", draw).where(F.col("draw") < share[F.col("lang")]).dropDuplicates(["lang", "key"])
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "key"))
    few = chosen.withColumn("nth", nth).where(F.col("nth") <= each).select("text", "lang", "draw", "key")
    rows = few.mapInArrow(_shares, "buckets binary, shares binary, lang string, draw double, key long").collect()
    picked = sorted(rows, key=lambda r: (r["draw"], r["key"], r["lang"]))
    x = [(np.frombuffer(r["buckets"], np.uint16), np.frombuffer(r["shares"], np.float32)) for r in picked]
    return fit(x, [r["lang"] for r in picked])


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for every row of docs.

    A null text or one without a letter is `und` with score 0, as is everything where no language could be learned;
    a text of any length counts whole; a null doc_id is never held out; repeated rows get the same prediction; an empty table gives no rows; other
    columns are ignored. `rejected`: the calibrated score lies below the threshold, or `und`.
    """
    model = train(docs, sample)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out_column().alias("held_out"))
    return rows.mapInArrow(_predict(model), "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")
