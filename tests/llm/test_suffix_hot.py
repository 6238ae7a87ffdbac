"""A line shorter than 100 bytes that many documents share: even buckets, and results as by brute force."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from alluvium.llm import suffix_dedup

LINE = "licensed under the terms that every file of this collection carries at its very beginning"[:90]


def texts(n):
    rng = np.random.default_rng(4)
    vocab = np.array(["".join(rng.choice(list("abcdefghijklmnop"), 7)) for _ in range(20_000)])
    word = lambda k: " ".join(vocab[rng.integers(0, len(vocab), k)])
    return [f"{word(8)}\n{LINE}\n{word(12)}" for _ in range(n)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(texts(6000))), "doc_id long, text string").repartition(7)


def test_buckets_are_even(docs):
    rows = suffix_dedup._rows(docs)
    hot = suffix_dedup.hot_samples(rows)
    assert len(hot)
    held = rows.mapInArrow(suffix_dedup._sampled(64, hot), suffix_dedup._ROWS).where("kind = 0").groupBy("bucket").agg((F.sum(F.length("doc_ids")) / 8).alias("n"))
    n = sorted(r["n"] for r in held.collect())
    assert len(n) == 64 and n[-1] <= 5 * n[32]


def test_equals_brute_force(spark):
    some = texts(400)
    some += [some[3][:150] + " " + some[4], "x" * 40 + some[9][20:180], some[7] + "\n" + some[7], LINE * 3]
    seen, want = set(), []
    for d, t in enumerate(some):
        raw, gone = t.encode(), np.zeros(len(t), bool)
        for i in range(len(raw) - 99):
            if raw[i : i + 100] in seen:
                gone[i : i + 100] = True
            seen.add(raw[i : i + 100])
        want.append((d, len(raw), int(gone.sum()), hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest()))
    got = suffix_dedup.dedup(spark.createDataFrame(list(enumerate(some)), "doc_id long, text string").repartition(5))
    assert sorted(tuple(r) for r in got.select("doc_id", "n_bytes", "n_removed", "kept_sha256").collect()) == want
    assert any(n for _, _, n, _ in want)
