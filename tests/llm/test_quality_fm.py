"""The factorisation machine: the linear-time identity, held-out accuracy, odd rows."""

import zlib

import numpy as np
import pytest

from alluvium.llm import quality_fm as Q
from alluvium.llm import queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, quality string, label int, held_out int, draw int, l_id int"


def test_pairs_in_linear_time_equal_all_pairs():
    rng = np.random.default_rng(1)
    m = Q.Machine(0.3, rng.normal(size=Q.BUCKETS), rng.normal(size=(Q.BUCKETS, Q.FACTORS)))
    rows = [Q.features(t, {"n_chars": n}) for t, n in (("a b b C1 ** ", 3), ("", None), ("word " * 40, 0))]
    for (at, x), z in zip(rows, m.raw(rows)):
        x = x.astype(float)
        pairs = sum(float(m.factors[i] @ m.factors[j]) * x[a] * x[b] for a, i in enumerate(at) for b, j in enumerate(at) if a < b)
        assert abs(m.bias + float(m.linear[at] @ x) + pairs - z) < 1e-6


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    out = queries.queries()["op11_quality_fm"](spark, folder)
    rows = out.join(labels, "doc_id").select("doc_id", "held_out", "score", "predicted", "quality").collect()
    assert out.count() == docs.count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 700
    assert sum(r["predicted"] == r["quality"] for r in held) / len(held) > 0.99
    good = [r["score"] for r in held if r["quality"] == 1]
    assert sum(s >= 0.3 for s in good) / len(good) > 0.99


def fixture():
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(80)]
    good = lambda: " ".join(rng.choice(words, 60))
    bad = lambda: " ".join(w.upper() + "!!" for w in rng.choice(words, 60))
    texts = [good() if i % 3 else bad() for i in range(240)]
    return [(i, t, "en", "s", len(t), "x", 9, 9, 9, 9) for i, t in enumerate(texts)]


def test_odd_rows(spark):
    rows = fixture()
    odd = [(None, "null id", None, None, None, *rows[0][5:]), (500, None, "en", "s", None, *rows[0][5:]), (501, "", "en", "s", 0, *rows[0][5:]), rows[4], rows[4], (502, rows[5][1] * 3000, "xx", None, 1, *rows[0][5:])]
    labels = [(r[0], int(r[0] % 3 > 0), "junk") for r in rows] + [(None, 1, "junk"), (500, None, "junk"), (3, 7, "junk"), (4, 1, "junk"), (9_999, 1, "junk")]
    docs = spark.createDataFrame(rows + odd, SCHEMA)
    out = Q.classify(docs, spark.createDataFrame(labels, "doc_id long, quality int, text string")).collect()
    assert len(out) == len(rows) + len(odd)
    at = {}
    for r in out:
        at.setdefault(r["doc_id"], []).append(r)
    assert not at[None][0]["held_out"] and len(at[4]) == 3 and len({r["score"] for r in at[4]}) == 1
    held = [r for r in out if r["held_out"] and r["doc_id"] < 240]
    assert held and all(r["predicted"] == int(r["doc_id"] % 3 > 0) for r in held)
    assert at[502][0]["predicted"] == int(5 % 3 > 0)


@pytest.mark.parametrize("labels, score", [([], 0.5), ([(1, 1), (2, 1), (3, 1)], 0.8)])
def test_nothing_to_tell_apart(spark, labels, score):
    docs = spark.createDataFrame(fixture()[:9], SCHEMA)
    out = Q.classify(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert len(out) == 9 and {round(r["score"], 9) for r in out} == {score}
    none = Q.classify(spark.createDataFrame([], SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int"))
    assert none.count() == 0 and none.columns == ["doc_id", "held_out", "score", "predicted"]


def test_the_sample_is_bounded_and_language_and_source_say_nothing(spark):
    rows = fixture()
    labels = spark.createDataFrame([(r[0], int(r[0] % 3 > 0)) for r in rows], "doc_id long, quality int")
    a = Q.train(spark.createDataFrame(rows, SCHEMA), labels, sample=30)
    b = Q.train(spark.createDataFrame([(r[0], r[1], "de", str(r[0] % 3), *r[4:]) for r in rows], SCHEMA).repartition(7), labels, sample=30)
    assert np.array_equal(a.factors, b.factors) and a.slope == b.slope
