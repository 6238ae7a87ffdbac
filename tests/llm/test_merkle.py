"""The Merkle manifest against one built in plain Python, at many partition counts, with hot groups and odd rows."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from alluvium.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, root int, group string, `_nth` int"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(d, text, lang, source, n):
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h("".join(map(part, (d, source, lang, n, text))))


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i : i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def path(levels, i):
    out = []
    for nodes in levels[:-1]:
        run = nodes[i // 16 * 16 : i // 16 * 16 + 16]
        out.append((i % 16, run))
        i //= 16
    return out


def brute(rows):
    by_source = {}
    for d, text, lang, source, n, *_ in rows:
        by_source.setdefault(source, []).append((d is not None, d or 0, leaf(d, text, lang, source, n), d, text, lang, source, n))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels_of([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])]) for s in order}
    top = levels_of([trees[s][-1][0] for s in order]) if order else None
    out = []
    for k, s in enumerate(order):
        for i, (_, _, own, d, text, lang, source, n) in enumerate(sorted(by_source[s], key=lambda x: x[:3])):
            steps = path(trees[s], i) + path(top, k)
            proof = h("".join("".join(run[:at] + run[at + 1 :]) for at, run in steps))
            node = own
            if d is not None and zlib.crc32(str(d).encode()) % 5 == 0 and text is not None:
                node = leaf(d, "".join(c.lower() if "A" <= c <= "Z" else c for c in text), lang, source, n)
            for at, run in steps:
                node = h("".join(run[:at] + [node] + run[at + 1 :]))
            out.append((d, own, trees[s][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(map(repr, out))


NAMES = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def got(df):
    return sorted(map(repr, (tuple(r[c] for c in NAMES) for r in df.collect())))


def rows(n, seed, hot):
    rng = random.Random(seed)
    sources = [None, "", "a", "ä", "Z", "longer name", *[f"s{i}" for i in range(40)]]
    out = []
    for i in range(n):
        source = "hot" if rng.random() < hot else rng.choice(sources)
        text = rng.choice([None, "", "Ünder A-Z", f"text {i} OK", "Same"])
        out.append((rng.choice([None, i, i, i, i, 7]), text, rng.choice([None, "en"]), source, rng.choice([None, i, 3]), "x", 1, "y", 2))
    return out + out[:20] + [out[3]] * 40


@pytest.mark.parametrize("n, hot, parts", [(1, 0, 3), (17, 1, 4), (300, 0.4, 1), (900, 0.4, 7), (1500, 0.9, 61), (5000, 0.5, 23)])
def test_against_plain_python(spark, n, hot, parts):
    made = rows(n, n, hot) if n > 1 else [(5, "Some TEXT", "en", "s", 9, "x", 1, "y", 2)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        assert got(merkle.verified(spark.createDataFrame(made, SCHEMA).repartition(3))) == brute(made)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_one_row_alone_and_none(spark):
    one = [(5, "Some TEXT", "en", "s", 9, "x", 1, "y", 2)]
    r = merkle.verified(spark.createDataFrame(one, SCHEMA)).first()
    assert r["leaf"] == r["subroot"] == r["root"] and r["proof_sha256"] == h("")
    none = merkle.verified(spark.createDataFrame([], SCHEMA))
    assert none.count() == 0 and none.columns[:7] == list(NAMES)
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_real_proofs_lead_to_the_root(spark):
    made = rows(700, 2, 0.6)
    out = merkle.manifest(spark.createDataFrame(made, SCHEMA)).collect()
    assert len(out) == len(made) and len({r["root"] for r in out}) == 1
    for r in out:
        steps = [(s["place"], s["nodes"]) for s in r["proof"]]
        assert merkle.folded(r["leaf"], steps) == r["root"] and merkle.folded(h("other"), steps) != r["root"]
    places = {}
    for r in out:
        places.setdefault(r["source"], []).append(r["place"])
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_long_text(spark):
    text = "Long Ä " * 400_000
    r = merkle.verified(spark.createDataFrame([(1, text, None, None, None, "x", 1, "y", 2)], SCHEMA)).first()
    assert r["leaf"] == leaf(1, text, None, None, None)


def test_verified_on_the_test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    made = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    out = merkle.verified(docs)
    assert got(out) == brute(made)
    assert 0 < out.where(~F.col("verified")).count() < len(made) / 3
