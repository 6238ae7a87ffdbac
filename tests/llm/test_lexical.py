"""Ranked search against scores counted one by one, with ties, odd rows and several shards and blocks."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from alluvium.llm import lexical, queries

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score long, item_id int, rank int, part int"


def split(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in m) for m in TERM.findall(text or "")]


def brute(docs, items, k=20):
    bags = [(d, Counter(split(t))) for d, t, *_ in docs]
    bags = [(d, b, sum(b.values())) for d, b in bags if b]
    total, N = sum(n for *_, n in bags), len(bags)
    df = Counter(w for _, b, _ in bags for w in b)
    out = []
    for item, text, *_ in items:
        scored = []
        for d, b, n in bags:
            m = 100 - 25 + (25 * n * N) // total
            s = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * ((1000000000 * b[t]) // (1000 * b[t] + 12 * m)) for t in split(text) if t in b)
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(map(repr, out))


def got(df):
    return sorted(repr((r["item_id"], r["rank"], r["doc_id"], r["score"])) for r in df.collect())


def test_terms_are_the_pattern_s_matches():
    texts = ["A-b_C1 ñÑ x\x85y\xa0z", "", "中文,ABC\x00d\x7fe", "İK{}~`@[^]", " 0/9:;", " a　b"]
    for t in texts:
        assert [w.decode() for w in lexical.terms(t.encode())] == split(t)


def rows(seed, n):
    rng = random.Random(seed)
    words = ["the", "of", *["".join(rng.choice("abcdé") for _ in range(rng.randint(1, 4))) for _ in range(60)], "Ü1"]
    text = lambda m: " ".join(rng.choice(words[: rng.choice((2, 10, 63))]) for _ in range(m))
    docs = [(i, text(rng.randint(1, 40)), "en", "s", 1, 2, 3, 4, 5) for i in range(n)]
    more = docs[0][2:]
    docs += [(n, None, *more), (n + 1, "", *more), (n + 2, "-- //", *more), (None, "the rare Ü1", *more), (None, "the rare Ü1", *more), docs[5], docs[5], *[(n + 10 + i, "same words here", *more) for i in range(50)]]
    docs += [(n + 99, text(30_000), *more)]
    items = [(i, text(rng.randint(1, 12)), "x") for i in range(25)] + [(90, None, "x"), (91, "", "x"), (92, "zzzz not-there", "x"), (None, "the THE tHe rare", "x"), (93, "same words Here", "x"), (93, "same words Here", "x")]
    return docs, items


@pytest.mark.parametrize("block, parts", [(2000, 1), (4, 40), (1, 5)])
def test_against_brute_force(spark, monkeypatch, block, parts):
    docs, items = rows(parts, 300)
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", block)
    items = items[22:] if block == 1 else items
    index = lexical.build(spark.createDataFrame(docs, DOCS).repartition(parts))  # a shard a task at least
    asked = spark.createDataFrame(items, "item_id long, text string, doc_id string").repartition(2)
    assert index.read(spark).count() >= min(parts, 20) and index.documents == sum(bool(split(t)) for _, t, *_ in docs)
    assert got(lexical.search(index, asked)) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = rows(1, 8)
    some, none = spark.createDataFrame(docs, DOCS), spark.createDataFrame([], DOCS)
    asked, nothing = spark.createDataFrame(items, "item_id long, text string, x string"), spark.createDataFrame([], "item_id long, text string")
    for d, i in ((none, asked), (some, nothing), (some.where("text = ''"), asked)):
        out = lexical.search_documents(d, i)
        assert out.count() == 0 and out.columns == ["item_id", "rank", "doc_id", "score"]


def test_ties_at_the_last_place():
    ids = np.array([9, 3, 7, 1, 5, 2])
    assert sorted(ids[lexical.best(np.array([4, 4, 8, 4, 4, 0]), ids, 3)]) == [1, 3, 7]
    assert sorted(ids[lexical.best(np.array([0, 0, 1, 0, 0, 0]), ids, 3)]) == [7]
    assert len(lexical.best(np.zeros(6, np.int64), ids, 3)) == 0


def test_the_test_table(spark):
    folder = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    assert got(queries.queries()["op13_lexical_search"](spark, folder)) == brute(docs, items)


def test_a_row_group_holds_few_shards(spark, tmp_path):
    """One task's shards of 8 MB of text each must not lie in one row group, which Spark reads at a time."""
    import glob

    import pyarrow.parquet as pq

    docs = spark.range(3, numPartitions=1).select("id", F.expr("array_join(transform(sequence(1, 260000), i -> hex(xxhash64(i, id)) || hex(xxhash64(id, i))), ' ')").alias("text"))
    index = lexical.build(docs.withColumnRenamed("id", "doc_id"), f"{tmp_path}/index")
    assert index.terms == 3 * 260_000
    files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{tmp_path}/index/*.parquet")]
    assert [m.row_group(i).num_rows for m in files for i in range(m.num_row_groups)] == [1, 1, 1]
