"""keep_one against brute-force Jaccard on distinct five-word shingles, with pairs on both sides of 0.8."""

import numpy as np
import pytest

from alluvium.llm import cells, simhash

SCHEMA = "doc_id long, text string"


def near_rows():
    rng = np.random.default_rng(11)
    vocab = np.array(["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(5000)])
    rows = []
    for k in range(150):
        words = list(rng.choice(vocab, 94))  # 90 shingles: 10 new words at the end give 80 / 100, 11 give 79 / 101
        rows.append((10 * k, " ".join(words)))
        for nth, c in enumerate((8, 9, 10, 11, 12)[: k % 6]):
            rows.append((10 * k + 1 + nth, " ".join([*words[: 94 - c], *rng.choice(vocab, c)])))
    line = " ".join(rng.choice(vocab, 8))
    for k in range(40):  # one line's repeats outweigh the rest
        words = list(rng.choice(vocab, 60))
        rows += [(5000 + 2 * k, " ".join([*words, *[line] * 40])), (5001 + 2 * k, " ".join([*words, *[line] * (2 + k % 3)]))]
    return [*rows, (9000, None), (9001, ""), (9002, "a B"), (9003, "A b"), (None, rows[0][1]), rows[0]]


def brute_kept(rows):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or 5 * len(a & b) >= 4 * len(a | b):
                root[top(i)] = top(j)
    first = {}
    for i, (d, t) in enumerate(rows):
        key = (d is None, d or 0, t or "")
        first[top(i)] = min(first.get(top(i), key), key)
    return sorted((d if not null else None, t) for null, d, t in first.values())


def test_keep_one_is_exact(spark):
    rows = near_rows()
    kept = simhash.keep_one(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in kept) == brute_kept(rows)


def test_keep_one_on_few_frequent_shingles(spark, monkeypatch):
    """The sample sets the order of prefixes only, never a result."""
    rows = near_rows()
    monkeypatch.setattr(simhash, "SAMPLE", 20)
    monkeypatch.setattr(simhash, "FREQUENT", 3)
    kept = simhash.keep_one(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in kept) == brute_kept(rows)


@pytest.mark.parametrize("n", [1, 4, 5, 46, 90, 1000])
def test_every_similar_pair_meets(n):
    """The least overlap that 0.8 allows, in any order of frequency."""
    rng = np.random.default_rng(n)
    for _ in range(200):
        new = int(rng.integers(0, n // 9 + 1))  # n - new in common of n + new
        pool = rng.integers(0, 2**63, n + new).astype(np.uint64)
        a, b = np.unique(pool[:n]), np.unique(pool[new:])
        common = len(np.intersect1d(a, b))
        assert 5 * common >= 4 * len(np.union1d(a, b))
        often = np.sort(rng.choice(pool, len(pool) // 2, replace=False))
        times = rng.integers(3, 9, len(often))
        assert len(np.intersect1d(simhash.prefix(a, often, times), simhash.prefix(b, often, times)))


def test_connected_is_exact():
    """Small and large runs, against a search from point to point."""
    rng = np.random.default_rng(2)
    run = np.sort(np.concatenate([rng.integers(0, 9, 60), np.full(200, 9)]))
    place = rng.uniform(0, 40, len(run))
    near = lambda i, j: np.abs(place[i] - place[j]) < 0.2
    got = cells.connected(run, near)
    want = np.arange(len(run))
    for _ in run:
        for i in range(len(run)):
            want[i] = want[[j for j in range(len(run)) if run[i] == run[j] and near(i, j)]].min()
    assert got.tolist() == want.tolist()


def test_large_group_in_parts(spark, monkeypatch):
    """A group beyond a chunk is compared part by part, with the same result."""
    rows = near_rows()
    monkeypatch.setattr(simhash, "CHUNK", 300)
    monkeypatch.setattr(simhash, "FINE", 100)
    kept = simhash.keep_one(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in kept) == brute_kept(rows)


def test_popcounts_retrieve_without_prefixes(spark, monkeypatch):
    """Pairs within 4 of 64 bits meet by segment popcounts, also where no prefix brings them together."""

    def nothing(batches):
        yield from ()

    rng = np.random.default_rng(5)
    vocab = np.array(["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(5000)])
    bits = lambda t: np.frombuffer(simhash._majority(np.unique(simhash.shingles(t, 5)), 1), np.uint64)
    rows, near = [], 0
    for k in range(40):
        words = list(rng.choice(vocab, 600))
        one, two = " ".join(words), " ".join([*words[:-1], "x"])
        apart = int(np.bitwise_count(bits(one) ^ bits(two))[0])
        near += apart <= simhash.LINKS.distance
        rows += [(2 * k, one), (2 * k + 1, two)]
    assert near > 20
    monkeypatch.setattr(simhash, "_prefixes", nothing)
    kept = simhash.keep_one(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(kept) == len(rows) - near
