"""select against the list itself, at sample borders, over repeats and gaps."""

import numpy as np
import pytest

from alluvium.llm import elias_fano, token_files


def lists():
    rng = np.random.default_rng(8)
    yield np.zeros(0, np.int64)
    yield np.array([-(2**62)])
    yield np.full(700, 5)
    yield np.arange(elias_fano.SAMPLE * 2)
    yield np.sort(rng.integers(-(2**62), 2**62, 3000))
    yield np.cumsum(rng.integers(0, 3, 5000))
    yield np.sort(np.concatenate([np.zeros(600, np.int64), rng.integers(0, 10**12, 300)]))


@pytest.mark.parametrize("values", list(lists()), ids=len)
def test_select(values):
    lead = b"head"
    found = elias_fano.EliasFano(lead + elias_fano.encode(values), len(lead))
    s, n = elias_fano.SAMPLE, len(values)
    for i in {0, 1, s - 1, s, s + 1, 2 * s - 1, 2 * s, n // 2, n - 1} & set(range(n)):
        assert found.select(i) == values[i]
        for to in (i, i + 1, i + s - 1, i + s, i + 2 * s + 1, n, n + 5):
            assert found.select(i, to).tolist() == values[i:to].tolist()
    with pytest.raises(IndexError):
        found.select(n)
    assert found.select(0, n).tolist() == values.tolist()


def test_space():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 2000, 100_000))
    bits = 8 * len(elias_fano.encode(ends)) / len(ends)
    assert bits < 2 + np.log2(ends[-1] / len(ends)) + 0.5


def test_blocks_of_documents(spark):
    """More documents than a block, null doc_ids first and over a block's border."""
    rows = [(None, f"n{i}") for i in range(9)] + [(i // 2, "word " * (i % 5)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    folder, manifest = token_files.write_tokens(docs)
    assert "://" in folder or folder.startswith("file:")
    got = sorted(token_files.read_tokens(spark, folder, manifest, block=7).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d))
    assert [r["start"] for r in got] == [sum(x["n_tokens"] for x in got[:k]) for k in range(len(got))]


@pytest.mark.parametrize("known", [0, 0.1, 0.5, 1])
def test_null_ids_fill_several_shards(spark, tmp_path, known):
    rows = [(i if i < 2000 * known else None, f"text number {i % 50} " * 20) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    try:
        folder, manifest = token_files.write_tokens(docs, str(tmp_path / "t"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    sizes = sorted(n for _, _, n, _ in manifest)
    assert sum(sizes) == 2000 and len(sizes) == 8 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    out = sorted(token_files.read_tokens(spark, folder, manifest).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in out] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d or 0))
    assert [r["start"] for r in out] == [0, *np.cumsum([r["n_tokens"] for r in out])[:-1]]
