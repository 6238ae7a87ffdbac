"""Comparing the points that share a cell, whatever the cell's size.

Rows (cell, ...) are dealt by cell. A cell of more than CELL points is cut into chunks by a hash, and every pair of
chunks meets in a part of its own, so each pair of points still meets exactly once in the cell and no task holds more
than two chunks. Within a task, matches are joined into stars: a point emits the least point of its local component,
never all its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import apart, shuffle_partitions

CELL = 1024
BUFFER, BUFFER_BYTES = 1 << 15, 1 << 24
#: Runs of more rows are searched from point to point, smaller ones pair by pair.
SMALL = 48


def marked(rows: DataFrame, counted: DataFrame | None = None, weight: str | None = None, most: int = CELL, fine: int | None = None) -> DataFrame:
    """rows (cell, node, ...) with k, how many chunks their cell is cut into, and chunk. A chunk holds about `most`
    rows, or rows of `most` weight; with `fine`, down to this size as long as a cell's parts don't outnumber the
    shuffle's, so that one large cell keeps all of them busy. counted: the same rows with fewer columns, where that is
    cheaper to group."""
    load = F.sum(weight) if weight else F.count("*")
    wide = math.ceil(math.sqrt(2 * shuffle_partitions(rows.sparkSession)))
    counts = (rows if counted is None else counted).groupBy("cell").agg(load.alias("load")).where(F.col("load") > (fine or most))
    k = F.greatest(F.ceil(F.col("load") / most), F.least(F.ceil(F.col("load") / (fine or most)), F.lit(wide if fine else 1)))
    counts = counts.select(apart("cell").alias("h_cell"), k.cast("int").alias("h_k"))
    out = rows.join(counts, F.col("cell") == F.col("h_cell"), "left").withColumn("k", F.coalesce("h_k", F.lit(1))).drop("h_cell", "h_k")
    return out.withColumn("chunk", F.pmod(F.xxhash64(F.lit("chunk"), "node"), F.col("k")).cast("int"))


def spread(rows: DataFrame, *payload: str) -> DataFrame:
    """Rows of marked() -> (cell, part, chunk, node, payload...), sorted by cell and part within partitions. A cell's
    parts are numbered from 0 and go to partitions in turn."""
    n = shuffle_partitions(rows.sparkSession)
    split = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    high = F.greatest("chunk", "other").cast("long")
    part = F.floor(high * (high + 1) / 2) + F.least("chunk", "other")
    out = split.select("cell", part.alias("part"), "chunk", "node", *payload)
    turn = F.pmod(F.pmod(F.xxhash64("cell"), F.lit(n)) + F.col("part"), F.lit(n)).cast("int")
    return out.repartitionById(n, turn).sortWithinPartitions("cell", "part")


def dealt(rows: DataFrame, *payload: str, counted: DataFrame | None = None) -> DataFrame:
    return spread(marked(rows, counted), *payload)


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole (cell, part) runs, with the number of each row's run."""
    held: list[pa.RecordBatch] = []

    def number(t: pa.Table) -> np.ndarray:
        a, b = t.column("cell").to_numpy(), t.column("part").to_numpy()
        return np.concatenate([[0], np.cumsum((a[1:] != a[:-1]) | (b[1:] != b[:-1]))]) if len(a) else np.zeros(0, np.int64)

    rows = size = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        size += batch.nbytes
        if rows < BUFFER and size < BUFFER_BYTES:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        run = number(table)
        cut = int(np.searchsorted(run, run[-1]))
        if cut:
            yield table.slice(0, cut), run[:cut]
        held = table.slice(cut).to_batches()
        rows, size = table.num_rows - cut, sum(b.nbytes for b in held)
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        if table.num_rows:
            yield table, number(table)
    # a worker that waits for its next task keeps no buffers of this one
    pa.default_memory_pool().release_unused()


def meeting(run: np.ndarray, chunk: np.ndarray, part: np.ndarray, block: int = 1 << 17) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs i < j of one run, in bounded blocks: in a part of two chunks only across them."""
    n = len(run)
    start = np.searchsorted(run, run, "left")
    size = np.searchsorted(run, run, "right") - start
    two = np.zeros(n, bool)
    first = np.flatnonzero(np.arange(n) == start)
    for s in first[size[first] > 1]:
        e = s + size[s]
        two[s:e] = chunk[s:e].min() != chunk[s:e].max()
    left = (start + size) - np.arange(n) - 1
    at = 0
    total = np.cumsum(left)
    while at < n:
        base = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, base + block, "right")))
        i = np.repeat(np.arange(at, to), left[at:to])
        if len(i):
            j = np.arange(len(i)) - np.repeat(np.cumsum(left[at:to]) - left[at:to], left[at:to]) + i + 1
            keep = ~two[i] | (chunk[i] != chunk[j])
            # the part of a chunk with itself has that chunk alone; parts of two hold both
            yield i[keep], j[keep]
        at = to


def stars(n: int, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Each point's least point among those that the pairs connect."""
    label = np.arange(n)
    if not pairs:
        return label
    i, j = (np.concatenate(x) for x in zip(*pairs))
    while True:
        before = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            return label


def grown(n: int, near: Callable[[int, np.ndarray], np.ndarray]) -> np.ndarray:
    """Each of n points' least point among those that links connect. near(i, rest): which of rest link with i. A point
    is held against those that no link has reached yet, so a group that hangs together costs little more than its size."""
    lead, rest = np.arange(n), np.arange(n)
    while len(rest):
        first, rest = rest[0], rest[1:]
        queue = [first]
        while queue and len(rest):
            hit = near(queue.pop(), rest)
            if hit.any():
                lead[rest[hit]] = first
                queue.extend(rest[hit].tolist())
                rest = rest[~hit]
    return lead


def connected(run: np.ndarray, near: Callable) -> np.ndarray:
    """Each row's least row among those of its run that links connect. near(i, j): which rows i and j link."""
    lead = np.arange(len(run))
    start, end = np.searchsorted(run, run, "left"), np.searchsorted(run, run, "right")
    few = np.flatnonzero(end - start <= SMALL)
    zero = np.zeros(len(few), np.int64)
    found = []
    for i, j in meeting(run[few], zero, zero):
        i, j = few[i], few[j]
        hit = near(i, j)
        found.append((i[hit], j[hit]))
    lead = stars(len(run), found)
    for a in np.unique(start[end - start > SMALL]):
        b = end[a]
        lead[a:b] = a + grown(b - a, lambda i, rest, a=a: near(np.full(len(rest), a + i), a + rest))
    return lead
