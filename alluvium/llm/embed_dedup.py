"""Embedding near-dedup by iterative quantisation.

Rotations, learned from a bounded sample, turn unit vectors into balanced binary codes. A code is cut into disjoint
substrings, each the key of a table, so two codes that differ in fewer bits than there are tables share a cell of at
least one (multi-index Hamming tables, looked up exactly); in each cell the original vectors are compared in double
precision. Equal vectors are one point. A pair that meets in several tables counts in the first. No pair leaves its
task: a point emits the number of its links and the least point of its local component. Substrings grow with the
logarithm of the number of vectors, and the number of tables with them, so cells keep their size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cells import dealt, meeting, runs, stars
from .common import apart, materialize
from .components import components

COSINE = 0.98
#: The rotation is learned from at most so many vectors (those with the least hash of vec_id); all are indexed.
SAMPLE = 8_000
ROUNDS = 30
SEED = 11
#: Near vectors at cosine 0.98 differ in 6.4 % of the bits (arccos / pi). Substrings have LEAST_BITS or more, and so many
#: tables are made that such a pair agrees in none with a chance of MISSED at most, taking bits as independent.
LEAST_BITS, MISSED = 12, 5e-4


@dataclass(frozen=True)
class Tables:
    """How codes are cut: `tables` disjoint substrings of `bits`."""

    bits: int
    tables: int

    @property
    def kind(self) -> str:
        return "<i4" if self.bits < 32 else "<i8"


def tables_for(points: int, cosine: float = COSINE) -> Tables:
    """About 16 points of a random table's cell, whatever the number of points."""
    bits = max(LEAST_BITS, max(points, 1).bit_length() - 4)
    agree = (1 - math.acos(min(cosine, 1)) / math.pi) ** bits
    return Tables(bits, max(1, math.ceil(math.log(MISSED) / math.log1p(-agree))) if agree < 1 else 1)


def learn_rotation(sample: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection) so that the signs of (x - mean) @ projection are the code of `width` bits: PCA, then alternate
    the nearest binary codes and the rotation that fits them best. A code longer than the vectors takes the bits of
    several rotations, each learned from a start of its own."""
    dim = sample.shape[1]
    mean = sample.mean(0)
    x = sample - mean
    rng = np.random.default_rng(SEED)
    _, axes = np.linalg.eigh(x.T @ x)
    v = x @ axes
    parts = []
    for _ in range(-(-width // dim)):
        r, _ = np.linalg.qr(rng.normal(size=(dim, dim)))
        for _ in range(ROUNDS):
            u, _, wt = np.linalg.svd(np.where(v @ r >= 0, 1.0, -1.0).T @ v)
            r = wt.T @ u.T
        parts.append(axes @ r)
    return mean, np.concatenate(parts, axis=1)[:, :width]


def _unit(column, dim: int) -> np.ndarray:
    x = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = x.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)
    # scaled first, so that squares neither overflow nor vanish
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _codes(unit: np.ndarray, mean: np.ndarray, projection: np.ndarray, cut: Tables) -> np.ndarray:
    """points x tables: the substrings of each point's code."""
    bits = (unit - mean) @ projection >= 0
    return (bits.reshape(len(unit), cut.tables, cut.bits) @ (1 << np.arange(cut.bits))).astype(np.int64)


def _cells(models: dict, cut: Tables):
    """A row for each point and table, with all substrings of the point, so that no task makes them again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                keys = _codes(_unit(part.column(3), int(dim)), *models[int(dim)], cut)
                at = np.repeat(np.arange(len(keys)), cut.tables)
                table = np.tile(np.arange(cut.tables), len(keys))
                codes = pa.array([k.tobytes() for k in keys.astype(cut.kind)], pa.binary()).take(pa.array(at))
                yield pa.record_batch(
                    [pa.array(table.astype(np.int32)), pa.array(keys.reshape(-1)), codes, *[part.column(i).take(pa.array(at)) for i in (0, 1, 2, 3, 4)]],
                    ["t", "code", "codes", "label_key", "dim", "node", "vector", "size"],
                )

    return run


def _links(cut: Tables, cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, number in runs(batches):
            for dim in np.unique(table.column("dim").to_numpy()):
                here = table.column("dim").to_numpy() == dim
                part, run_no = table.filter(pa.array(here)), number[here]
                unit = _unit(part.column("vector"), int(dim))
                codes = np.frombuffer(b"".join(part.column("codes").to_pylist()), cut.kind).reshape(len(unit), -1)
                which, size, label = (part.column(c).to_numpy() for c in ("t", "size", "label_key"))
                links, found = np.zeros(len(unit), np.int64), []
                for i, j in meeting(run_no, part.column("chunk").to_numpy(), part.column("part").to_numpy(), 1 << 17):
                    # a cell's number is a hash: the table, its substring and the label are held against each other
                    here = (label[i] == label[j]) & (which[i] == which[j])
                    i, j = i[here], j[here]
                    same = codes[i] == codes[j]
                    t = which[i]
                    fits = same[np.arange(len(i)), t] if len(i) else np.zeros(0, bool)
                    i, j, same, t = i[fits], j[fits], same[fits], t[fits]
                    near = np.einsum("ij,ij->i", unit[i], unit[j]) >= cosine
                    i, j, same, t = i[near], j[near], same[near], t[near]
                    found.append((i, j))
                    first = ~(same & (np.arange(codes.shape[1]) < t[:, None])).any(1)
                    np.add.at(links, i[first], size[j[first]])
                    np.add.at(links, j[first], size[i[first]])
                root = stars(len(unit), found)
                at = np.flatnonzero((root != np.arange(len(root))) | (links > 0))
                nodes = part.column("node").combine_chunks()
                yield pa.record_batch([nodes.take(pa.array(at)), nodes.take(pa.array(root[at])), pa.array(links[at])], schema=pa.schema([("u", nodes.type), ("v", nodes.type), ("links", pa.int64())]))

    return run


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of vectors.

    A vector links with none if its label is null or it is null, empty, zero or has a null or non-finite component;
    it is then its own component. Vectors of different lengths never link. A null vec_id is never a component's id
    where the component has another. Ties at the cosine itself link. Repeated rows are vectors of their own that link; an empty table gives no rows;
    other columns are ignored.
    """
    fine = (
        F.col("label").isNotNull()
        & F.col("embedding").isNotNull()
        & F.coalesce(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
        & F.coalesce(F.exists("embedding", lambda x: x != 0), F.lit(False))
    )
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.withColumn("fine", F.coalesce(fine, F.lit(False)))
    node = F.concat(*[F.hex(F.xxhash64(F.lit(i), "label", "embedding")) for i in (1, 2)])
    rows = materialize(rows.withColumn("node", F.when(F.col("fine"), node)), "vectors")
    points = materialize(
        rows.where("fine").groupBy("node").agg(F.first("label").alias("label"), F.first("embedding").alias("vector"), F.count("*").alias("size"), F.min("vec_id").alias("least")),
        "vector-points",
    )
    cut = tables_for(points.count(), cosine)
    models = {}
    for r in points.select(F.size("vector").alias("d")).distinct().collect():
        sample = points.where(F.size("vector") == r["d"]).orderBy(F.xxhash64("least"), "node").limit(SAMPLE).select("vector").toPandas()["vector"]
        x = np.stack(sample.to_list()).astype(np.float64)
        x /= np.abs(x).max(1, keepdims=True)
        models[r["d"]] = learn_rotation(x / np.sqrt((x * x).sum(1, keepdims=True)), cut.bits * cut.tables)
    shape = points.select(F.xxhash64("label").alias("label_key"), F.size("vector").alias("dim"), "node", "vector", "size")
    kinds = "t int, code long, codes binary, label_key long, dim int, node string, vector array<double>, size long"
    cells = shape.mapInArrow(_cells(models, cut), kinds).withColumn("cell", F.xxhash64("label_key", "dim", "t", "code"))
    payload = ("t", "dim", "vector", "size", "codes", "label_key")
    found = materialize(dealt(cells.select("cell", "node", *payload), *payload).mapInArrow(_links(cut, cosine), "u string, v string, links long"), "vector-links")
    links = found.groupBy(F.col("u").alias("l_node")).agg(F.sum("links").alias("links"))
    roots = components(found.select("u", "v"), "vector-components").select(F.col("node").alias("r_node"), "root")
    tied = points.select("node", "size", "least").join(roots, F.col("node") == F.col("r_node"), "left").join(links, F.col("node") == F.col("l_node"), "left")
    tied = materialize(tied.select("node", "size", "least", F.coalesce("root", "node").alias("root"), F.coalesce("links", F.lit(0)).alias("links")), "vector-tied")
    by_root = tied.groupBy("root").agg(F.min("least").alias("component")).select(apart("root").alias("b_root"), "component")
    classes = tied.join(by_root, F.col("root") == F.col("b_root")).select(F.col("node").alias("c_node"), (F.col("links") + F.col("size") - 1).alias("n"), "component")
    out = rows.join(classes, F.col("node") == F.col("c_node"), "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
