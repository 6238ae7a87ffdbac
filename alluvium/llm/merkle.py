"""Merkle manifest of a dataset: a tree a group over its range-sorted rows, a tree over the groups' roots, and proofs.

Leaves are range-sorted by group and key and the sorted partitions are written by checkpoint(), so all later passes see the
same partitions in the same order. Of each partition one short row goes to the driver: its first and last group and how
many rows these have in it. Summed along the partitions, these counts say where in its group each partition starts. A task
then builds every aligned subtree whose rows it holds whole. What is left at its ragged ends is shuffled by its coordinate
(group, level, place) and finished level by level, at most FAN nodes a key, so a group that holds most rows is no hot key.
Proofs come back down the same way: a run of siblings learns the runs above it from its parent's, and each partition gets
those of its own ragged ends, zipped with its leaves. The groups' roots are the leaves of one more such tree.
"""

from __future__ import annotations

import functools
import hashlib
import pickle
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import scratch
from .common import materialize, shuffle_partitions

#: So many consecutive nodes have one parent.
FAN = 16
#: Leaves a partition, about; a task holds its leaves and the nodes above them.
LEAVES = 50_000
#: A run of siblings above a node: the node's place in it and all its digests in order, 64 hex digits each.
STEP = "struct<place:int,nodes:string>"
Step = tuple[int, str]


def part_of(value: Column) -> Column:
    """A value as it stands in a leaf: `-` if null, else its UTF-8 byte count, a colon and itself."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def _h(text: bytes) -> str:
    return hashlib.sha256(text).hexdigest()


@dataclass(frozen=True)
class Part:
    """Where a sorted partition lies: at which place of its first group its rows start, and how many rows its first and its
    last group have in all."""

    first_start: int
    first_total: int
    last_total: int


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(group, ...) of one partition -> one row: part, first, n_first, last, n_last, rows."""
    first = last = None
    n_first = n_last = rows = 0
    for batch in batches:
        for g in batch.column(0).to_pylist():
            if rows == 0:
                first = last = g
            if g != last:
                last, n_last = g, 0
            n_last += 1
            n_first += n_first == rows and g == first
            rows += 1
    yield pa.record_batch([pa.array([x], t) for x, t in ((TaskContext.get().partitionId(), pa.int32()), (first, pa.string()), (n_first, pa.int64()), (last, pa.string()), (n_last, pa.int64()), (rows, pa.int64()))], ["part", "first", "n_first", "last", "n_last", "rows"])


def places(summaries: list) -> dict[int, Part]:
    """The Part of each partition that has rows, from (part, first, n_first, last, n_last, rows) of all of them."""
    full = sorted((s for s in summaries if s["rows"]), key=lambda s: s["part"])
    total: dict[str, int] = {}
    start = {}
    for s in full:
        start[s["part"]] = total.get(s["first"], 0)
        total[s["first"]] = start[s["part"]] + s["n_first"]
        if s["last"] != s["first"]:
            total[s["last"]] = s["n_last"]
    return {s["part"]: Part(start[s["part"]], total[s["first"]], total[s["last"]]) for s in full}


class Run:
    """The rows of one group in one partition, and the subtrees that are whole in it."""

    def __init__(self, group: str, start: int, total: int, leaves: list[str]):
        self.group, self.total = group, total
        #: By level the place of the first node and the nodes, as far up as the subtrees reach; and the same of the runs of
        #: siblings that have a parent here, each as one string.
        self.levels, self.runs = [(start, leaves)], []
        n = total
        while n > 1:
            at, nodes = self.levels[-1]
            stop = at + len(nodes)
            low, high = -(-at // FAN), -(-stop // FAN) if stop == n else stop // FAN
            if low >= high:
                break
            joined = ["".join(nodes[g * FAN - at : (g + 1) * FAN - at]) for g in range(low, high)]
            self.runs.append((low, joined))
            self.levels.append((low, [_h(x.encode()) for x in joined]))
            n = -(-n // FAN)
        #: The group's root, where all of the group is here.
        self.root = self.levels[-1][1][0] if n == 1 else None

    def ragged(self) -> Iterator[tuple[int, int, str]]:
        """(level, place, digest) of the nodes whose parent isn't made here."""
        if self.root is not None:
            return
        for level, ((at, nodes), (low, joined)) in enumerate(zip(self.levels, [*self.runs, (0, [])])):
            for i, digest in enumerate(nodes, at):
                if not low <= i // FAN < low + len(joined):
                    yield level, i, digest

    def steps(self, i: int, above: dict[tuple[int, int], list[Step]]) -> list[Step]:
        """The runs of siblings of the leaf at place i, upward. above: (level, run) of a ragged end -> (0, its nodes) and
        the steps over it; where all of the group is here, (-1, 0) -> the steps over its root."""
        out = []
        for low, joined in self.runs:
            if not low <= i // FAN < low + len(joined):
                break
            out.append((i % FAN, joined[i // FAN - low]))
            i //= FAN
        if self.root is not None:
            return out + above.get((-1, 0), [])
        here, *higher = above[len(out), i // FAN]
        return [*out, (i % FAN, here[1]), *higher]

    def root_by(self, steps: list[Step]) -> str:
        """The group's root, by the steps of any of its leaves."""
        return self.root or _h(steps[_levels(self.total) - 1][1].encode())


def _runs(rows: list[tuple], part: Part) -> Iterator[tuple[Run, list[tuple]]]:
    """The runs of a partition's rows (group, digest, ...), each with its rows."""
    begin = 0
    while begin < len(rows):
        group, end = rows[begin][0], begin
        while end < len(rows) and rows[end][0] == group:
            end += 1
        total = part.first_total if begin == 0 else part.last_total if end == len(rows) else end - begin
        yield Run(group, part.first_start if begin == 0 else 0, total, [r[1] for r in rows[begin:end]]), rows[begin:end]
        begin = end


def _whole(batches: Iterator[pa.RecordBatch]) -> list[tuple]:
    return [row for batch in batches for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)))]


def _build(found):
    """(group, digest) of a partition -> its ragged nodes, and as level -1 the roots of the groups that are whole in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out = TaskContext.get().partitionId(), []
        rows = _whole(batches)
        for r, _ in _runs(rows, found.value[part]) if rows else ():
            if r.root is not None:
                out.append((part, r.group, -1, 0, r.total, r.root))
            out += [(part, r.group, level, i, r.total, digest) for level, i, digest in r.ragged()]
        columns = list(zip(*out)) or [()] * 6
        types = (pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string())
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], ["part", "group", "level", "i", "total", "digest"])

    return run


def _checkpointed(df: DataFrame) -> DataFrame:
    """df.checkpoint(), in the cluster's folder; where none is set, in a scratch folder of a local run."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(df.sparkSession.conf.get(scratch.CHECKPOINT_KEY, None) or scratch.path(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def _levels(total: int) -> int:
    n = 0
    while total > 1:
        total, n = -(-total // FAN), n + 1
    return n


def _finished(ragged: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """From ragged nodes (group, level, i, total, digest) the runs of siblings of each level: (group, run, total, nodes),
    and (group, root) of the groups that no partition has whole."""
    runs: list[DataFrame] = []
    made = roots = None
    for level in range(levels):
        nodes = ragged.where(F.col("level") == level).select("group", "i", "total", "digest")
        nodes = nodes if made is None else nodes.unionByName(made)
        ordered = F.array_sort(F.collect_list(F.struct("i", "digest")))
        grouped = nodes.groupBy("group", F.floor(F.col("i") / FAN).alias("run")).agg(F.first("total").alias("total"), F.array_join(F.transform(ordered, lambda x: x["digest"]), "").alias("nodes"))
        runs.append(materialize(grouped.withColumn("left", F.ceil(F.col("total") / F.lit(float(FAN) ** (level + 1)))), "merkle-runs"))
        up = runs[-1].select("group", F.col("run").alias("i"), "total", F.sha2("nodes", 256).alias("digest"), "left")
        ended = up.where("left = 1").select("group", F.col("digest").alias("root"))
        roots = ended if roots is None else roots.unionByName(ended)
        made = up.where("left > 1").drop("left")
    return runs, roots


def _descended(runs: list[DataFrame], top: DataFrame | None) -> DataFrame:
    """group, level, run, steps: of each run of siblings its nodes, as a step, and the steps above it. top: group, steps over
    the group's root."""
    found, out = None, None
    for level in reversed(range(len(runs))):
        rows = runs[level].withColumn("here", F.struct(F.lit(0).alias("place"), F.col("nodes").alias("nodes")).cast(STEP))
        none = F.array().cast(f"array<{STEP}>")
        last = rows.where("left = 1")
        if top is not None:
            last = last.join(top.select(F.col("group").alias("t_group"), F.col("steps").alias("over")), F.col("group") == F.col("t_group"))
        else:
            last = last.withColumn("over", none)
        now = last.select("group", "run", F.concat(F.array("here"), "over").alias("steps"))
        if found is not None:
            place = F.pmod(F.col("run"), F.lit(FAN)).cast("int")
            up = found.select(F.col("group").alias("u_group"), F.col("run").alias("u_run"), F.col("steps").alias("u_steps"))
            inner = rows.where("left > 1").join(up, (F.col("group") == F.col("u_group")) & (F.floor(F.col("run") / FAN) == F.col("u_run")))
            above = F.transform("u_steps", lambda s, k: F.when(k == 0, F.struct(place.alias("place"), s["nodes"].alias("nodes")).cast(STEP)).otherwise(s))
            now = now.unionByName(inner.select("group", "run", F.concat(F.array("here"), above).alias("steps")))
        found = materialize(now, "merkle-steps")
        rated = found.withColumn("level", F.lit(level))
        out = rated if out is None else out.unionByName(rated)
    return out


@dataclass
class Tree:
    """leaves: the sorted partitions (group, digest, more columns); ragged: what their tasks left; roots: group, root."""

    leaves: DataFrame
    parts: dict[int, Part]
    ragged: DataFrame
    runs: list[DataFrame]
    roots: DataFrame

    def proofs(self, top: DataFrame | None, emit: Callable[[tuple, int, str, list[Step]], tuple], schema: str) -> DataFrame:
        """emit(row, place, the group's root, steps) of each leaf. top: group, steps over the group's root (none: the root is
        the end)."""
        spark = self.leaves.sparkSession
        if not self.parts:
            return spark.createDataFrame([], schema)
        n = self.leaves.rdd.getNumPartitions()
        sent = []
        if self.runs:
            needed = self.ragged.where("level >= 0").select("part", "group", "level", F.floor(F.col("i") / FAN).alias("run")).distinct()
            steps = _descended(self.runs, top).select(F.col("group").alias("s_group"), F.col("level").alias("s_level"), F.col("run").alias("s_run"), "steps")
            here = (F.col("group") == F.col("s_group")) & (F.col("level") == F.col("s_level")) & (F.col("run") == F.col("s_run"))
            sent.append(needed.join(steps, here).select("part", "group", "level", "run", "steps"))
        if top is not None:
            whole = self.ragged.where("level = -1").select("part", F.col("group").alias("w_group"), "level", F.col("i").alias("run"))
            sent.append(whole.join(top, F.col("w_group") == F.col("group")).select("part", "group", "level", "run", "steps"))
        pack = lambda df: df.mapInArrow(_packed, "rows binary").rdd
        if sent:
            above = pack(functools.reduce(DataFrame.unionByName, sent).repartitionById(n, F.col("part")))
        else:
            above = spark.sparkContext.parallelize([(pickle.dumps([]),)] * n, n)
        found = spark.sparkContext.broadcast(self.parts)

        def run(index: int, pairs):
            for (leaves,), (paths,) in pairs:
                rows, by_group = pickle.loads(leaves), defaultdict(dict)
                for _, group, level, at, steps in pickle.loads(paths):
                    by_group[group][level, at] = [(s["place"], s["nodes"]) for s in steps]
                for r, own in _runs(rows, found.value[index]) if rows else ():
                    known, root = by_group[r.group], None
                    for i, row in enumerate(own, r.levels[0][0]):
                        steps = r.steps(i, known)
                        root = root or r.root_by(steps)
                        yield emit(row, i, root, steps)

        return spark.createDataFrame(pack(self.leaves).zip(above).mapPartitionsWithIndex(run), schema, verifySchema=False)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition as one value, so that two RDDs of as many partitions can be zipped."""
    yield pa.record_batch([pa.array([pickle.dumps(_whole(batches))], pa.binary())], ["rows"])


def tree(leaves: DataFrame, keys: list[Column]) -> Tree:
    """The trees of leaves (group, digest, more columns): the leaves of a group in the order of keys, which begin with one
    that orders groups. Repeated rows stand next to each other; Spark may deal them to several partitions."""
    spark = leaves.sparkSession
    numbered = leaves.withColumn("_nth", F.monotonically_increasing_id())
    parts = max(shuffle_partitions(spark), -(-leaves.count() // LEAVES))
    order = [*keys, F.col("_nth").asc()]
    dealt = _checkpointed(numbered.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("_nth"))
    summaries = dealt.select("group").mapInArrow(_summary, "part int, first string, n_first long, last string, n_last long, rows long").collect()  # a row a partition
    found = places(summaries)
    made = dealt.select("group", "digest").mapInArrow(_build(spark.sparkContext.broadcast(found)), "part int, group string, level int, i long, total long, digest string")
    ragged = materialize(made, "merkle-ragged")
    spread = max([_levels(p.first_total) for p in found.values() if p.first_start] + [0])  # of the groups that lie in several partitions
    runs, more = _finished(ragged, spread) if spread else ([], None)
    roots = ragged.where("level = -1").select("group", F.col("digest").alias("root"))
    return Tree(dealt, found, ragged, runs, roots if more is None else roots.unionByName(more))


def _ordered(rows: DataFrame, leaf: Column, more: list[str]) -> tuple[DataFrame, list[Column]]:
    """Leaves grouped by source, and the order of sources (null first, bytewise) and doc_ids (null first, then by leaf)."""
    made = rows.select(F.sha2(part_of(F.col("source")), 256).alias("group"), leaf.alias("digest"), "source", "doc_id", *more)
    return made, [F.col(c).asc_nulls_first() for c in ("source", "doc_id", "digest")]


def leaf_of(columns: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[part_of(c) for c in columns.values()]), 256)


def lowered(text: Column) -> Column:
    """A-Z in small letters, nothing else changed."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, capitals, capitals.lower())


def folded(leaf: str, steps: list[Step]) -> str:
    """The root that a leaf and its steps lead to."""
    for place, nodes in steps:
        leaf = _h(f"{nodes[: 64 * place]}{leaf}{nodes[64 * place + 64 :]}".encode())
    return leaf


def siblings(steps: list[Step]) -> list[str]:
    """The other digests of each run, upward, left to right, as one string a level."""
    return [nodes[: 64 * place] + nodes[64 * place + 64 :] for place, nodes in steps]


def _tampered(crc: Column) -> Column:
    return F.coalesce(F.pmod(crc, F.lit(5)) == 0, F.lit(False))


def _top(found: Tree) -> tuple[str, DataFrame | None]:
    """The root over all groups, and (group, steps) of each group: the steps over its root."""
    first = found.leaves.select("group", "source").distinct().withColumnRenamed("group", "g")
    subroots = materialize(found.roots.join(first, F.col("group") == F.col("g")).select("group", "source", F.col("root").alias("digest")), "merkle-subroots")
    over = tree(subroots.select(F.lit("").alias("group"), "digest", "source", F.col("group").alias("of")), [F.col("source").asc_nulls_first()])
    root = over.roots.first()
    steps = over.proofs(None, lambda row, i, root, steps: (row[3], steps), f"group string, steps array<{STEP}>")
    return (root["root"] if root else _h(b"")), materialize(steps, "merkle-top")


def _documents(docs: DataFrame) -> tuple[DataFrame, list[Column]]:
    named = {"doc_id": F.col("doc_id").cast("long"), "source": F.col("source").cast("string"), "lang": F.col("lang"), "n_chars": F.col("n_chars"), "text": F.col("text")}
    doc_id = named["doc_id"]
    crc = F.crc32(F.encode(doc_id.cast("string"), "UTF-8"))
    other = F.when(_tampered(crc), leaf_of(named | {"text": lowered(F.col("text"))}))
    rows = docs.select(named["source"].alias("source"), doc_id.alias("doc_id"), leaf_of(named).alias("leaf"), other.alias("tampered"))
    return _ordered(rows, F.col("leaf"), ["tampered"])


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, source, place (in its source, from 0), leaf, subroot, root, proof for every row of docs.

    proof: array of (place, nodes), upward through the source's tree and the tree over sources: the node's place in its run
    and the run's digests in order, its own among them. A null text, lang, source, doc_id or n_chars is a leaf's `-`; null
    doc_ids stand first in their source, equal ones by leaf; a null source is a source of its own; repeated rows are leaves
    of their own; an empty table gives no rows; other columns are ignored; a text of any length is hashed whole.
    """
    emit = lambda row, i, root, steps: (row[3], row[2], i, row[1], root, steps)
    root, made = _manifest(docs, emit, f"doc_id long, source string, place long, leaf string, subroot string, proof array<{STEP}>")
    return made.select("doc_id", "source", "place", "leaf", "subroot", F.lit(root).alias("root"), "proof")


def _manifest(docs: DataFrame, emit, schema: str) -> tuple[str, DataFrame]:
    found = tree(*_documents(docs))
    root, top = _top(found)
    return root, found.proofs(top, emit, schema)


def verified(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, place for every row of docs: the manifest's digests,
    and what the proofs say of documents of which some were changed.

    A document is changed where 5 divides the crc32 of its decimal doc_id (never with a null one): its text's A-Z become
    small. folded_root comes from the changed leaf and the siblings of the first manifest. Odd rows: see manifest().
    """

    def emit(row, i, root, steps):
        proof = hashlib.sha256()
        for s in siblings(steps):
            proof.update(s.encode())
        return row[3], row[1], root, proof.hexdigest(), folded(row[4] or row[1], steps), i

    root, made = _manifest(docs, emit, "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string, place long")
    return made.select("doc_id", "leaf", "subroot", F.lit(root).alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"), "place")
