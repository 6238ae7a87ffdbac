"""Sharding by a hierarchical weighted hash tree (DataFrame functions only).

A tree has regions, regions have racks, racks have shards. A document descends level by level: at each node it
draws, for every child, -ln(u) / weight with u a hash of (doc_id, the child's name), and takes the least draw. A
child's draw depends on nothing but the document, the child's name and the child's weight, so a change of weights
moves rows only into subtrees that grew and out of subtrees that shrank. One more shard joins as a region of its
own, so its rows move only into it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, each_copy, materialize, text_of

#: Rows of a shard are numbered within so many sub-buckets; the offsets table has shards x this many rows at most.
SLOT_BUCKETS = 1024


@dataclass(frozen=True)
class Rack:
    name: str
    shards: tuple[tuple[int, float], ...]  # (shard number, weight)

    @property
    def weight(self) -> float:
        return sum(w for _, w in self.shards)


@dataclass(frozen=True)
class Region:
    name: str
    racks: tuple[Rack, ...]

    @property
    def weight(self) -> float:
        return sum(r.weight for r in self.racks)


def uniform_tree(shards: int, per_rack: int = 4, racks: int = 2) -> tuple[Region, ...]:
    """Shards 0..shards-1 of weight 1 in full regions of per_rack * racks; each one beyond those is a region of its own."""
    per_region = per_rack * racks
    full = shards // per_region
    regions = [
        Region(
            f"region{r}",
            tuple(
                Rack(f"region{r}/rack{k}", tuple((r * per_region + k * per_rack + i, 1.0) for i in range(per_rack)))
                for k in range(racks)
            ),
        )
        for r in range(full)
    ]
    for s in range(full * per_region, shards):
        regions.append(Region(f"single{s}", (Rack(f"single{s}/rack", ((s, 1.0),)),)))
    return tuple(regions)


def with_shard(tree: tuple[Region, ...], shard: int, weight: float = 1.0) -> tuple[Region, ...]:
    """The tree with one more shard, in a region of its own."""
    return (*tree, Region(f"single{shard}", (Rack(f"single{shard}/rack", ((shard, weight),)),)))


def _draw(key: Column, name: str, weight: float) -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(name)), 11).cast("double") + F.lit(0.5)) * F.lit(2.0**-53)
    return -F.log(u) / F.lit(float(weight))


def _least(key: Column, children: list[tuple[str, float, int]]) -> Column:
    """The number of the child with the least draw; equal draws go to the smaller number."""
    live = [c for c in children if c[1] > 0]
    if len(live) == 1:
        return F.lit(live[0][2])
    return F.array_min(F.array(*[F.struct(_draw(key, n, w).alias("d"), F.lit(i).alias("i")) for n, w, i in live]))["i"]


def descend(df: DataFrame, key: Column, tree: tuple[Region, ...], out: str) -> DataFrame:
    """df with the shard number of each row in column `out`. A null key is one key like any other."""
    region, rack = f"{out}__region", f"{out}__rack"
    df = df.withColumn(region, _least(key, [(r.name, r.weight, i) for i, r in enumerate(tree)]))

    def by_node(at: str, nodes: list[tuple[int, Column]]) -> Column:
        found = F.lit(None).cast("int")
        for i, chosen in reversed(nodes):
            found = F.when(F.col(at) == i, chosen).otherwise(found)
        return found

    racks = [(i, j, k) for i, r in enumerate(tree) for j, k in enumerate(r.racks)]
    number = {(i, j): n for n, (i, j, _) in enumerate(racks)}
    df = df.withColumn(
        rack,
        by_node(region, [(i, _least(key, [(k.name, k.weight, number[i, j]) for j, k in enumerate(r.racks)])) for i, r in enumerate(tree)]),
    )
    df = df.withColumn(
        out,
        by_node(rack, [(n, _least(key, [(f"{k.name}/{s}", w, s) for s, w in k.shards])) for n, (_, _, k) in enumerate(racks)]).cast("int"),
    )
    return df.drop(region, rack)


def shard_documents(docs: DataFrame, shards: int = 16, tree: tuple[Region, ...] | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of docs.

    Texts of any length stay where they are; only their size and crc travel. Law `key`: doc_id and the tree decide the shard. A null doc_id is a key of its own; rows that share a doc_id
    share a shard and get different slots; a null text counts as empty (size 1, crc 0); an empty table gives no
    rows; other columns are ignored. Slots number the rows of a shard from 0 without gaps: equal rows are counted
    before the shuffle, and what is left is numbered in SLOT_BUCKETS hash buckets a shard, each shifted by the rows
    of the buckets before it, so neither a shard nor a key that many rows share has to fit in a task. The offsets
    have shards x SLOT_BUCKETS rows at most and are broadcast up to 100,000 rows.
    """
    tree = tree or uniform_tree(shards)
    leaves = [s for r in tree for k in r.racks for s, _ in k.shards]
    more = with_shard(tree, 1 + max(leaves))
    counted = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(F.col("text")), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text_of(), "UTF-8")).cast("long").alias("text_crc32"),
    ).groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n"))
    bucket = F.pmod(F.xxhash64(F.lit("slot"), F.col("doc_id"), F.col("size"), F.col("text_crc32")), F.lit(SLOT_BUCKETS)).cast("int")
    groups = materialize(descend(counted, F.col("doc_id"), tree, "shard").withColumn("bucket", bucket), "shard-groups")
    offsets = groups.groupBy("shard", "bucket").agg(F.sum("n").alias("n")).selectExpr(
        "shard AS o_shard",
        "bucket AS o_bucket",
        "coalesce(sum(n) OVER (PARTITION BY shard ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before",
    )
    rows = descend(groups, F.col("doc_id"), more, "grown_shard").selectExpr(
        "*", "coalesce(sum(n) OVER (PARTITION BY shard, bucket ORDER BY doc_id, text_crc32, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS inside"
    )
    placed = rows.join(broadcast_if_small(offsets, len(leaves) * SLOT_BUCKETS), (F.col("shard") == F.col("o_shard")) & (F.col("bucket") == F.col("o_bucket")))
    return each_copy(placed, "n", "copy").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("before") + F.col("inside") + F.col("copy")).cast("long").alias("slot"),
        "grown_shard",
    )
