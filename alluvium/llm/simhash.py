"""SimHash near-dedup by segment popcounts.

A fingerprint is cut into segments; the number of ones in each segment embeds it in a grid where the Manhattan
distance of two points is at most their Hamming distance. For 64 bits and distance 4 the 32 two-bit segments form g
groups, 6 to 10 by the number of points: a Manhattan distance of 4 leaves at least g - 4 groups equal, so the grid
cells of each choice of g - 4 groups, joined, hold every pair that can link. In a cell, pairs over the Manhattan bound
(of byte segments) go first, then the bits are compared. Equal fingerprints are one point; links become components, never pairs of rows.

keep_one links by the Jaccard similarity of distinct five-word shingles, 0.8 or more, and the fingerprint only sorts out
candidates. Sets whose first 64 bits differ in 4 or fewer are retrieved by segment popcounts, as above. A cover by equal
groups at 80 of 256 bits has cells that most points share, so what lies farther apart is met by prefixes: put in one order, the first n // 5 + 1 of n shingles of two such
sets have one in common, whatever the order. Shingles that a sample finds often come last, so cells stay small.
Candidates are held together as groups, never as pairs, and each group's sets are compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cells import connected, dealt, grown, marked, meeting, runs, spread, stars
from .common import apart, broadcast_if_small, keyed, materialize, text_of
from .components import components

SEED = 42


@dataclass(frozen=True)
class Scheme:
    """words in a shingle, 64-bit words in a fingerprint, most differing bits; grid cells hold up to 4 of 64 bits."""

    shingle: int = 4
    width: int = 1
    distance: int = 4


#: Links at 4 or fewer of 64 bits, each of them found.
LINKS = Scheme()
#: Candidates for similarity 0.8 on five-word shingles. Shingle sets of Jaccard J have a cosine near 2J / (1 + J), so
#: 256 bits differ in 256 * acos(cos) / pi: 39 bits at 0.8 with a deviation near 6, and 80 lie over six of these away;
#: of 198,000 pairs between 0.8 and 0.82 the farthest were 62 apart. Unrelated sets are 128 apart with a deviation of 8.
SIMILAR = Scheme(shingle=5, width=4, distance=80)

#: Distinct texts that the sample of frequent shingles aims at, and the most shingles it names.
SAMPLE = 4000
FREQUENT = 200_000
#: The most shingles in a chunk of a candidate group, and the fewest that one is cut down to; a part holds two chunks.
CHUNK, FINE = 1 << 20, 1 << 14
#: Shingles that are held against one set at a time.
MEMBERS = 1 << 17

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def _mix(h: np.ndarray, k: int) -> np.ndarray:
    """The k-th derived hash: an add and two multiply-shift rounds on 64 bits."""
    x = h + np.uint64(k * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, shingle: int) -> np.ndarray:
    """The hashes of the word shingles, repeats included; a shorter text is one shingle, one without words has none."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = list(map(b" ".join, zip(*[words[i:] for i in range(shingle)])))
    return np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, len(grams))


def _majority(h: np.ndarray, width: int) -> bytes:
    out = b""
    for k in range(width):
        octets = (_mix(h, k) if k else h).astype(">u8").view(np.uint8).reshape(-1, 8)
        ones = np.concatenate([np.bincount(octets[:, b], minlength=256) @ _BITS for b in range(8)])
        out += np.packbits(2 * ones > len(h)).tobytes()
    return out


def fingerprint(text: str, shingle: int = 4, width: int = 1) -> bytes:
    """Big-endian bits, each 1 if set in over half of the hashes of the word shingles, repeats included."""
    return _majority(shingles(text, shingle), width)


def _fingerprints(scheme: Scheme):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t or "", scheme.shingle, scheme.width) for t in batch.column(2).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(fps, pa.binary())], ["doc_id", "text_key", "node"])

    return run


def _matrix(column, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 8 * width)


def groups_for(points: int) -> int:
    """Groups of segments: more for more points, so that cells stay small. With g groups, g - 4 are equal in a link, and
    each of the tables keys on g - 4 of them: about 1.5 bits for each of the segments they hold."""
    return min(10, 6 + max(0, points.bit_length() - 15) // 4)


def cell_keys(octets: np.ndarray, groups: int = 6) -> np.ndarray:
    """points x tables: which cell of each table's grid a fingerprint lies in."""
    bits = np.unpackbits(octets, axis=1)
    counts = (bits[:, ::2] + bits[:, 1::2]).astype(np.int64)  # ones in each two-bit segment
    codes = [g @ (3 ** np.arange(g.shape[1])) for g in np.array_split(counts, groups, axis=1)]
    base = 3 ** -(-counts.shape[1] // groups)
    return np.stack([(t << 40) + sum(codes[g] * base**k for k, g in enumerate(some)) for t, some in enumerate(combinations(range(groups), groups - LINKS.distance))], axis=1)


def _cells(scheme: Scheme, groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = cell_keys(_matrix(batch.column(0), scheme.width), groups)
            rows = np.repeat(np.arange(len(keys)), keys.shape[1])
            yield pa.record_batch([pa.array(keys.reshape(-1)), batch.column(0).take(pa.array(rows))], ["cell", "node"])

    return run


def _links(scheme: Scheme):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, number in runs(batches):
            nodes = table.column("node").combine_chunks()
            octets = _matrix(nodes, scheme.width)
            ones = np.bitwise_count(octets).astype(np.int16)
            longs = octets.view(np.uint64)
            found = []
            for i, j in meeting(number, table.column("chunk").to_numpy(), table.column("part").to_numpy()):
                near = np.abs(ones[i].sum(1) - ones[j].sum(1)) <= scheme.distance if len(i) else np.zeros(0, bool)
                i, j = i[near], j[near]
                bound = np.abs(ones[i] - ones[j]).sum(1) <= scheme.distance  # Manhattan, at most the true distance
                i, j = i[bound], j[bound]
                true = np.bitwise_count(longs[i] ^ longs[j]).sum(1) <= scheme.distance
                found.append((i[true], j[true]))
            root = stars(len(octets), found)
            at = np.flatnonzero(root != np.arange(len(root)))
            yield pa.record_batch([nodes.take(pa.array(at)), nodes.take(pa.array(root[at]))], schema=pa.schema([("u", nodes.type), ("v", nodes.type)]))

    return run


def fingerprints(docs: DataFrame, scheme: Scheme = LINKS) -> DataFrame:
    """doc_id, text_key, node (the fingerprint's bytes) of every row."""
    rows = keyed(docs).select("doc_id", "text_key", "text")
    return materialize(rows.mapInArrow(_fingerprints(scheme), "doc_id long, text_key long, node binary"), "simhash-fingerprints")


def linked(prints: DataFrame, scheme: Scheme = LINKS) -> DataFrame:
    """node, root: the component of every distinct fingerprint that links to another; roots are left out."""
    points = materialize(prints.select("node").distinct(), "simhash-nodes")
    cells = points.mapInArrow(_cells(scheme, groups_for(points.count())), "cell long, node binary")
    stars_found = dealt(cells).mapInArrow(_links(scheme), "u binary, v binary")
    return components(stars_found, "simhash-links")


def _classes(prints: DataFrame, links: DataFrame, least) -> DataFrame:
    """c_node, found: each node and the least `least` of the documents of its component in links (node, root)."""
    by_node = prints.groupBy("node").agg(F.min(least).alias("least"))
    roots = links.select(F.col("node").alias("l_node"), "root")
    tied = materialize(by_node.join(roots, F.col("node") == F.col("l_node"), "left").select("node", F.coalesce("root", "node").alias("root"), "least"), "simhash-classes")
    by_root = tied.groupBy("root").agg(F.min("least").alias("found")).select(apart("root").alias("b_root"), "found")
    return tied.join(by_root, F.col("root") == F.col("b_root")).select(F.col("node").alias("c_node"), "found")


def near_duplicates(docs: DataFrame, scheme: Scheme = LINKS) -> DataFrame:
    """doc_id, fingerprint, component_id for every row of docs.

    A null or empty text has fingerprint zero and links like any other; a null doc_id gets the least doc_id of its
    component and is never one; repeated rows share a component; an empty table gives no rows; other columns are
    ignored. A text of any length is read whole, in one task.
    """
    prints = fingerprints(docs, scheme)
    classes = _classes(prints, linked(prints, scheme), F.col("doc_id"))
    return prints.join(classes, F.col("node") == F.col("c_node")).select("doc_id", F.lower(F.hex("node")).alias("fingerprint"), F.col("found").alias("component_id"))


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def _set_of(text: str | None, scheme: Scheme) -> tuple[np.ndarray, int]:
    """The distinct shingles in rising order and the set's 64-bit name."""
    found = np.unique(shingles(text or "", scheme.shingle))
    name = xxhash.xxh3_64_intdigest(found.tobytes(), SEED)
    return found, name - (name >> 63 << 64)


def _frequent(docs: DataFrame, scheme: Scheme) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that three or more of the sampled texts hold, in rising order, and in how many: only the order of
    prefixes, and so the size of cells, hangs on them."""
    k = max(1, docs.count() // SAMPLE)
    texts = keyed(docs).where(F.pmod(F.xxhash64(F.lit("sample"), "text_key"), F.lit(k)) == 0).dropDuplicates(["text_key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0).to_pylist():
                yield pa.record_batch([_signed(_set_of(text, scheme)[0])], ["h"])

    counts = texts.select("text").mapInArrow(run, "h long").groupBy("h").agg(F.count("*").alias("n")).where("n >= 3")
    rows = counts.orderBy(F.desc("n"), "h").limit(FREQUENT).collect()
    h, n = (np.array([r[c] for r in rows], np.int64) for c in ("h", "n"))
    h = h.view(np.uint64)
    order = np.argsort(h)
    return h[order], n[order]


def prefix(found: np.ndarray, often: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Of n distinct shingles the first n // 5 + 1, rare before frequent. Two sets with Jaccard 0.8 or more share at
    least ceil(0.8 n) shingles of either, so the first they share lies in both prefixes."""
    rank = np.zeros(len(found), np.int64)
    if len(often):
        at = np.minimum(np.searchsorted(often, found), len(often) - 1)
        rank = np.where(often[at] == found, times[at], 0)
    return found[np.lexsort((found, rank))[: len(found) // 5 + 1]]


def _sketches(scheme: Scheme, often: np.ndarray, times: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 512) for b in batches for at in range(0, b.num_rows, 512)):
            nodes, sizes, fps, cells = [], [], [], []
            for text in batch.column(2).to_pylist():
                found, name = _set_of(text, scheme)
                nodes.append(name)
                sizes.append(len(found))
                fps.append(_majority(found, scheme.width))
                cells.append(prefix(found, often, times).tobytes())
            longs = np.frombuffer(b"".join(fps), np.int64).reshape(-1, scheme.width)
            parts = [pa.array(np.ascontiguousarray(longs[:, k])) for k in range(scheme.width)]
            columns = [batch.column(0), batch.column(1), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()), *parts, pa.array(cells, pa.binary())]
            yield pa.record_batch(columns, ["doc_id", "text_key", "node", "size", *_bits(scheme), "cells"])
        pa.default_memory_pool().release_unused()

    return run


def _bits(scheme: Scheme) -> list[str]:
    return [f"f{k}" for k in range(scheme.width)]


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            held = part.column(1).to_pylist()
            rows = np.repeat(np.arange(len(held)), [len(x) // 8 for x in held])
            yield pa.record_batch([pa.array(np.frombuffer(b"".join(held), np.int64)), part.column(0).take(pa.array(rows))], ["cell", "node"])


def _near(size: np.ndarray, longs: np.ndarray, distance: int):
    """Whether rows i and j can be similar by the sizes of their sets, by the Manhattan distance of the ones in each word
    of their fingerprints, which is at most the bits apart, and by these bits."""
    ones = np.bitwise_count(longs).astype(np.int16)

    def near(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        fits = 5 * np.minimum(size[i], size[j]) >= 4 * np.maximum(size[i], size[j])
        at = np.flatnonzero(fits)
        fits[at] = np.abs(ones[i[at]] - ones[j[at]]).sum(1) <= distance
        at = at[fits[at]]
        fits[at] = np.bitwise_count(longs[i[at]] ^ longs[j[at]]).sum(1) <= distance
        return fits

    return near


def _longs(table: pa.Table, scheme: Scheme) -> np.ndarray:
    return np.stack([table.column(f).to_numpy() for f in _bits(scheme)], axis=1).view(np.uint64)


def _star(nodes: np.ndarray, lead: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(nodes != nodes[lead])
    return pa.record_batch([pa.array(nodes[at]), pa.array(nodes[lead[at]])], ["u", "v"])


def _met(scheme: Scheme):
    """Each set of a cell and the first that it could be similar to, directly or through others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, number in runs(batches):
            near = _near(table.column("size").to_numpy(), _longs(table, scheme), scheme.distance)
            yield _star(table.column("node").to_numpy(), connected(number, near))

    return run


def _sets(scheme: Scheme, *others: str):
    """(text, node, others...) -> (others..., node, members), each node once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                take = []
                for i, node in enumerate(part.column(1).to_pylist()):
                    if node not in seen:
                        seen.add(node)
                        take.append(i)
                part = part.take(pa.array(take, pa.int64()))
                sets = [_set_of(t, scheme)[0] for t in part.column(0).to_pylist()]
                ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                members = pa.ListArray.from_arrays(pa.array(ends), _signed(np.concatenate([np.zeros(0, np.uint64), *sets])))
                yield pa.record_batch([*part.columns[2:], part.column(1), members], [*others, "node", "members"])
        pa.default_memory_pool().release_unused()

    return run


def _alike(size: np.ndarray, longs: np.ndarray, members: pa.ListArray, distance: int):
    """Whether set i has Jaccard 0.8 or more with each of the sets `rest`, told from the sets' members."""
    near = _near(size, longs, distance)
    _, ids = np.unique(members.flatten().to_numpy(), return_inverse=True)
    end = np.cumsum(size)
    first, held = end - size, np.zeros(len(ids), bool)

    def alike(i: int, rest: np.ndarray) -> np.ndarray:
        out = near(np.full(len(rest), i), rest)
        at = np.flatnonzero(out)
        held[ids[first[i] : end[i]]] = True
        # so many sets at a time as hold MEMBERS shingles, one at least
        upto = np.cumsum(size[rest[at]])
        begin = 0
        while begin < len(at):
            stop = max(begin + 1, int(np.searchsorted(upto, (upto[begin - 1] if begin else 0) + MEMBERS, "right")))
            j = rest[at[begin:stop]]
            starts = np.cumsum(size[j]) - size[j]
            where = np.arange(size[j].sum()) + np.repeat(first[j] - starts, size[j])
            common = np.add.reduceat(held[ids[where]], starts, dtype=np.int64)
            out[at[begin:stop]] = 5 * common >= 4 * (size[i] + size[j] - common)
            begin = stop
        held[ids[first[i] : end[i]]] = False
        return out

    return alike


def _verified(scheme: Scheme):
    """Of the sets that meet in a part, each and the first that it is similar to, directly or through others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, number in runs(batches):
            cuts = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1], [True]]))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if b - a < 2:
                    continue
                part = table.slice(a, b - a)
                part = part.take(pa.array(np.sort(np.unique(part.column("node").to_numpy(), return_index=True)[1])))
                size = part.column("size").to_numpy().astype(np.int64)
                alike = _alike(size, _longs(part, scheme), part.column("members").combine_chunks(), scheme.distance)
                yield _star(part.column("node").to_numpy(), grown(len(size), alike))

    return run


def _met_by_popcounts(points: DataFrame) -> DataFrame:
    """u, v of the sets whose fingerprints' first 64 bits link, each with the least of its component."""
    held = points.select("node", F.unhex(F.lpad(F.hex("f0"), 16, "0")).alias("bits"))
    found = linked(held.select(F.col("bits").alias("node"))).select(F.col("node").alias("l_node"), "root")
    tied = materialize(held.join(found, F.col("bits") == F.col("l_node"), "left").select("node", F.coalesce("root", "bits").alias("root")), "simhash-tied")
    least = tied.groupBy("root").agg(F.min("node").alias("v"), F.count("*").alias("n")).where("n > 1").select(apart("root").alias("b_root"), "v")
    return tied.join(least, F.col("root") == F.col("b_root")).select(F.col("node").alias("u"), "v").where("u <> v")


def similar(prints: DataFrame, docs: DataFrame, scheme: Scheme = SIMILAR) -> DataFrame:
    """node, root of every set that has Jaccard 0.8 or more with another, through any chain; roots are left out.

    Sets that link by popcounts, and for the rest those that share a prefix's cell and pass by size and fingerprint, hang
    together in candidate groups, found without listing a pair. A set's members then go once to its group (to each part of a group beyond CHUNK shingles) and are compared
    exactly there; what leaves the task is one row a set.
    """
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_key")
    kept = ["size", *_bits(scheme), "cells"]
    points = prints.groupBy("node").agg(F.min(place).alias("of"), *[F.first(c).alias(c) for c in kept])
    points = materialize(points, "simhash-points")
    cells = points.select("node", "cells").mapInArrow(_prefixes, "cell long, node long")
    counts = cells.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1").select(apart("cell").alias("c_cell"))
    shared = materialize(cells.join(counts, F.col("cell") == F.col("c_cell")).select("cell", "node"), "simhash-shared")
    info = points.select(F.col("node").alias("i_node"), "size", *_bits(scheme))
    rows = shared.join(info, F.col("node") == F.col("i_node"))
    met = dealt(rows, "size", *_bits(scheme), counted=shared).mapInArrow(_met(scheme), "u long, v long")
    groups = components(met.unionByName(_met_by_popcounts(points)), "simhash-met").select(F.col("node").alias("g_node"), "root")

    groups = materialize(groups.unionByName(groups.select(F.col("root").alias("g_node"), "root").distinct()), "simhash-groups")
    named = points.join(groups, F.col("node") == F.col("g_node")).select(F.col("root").alias("cell"), "node", "size", *_bits(scheme), F.col("of.doc_id").alias("n_id"), F.col("of.text_key").alias("n_key"))
    named = materialize(marked(named, weight="size", most=CHUNK, fine=FINE), "simhash-named")
    few = broadcast_if_small(named, named.count())
    texts = keyed(docs).join(few, F.col("doc_id").eqNullSafe(F.col("n_id")) & (F.col("text_key") == F.col("n_key")))
    others = ["cell", "k", "chunk", "size", *_bits(scheme)]
    kinds = ", ".join(["cell long, k int, chunk int, size int", *[f"{f} long" for f in _bits(scheme)], "node long, members array<long>"])
    sets = texts.select("text", "node", *others).mapInArrow(_sets(scheme, *others), kinds)
    links = spread(sets, "size", *_bits(scheme), "members").mapInArrow(_verified(scheme), "u long, v long")
    return components(links, "simhash-links")


def keep_one(docs: DataFrame, scheme: Scheme = SIMILAR) -> DataFrame:
    """docs with one document of each group linked by Jaccard 0.8 or more: that with the smallest doc_id (nulls last),
    the same row repeated once. Null and empty texts and those of white space have the same empty set and form one
    group; a text of fewer than five words is one shingle; ties of doc_id go by the text's hash; an empty table gives
    no rows; columns of any other name pass. A text is read whole by one task, and its set, 8 bytes a distinct shingle,
    goes to a task at most once for each part of its candidate group.

    The rows to take out, and the few keys whose row is repeated, are found on (doc_id, text) keys and joined with
    the documents once; the rest pass unchanged.
    """
    longs = ", ".join(f"{f} long" for f in _bits(scheme))
    sketch = _sketches(scheme, *_frequent(docs, scheme))
    kind = f"doc_id long, text_key long, node long, size int, {longs}, cells binary"
    prints = materialize(keyed(docs).select("doc_id", "text_key", "text").mapInArrow(sketch, kind), "simhash-sketches")
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_key")
    classes = _classes(prints, similar(prints, docs, scheme), place)
    rows = prints.join(classes, F.col("node") == F.col("c_node")).select("doc_id", "text_key", (place == F.col("found")).alias("stays"))
    acts = rows.groupBy(F.col("doc_id").alias("__d_id"), F.col("text_key").alias("__d_key")).agg(F.max("stays").alias("__d_stays"), F.count("*").alias("__d_n"))
    acts = materialize(acts.where("NOT __d_stays OR __d_n > 1"), "simhash-acts")
    marked = docs.withColumn("__d_text", F.xxhash64(text_of())).join(
        acts, F.col("doc_id").cast("long").eqNullSafe(F.col("__d_id")) & (F.col("__d_text") == F.col("__d_key")), "left"
    )
    once = marked.where("__d_stays IS NULL").select(*[docs[c] for c in docs.columns])
    several = marked.where("__d_stays").dropDuplicates(["__d_id", "__d_key"]).select(*[docs[c] for c in docs.columns])
    return once.unionByName(several)
