"""Mixing sources to target weights (DataFrame functions only).

Every document gets a hash-random key; within its source the documents stand in key order, range-cut into
2**BUCKET_BITS buckets by the key's high bits. Bucket totals are prefix-summed per source, then documents within
each bucket, so the place of every document in its source's word count is known without gathering a source in one
task. A source's budget is spent as whole epochs plus one cut through the order at the exact rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, broadcast_if_small, each_copy, materialize, shuffle_partitions

BUCKET_BITS = 12
SEED = "mix-1"


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def ranked(totals: DataFrame) -> DataFrame:
    """totals with rn, the place of each source by code point, null last, from 0.

    The sources are range-cut into parts and each part's places follow those of the parts before it, so no task sorts
    all of them; the only unpartitioned window is over one row a part.
    """
    parts = materialize(totals.repartitionByRange(shuffle_partitions(totals.sparkSession), "src_null", "src").withColumn("part", F.spark_partition_id()), "mix-sources")
    before = parts.groupBy("part").agg(F.count("*").alias("n")).selectExpr("part", "coalesce(sum(n) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before")
    nth = parts.selectExpr("*", "row_number() OVER (PARTITION BY part ORDER BY src_null, src) - 1 AS nth")
    return nth.join(F.broadcast(before), "part").withColumn("rn", F.col("before") + F.col("nth")).drop("part", "before", "nth")


def source_targets(totals: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """src, src_null, source_size, target from (src, src_null, source_size), one row a source.

    Sources by code point, null last, weigh as `weights`, repeating, and share the sum of all sizes; none gets over
    `most` times its size, and the excess is shared by weight among the rest until none is above. `level` is what a
    weight of 1 gets of the rest; it only rises from round to round, a source once full stays full, and the rounds end
    when no other becomes so. A round is one aggregate over the sources; one row of numbers comes to the driver.
    """
    weight = f"element_at(array({', '.join(map(str, weights))}), cast(pmod(rn, {len(weights)}) + 1 AS int))"
    shares = ranked(totals).selectExpr("src", "src_null", "source_size", f"cast({weight} AS double) AS w", f"cast({most} * source_size AS double) AS cap")
    shares = materialize(shares, "mix-shares")
    total, free = shares.selectExpr("coalesce(sum(source_size), 0)", "sum(w)").first()
    level, full = (total / free if free else 0.0), 0
    while True:
        over = F.col("cap") < F.col("w") * F.lit(level)
        n, spent, free = shares.agg(F.count_if(over), F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0.0)), F.sum(F.when(~over, F.col("w")))).first()
        if n <= full or not free:
            break
        level, full = (total - spent) / free, n
    return shares.select("src", "src_null", "source_size", F.least(F.col("cap"), F.col("w") * F.lit(level)).alias("target"))


def _placed(docs: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """Every document's key, the words of its source before it, the whole epochs and its words in the last, cut one."""
    sizes = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_source(), word_count().alias("size"), mix_key().alias("key"))
    # Rows alike are counted before the shuffle, so a doc_id that many rows share doesn't fill one bucket.
    base = materialize(sizes.groupBy(*sizes.columns).agg(F.count("*").alias("copies")).withColumn("bucket", F.shiftright(F.col("key"), 64 - BUCKET_BITS)), "mix-sizes")
    buckets = base.groupBy("src", "src_null", "bucket").agg(F.sum(F.col("size") * F.col("copies")).alias("n"))
    targets = source_targets(buckets.groupBy("src", "src_null").agg(F.sum("n").alias("source_size")), weights, most)
    offsets = (
        buckets.selectExpr(
            "*",
            "coalesce(sum(n) OVER (PARTITION BY src, src_null ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before",
        )
        .join(targets, ["src", "src_null"])
        .select("src", "src_null", "bucket", "before", "source_size", "target")
    )
    alike = base.selectExpr(
        "*",
        "coalesce(sum(size * copies) OVER (PARTITION BY src, src_null, bucket ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS inside",
    ).join(offsets, ["src", "src_null", "bucket"])
    placed = each_copy(alike, "copies", "copy").withColumn("inside", F.col("inside") + F.col("copy") * F.col("size"))
    budget = F.least(F.round(F.col("target")).cast("long"), F.lit(most) * F.col("source_size"))
    return (
        placed.withColumn("start", F.col("before") + F.col("inside"))
        .withColumn("budget", budget)
        .withColumn("epochs", F.floor(F.col("budget") / F.greatest(F.col("source_size"), F.lit(1))))
        .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size"))
        .withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("start"))))
    )


def _source() -> list[Column]:
    return [F.coalesce(F.col("source").cast("string"), F.lit("")).alias("src"), F.col("source").isNull().alias("src_null")]


def mix_key() -> Column:
    return F.xxhash64(F.lit(SEED), F.col("doc_id").cast("long"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """doc_id, size, source_size, target, taken, start for every row: `taken` words, repeats counted.

    A null source is a source of its own, the last; a null or empty text has size 0 and nothing taken; rows that
    repeat a doc_id are placed one after the other; an empty table gives no rows; other columns are ignored. The key
    is a hash of doc_id, so reruns agree. The document that the cut meets gives the words before the cut, so each
    source's words taken are its target to the nearest word. `start`: the words of its source before this document.
    """
    return _placed(docs, weights, most).select(
        "doc_id",
        F.col("size").cast("long").alias("size"),
        F.col("source_size").cast("long").alias("source_size"),
        "target",
        (F.col("epochs") * F.col("size") + F.col("part")).cast("long").alias("taken"),
        F.col("start").cast("long").alias("start"),
    )


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """The documents of the mix, whole, with the columns of docs: a row for each epoch that takes the document.

    The document that a cut meets is in if at least half of its words lie before the cut; rows that share its doc_id
    go with it. Documents without a word go with their key like the rest. A source's decision is its whole epochs
    and the last key taken, so the texts are joined with one row a source and never shuffled. A null source is a
    source of its own; a null or empty text has size 0 and goes with its key, or with its source's whole epochs; rows
    repeated in full each count; an empty table gives no rows; columns of any other name pass. Texts of any length are
    counted in place.
    """
    cuts = materialize(
        _placed(docs, weights, most)
        .groupBy(F.col("src").alias("__mix_src"), F.col("src_null").alias("__mix_null"))
        .agg(F.max("epochs").cast("int").alias("__mix_epochs"), F.max(F.expr("CASE WHEN part > 0 AND part * 2 >= size THEN key END")).alias("__mix_cut")),
        "mix-cuts",
    )
    src, src_null = _source()
    times = F.col("__mix_epochs") + F.when(F.col("__mix_key") <= F.col("__mix_cut"), 1).otherwise(0)
    joined = (
        docs.select(F.struct("*").alias("__mix_doc"), src.alias("__mix_s"), src_null.alias("__mix_n"), mix_key().alias("__mix_key"))
        .join(broadcast_if_small(cuts, cuts.count()), (F.col("__mix_s") == F.col("__mix_src")) & (F.col("__mix_n") == F.col("__mix_null")))
        .withColumn("__mix_times", times)
        .where("__mix_times > 0")
    )
    return joined.withColumn("__mix_epoch", F.explode(F.sequence(F.lit(1), F.col("__mix_times")))).select("__mix_doc.*")
