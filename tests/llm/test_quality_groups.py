"""A group's thresholds move smoothly with its size, and no source dominates its language."""

from pyspark.sql import functions as F

from alluvium.llm import quality


def feats(spark, sizes):
    """(source, documents, mean word length) of one language; other features 0."""
    rows = [(f"d{k}", n, float(x)) for k, (n, x) in enumerate(sizes)]
    df = spark.createDataFrame(rows, "source string, n long, mean_word double").select("source", "mean_word", F.explode(F.sequence(F.lit(1), "n")))
    zero = [F.lit(0.0).alias(f) for f in quality.FEATURES if f != "mean_word"]
    return df.select(F.lit("en").alias("lang"), "source", F.lit(100).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_repeat_words"), "mean_word", *zero)


def high(spark, sizes):
    rows = quality.thresholds(feats(spark, sizes)).selectExpr("t_source", "limits.mean_word.high + limits.mean_word.reach").collect()
    return [r[1] for r in sorted(rows)]


def test_no_jump_with_size(spark):
    a, b = (high(spark, [(n, 4), (1000, 8), (1000, 8)])[0] for n in (199, 200))
    assert abs(a - b) < 0.05


def test_own_documents_count_at_every_size(spark):
    low, far = (high(spark, [(100, x), (1000, 8)])[0] for x in (4, 6))
    assert far - low > 0.5


def test_hot_source_does_not_dominate(spark):
    once, hot = (high(spark, [(20, 5), (1000, 5), (n, 9)])[0] for n in (1000, 20_000))
    assert abs(once - hot) < 0.3


def made(spark, n, parts):
    """n documents of one group, by a rule, dealt over so many partitions."""
    x = F.pmod(F.xxhash64("id"), F.lit(1000)).cast("double")
    zero = [(x / 5000 * i).alias(f) for i, f in enumerate(quality.FEATURES) if f != "mean_word"]
    rows = spark.range(n).select(F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(100).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_repeat_words"), (4 + F.sin("id") + x / 999).alias("mean_word"), *zero)
    return rows.repartition(parts, F.rand(parts))


def test_thresholds_are_the_same_in_any_order(spark):
    found = {str(quality.thresholds(made(spark, 50_000, parts)).collect()) for parts in (1, 7, 23, 23)}
    assert len(found) == 1


def test_quartiles_of_many_documents(spark):
    """Within the width of a bin of the exact ones, with so many documents that the group speaks for itself."""
    rows = made(spark, 50_000, 3)
    limits = quality.thresholds(rows).first()["limits"]
    for f in quality.FEATURES:
        values = sorted(r[0] for r in rows.select(f).collect())
        for name, p in (("low", 0.25), ("high", 0.75)):
            exact = values[int(p * len(values)) - 1]
            assert abs(limits[f][name] - exact) <= 0.006 * exact


def test_an_empty_group_and_zeros(spark):
    rows = made(spark, 500, 2).withColumn("source", F.when(F.col("capitals") < 0.4, "s")).withColumn("shouts", F.lit(0.0)).withColumn("n_words", F.when(F.col("source").isNull(), 3).otherwise(100).cast("long"))
    got = {r["t_source"]: r["limits"] for r in quality.thresholds(rows).collect()}
    assert set(got) == {None, "s"} and got["s"]["shouts"]["high"] == 0 and got[None]["shouts"]["high"] == 0
    assert abs(got[None]["mean_word"]["high"] - got["s"]["mean_word"]["high"]) < 1e-9
