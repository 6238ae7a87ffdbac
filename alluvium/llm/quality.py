"""Quality rules with adaptive thresholds.

Features of each whole text; per language and source a mergeable quantile sketch of each feature: how many documents lie in
each of its logarithmic bins, BINS a doubling, so a quantile is right within 0.6 % of its value. Counts add up alike in any
order, so reruns, other partitions and recovered tasks give the same thresholds. Thresholds
come from the sketches' quartiles; then every document is held against the thresholds of its group. At every size a
group's quartiles are drawn toward its language's, and a language's toward those of all, by the same rule: n documents
count against SHRINK. A source weighs n / (n + SHRINK) in its language, so no source has over one share of it.

A mean over few words scatters more, so a document of fewer than MIN_WORDS words may lie farther out, by the square
root of MIN_WORDS over its words. rate() gives the base rules' verdict beside this one; keep_good() goes by the
adaptive thresholds alone, which stand in place of the fixed cutoffs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, keyed, materialize

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50

#: feature -> (least spread, side): a document fails where its feature lies more than FENCE times the spread of its
#: group (quartile distance, or the least spread if that is larger) outside the quartiles, above or on both sides; more
#: where it has few words, see room().
FEATURES = {
    "mean_word": (0.5, "both"),
    "symbols": (0.05, "above"),
    "dup_lines": (0.15, "above"),
    "repeats": (0.1, "above"),
    "capitals": (0.06, "above"),
    "shouts": (0.05, "above"),
}
FENCE = 3.0
#: So many documents of a group weigh as much as its language does.
SHRINK = 200
#: Bins of a sketch a doubling of the value; 0 has one of its own.
BINS = 64
NO_BIN = -1_000_000

FEATURE_SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, " + ", ".join(f"{f} double" for f in FEATURES)
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in some three-word window which occurs twice or more."""
    n = len(words) - 2
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    v = len(number)
    pairs = ids[:-1] * v + ids[1:]
    if v > 2_000_000:  # three numbers no longer fit 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    key = pairs[:n] * v + ids[2:]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : n + k] |= twice
    return int(covered.sum())


def features(text: str) -> tuple:
    """The counts of the base rules, then the features of the adaptive ones; all 0 without a word."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes.split() cuts at the six ASCII white-space characters
    n = len(words)
    word_chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
    n_symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.split(None, 1)]
    dup_lines = len(lines) - len(set(lines))
    repeat = repeated_words(words)
    some = max(n, 1)
    capitals = sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    return (
        n, word_chars, n_symbols, dup_lines, repeat,
        word_chars / some, n_symbols / some, dup_lines / max(len(lines), 1), repeat / some,
        capitals / max(word_chars, 1), text.count("!") / some,
    )


def _with_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [*_COUNTS, *FEATURES]
    types = [pa.int64()] * len(_COUNTS) + [pa.float64()] * len(FEATURES)
    for batch in (b.slice(at, 512) for b in batches for at in range(0, b.num_rows, 512)):
        rows = [features(t or "") for t in batch.column(0).to_pylist()]
        extra = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
        yield pa.record_batch([*batch.columns[1:], *extra], [*batch.schema.names[1:], *names])


def document_features(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, lang, source, the five counts and the features of every row."""
    rows = keyed(docs, "lang", "source").select("text", "doc_id", "text_key", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"))
    return rows.mapInArrow(_with_features, "doc_id long, text_key long, lang string, source string, " + FEATURE_SCHEMA)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _drawn(n: Column, value: Column, toward_n: float, toward: Column) -> Column:
    """The mean of a value that n speak for and of one that toward_n do."""
    return F.when(n > 0, (n * value + toward_n * toward) / (n + toward_n)).otherwise(toward)


def _evenly(rows: DataFrame, names, *by: str) -> DataFrame:
    """The mean of each name by weight w, and the sum of w; in decimals, whose sums don't depend on the order."""
    total = lambda x: F.sum(x.cast("decimal(38,12)")).cast("double")
    return rows.groupBy(*by).agg(F.coalesce(total(F.col("w")), F.lit(0.0)).alias("w"), *[(total(F.col("w") * F.col(x)) / total(F.when(F.col("w") > 0, F.col("w")))).alias(x) for x in names])


def _bin(value: Column) -> Column:
    """The bin whose middle, by ratio, is nearest; a power of two is a middle, so no share of small numbers is an edge."""
    return F.when(value > 0, F.floor(F.log2(value) * BINS + 0.5)).otherwise(NO_BIN).cast("int")


def _value(bin_no: Column) -> Column:
    """A bin's middle."""
    return F.when(bin_no == NO_BIN, F.lit(0.0)).otherwise(F.pow(F.lit(2.0), bin_no / BINS))


def thresholds(feats: DataFrame) -> DataFrame:
    """t_lang, t_source, limits: one row a (lang, source), nulls a group of their own; limits: feature -> low, high (the
    quartiles), reach (how far outside them a document of MIN_WORDS words or more may lie).

    Documents that the base rules reject don't shape the thresholds.
    """
    ends = [f"{f}_{p}" for f in FEATURES for p in (25, 75)]
    # a group's buffer in this aggregate is the sketch: bin -> documents, merged by adding
    binned = feats.where(~base_failed()).select(F.col("lang").alias("s_lang"), F.col("source").alias("s_source"), *[_bin(F.col(f)).alias(f) for f in FEATURES])
    both = {f: F.expr(f"percentile_disc(array(0.25D, 0.75D)) WITHIN GROUP (ORDER BY {f})").alias(f) for f in FEATURES}
    sketched = binned.groupBy("s_lang", "s_source").agg(F.count("*").alias("n"), *both.values())
    quartiles = sketched.select("s_lang", "s_source", "n", *[_value(F.col(f)[i]).alias(f"{f}_{p}") for f in FEATURES for i, p in enumerate((25, 75))])
    groups = materialize(feats.select("lang", "source").distinct().join(quartiles, F.col("lang").eqNullSafe(F.col("s_lang")) & F.col("source").eqNullSafe(F.col("s_source")), "left").drop("s_lang", "s_source"), "quality-sketches")
    own = groups.select("lang", "source", F.coalesce("n", F.lit(0)).cast("double").alias("n"), *ends)
    by_lang = _evenly(own.withColumn("w", F.col("n") / (F.col("n") + SHRINK)), ends, "lang")
    overall = _evenly(by_lang.withColumn("w", F.col("w") / (F.col("w") + 1)), ends).first()  # one row of numbers
    by_lang = by_lang.select(F.col("lang").alias("l_lang"), F.struct("w", *ends).alias("l"))
    chosen = own.join(by_lang, F.col("lang").eqNullSafe(F.col("l_lang")))
    limits = []
    for f, (least, _) in FEATURES.items():
        low, high = (_drawn(F.col("n"), F.col(name), SHRINK, _drawn(F.col("l.w"), F.col(f"l.{name}"), 1, F.lit(overall[name]).cast("double"))) for name in (f"{f}_25", f"{f}_75"))
        limits.append(F.struct(low.alias("low"), high.alias("high"), (F.greatest(high - low, F.lit(least)) * FENCE).alias("reach")).alias(f))
    return chosen.select(F.col("lang").alias("t_lang"), F.col("source").alias("t_source"), F.struct(*limits).alias("limits"))


def room() -> Column:
    """How many times the reach of its group a document has, by its number of words."""
    return F.sqrt(F.greatest(F.lit(1.0), F.lit(float(MIN_WORDS)) / F.greatest(F.col("n_words"), F.lit(1))))


def judged(feats: DataFrame, limits: DataFrame) -> DataFrame:
    """feats with base_failed and fits, the adaptive verdict: true where there is no document to learn from."""
    fits = F.lit(True)
    for f, (_, side) in FEATURES.items():
        low, high, reach = (F.col(f"limits.{f}.{x}") for x in ("low", "high", "reach"))
        inside = F.col(f) <= high + reach * room()
        if side == "both":
            inside = inside & (F.col(f) >= low - reach * room())
        fits = fits & F.coalesce(inside, F.lit(True))
    known = materialize(limits, "quality-limits")
    joined = feats.join(broadcast_if_small(known, known.count()), F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source")), "left")
    return joined.withColumn("base_failed", base_failed()).withColumn("fits", fits)


def rate(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept for every row of docs.

    kept: the base rules and the adaptive thresholds both pass it. A text of any length is read whole, in one task. A
    null or empty text has no words and fails; a null lang or source is a group of its own; repeated rows get the same
    verdict each; an empty table gives no rows; other columns are ignored.
    """
    feats = materialize(document_features(docs), "quality-features")
    kept = (~F.col("base_failed") & F.col("fits")).alias("kept")
    return judged(feats, thresholds(feats)).select("doc_id", *_COUNTS, "base_failed", kept)


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of docs that have a word and that the adaptive thresholds pass, with their columns.

    No fixed cutoff decides, so a short text stays if it looks like its group. Where no document passes the base rules
    there is nothing to learn from, and all texts with a word stay. The rejected rows, by (doc_id, text), are the
    smaller side and are taken out by an anti join; rows repeated in full go or stay together. A null or empty text
    has no words and goes; a null lang or source is a group of its own; an empty table gives no rows; columns of any other name pass. A text is read whole by one task, which holds its
    words: about ten times its bytes.
    """
    feats = materialize(document_features(docs), "quality-features")
    out = judged(feats, thresholds(feats)).where(~F.col("fits") | (F.col("n_words") == 0)).select(F.col("doc_id").alias("__q_id"), F.col("text_key").alias("__q_key")).distinct()
    key = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    marked = docs.withColumn("__q_text", key)
    return marked.join(out, F.col("doc_id").cast("long").eqNullSafe(F.col("__q_id")) & (F.col("__q_text") == F.col("__q_key")), "left_anti").drop("__q_text")
