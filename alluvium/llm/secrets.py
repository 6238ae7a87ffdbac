"""Secret scans with corpus-wide ownership frequency (DataFrame functions only).

Each text is split by the pattern of each kind; the lengths of the pieces and of the matches, summed along the
text, give the spans. Every candidate's value is hashed, and the corpus says by how many owners and in how many
repositories a hash occurs, both counted over distinct pairs, so a value that a third of all rows share is reduced
before each shuffle. A value is a copied example if more than max_owners owners hold it in more than max_repos
repositories; any other looks live. So copies of one text under many owners change nothing, and neither does the number
of texts in which one owner's key occurs, however many they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import apart, keyed, materialize, text_of

# Kinds in their order, with pattern, the group that holds the value, and the least characters.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE_KINDS = (
    ("assign", ASSIGN, 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]{16,}+", 0, 16),  # maximal runs, so the least length may stand in the pattern
)
#: What the method adds: long tokens that mix capitals, small letters and digits, if few owners hold them.
TOKEN = ("live", r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}+", 0, 24)
ANY = "|".join([ASSIGN, r"AKIA[A-Z0-9]{14}", r"[0-9a-f]{16}", TOKEN[1]])

#: Documents and spans in them that are broadcast at most; about 60 bytes each.
FEW = 200_000
#: The most owners, and the most repositories, of a live value; it takes more of both to make an example.
MAX_OWNERS = 2
MAX_REPOS = 2
#: Code points in which a text is cut, so that a piece is found without a walk from the text's start.
BLOCK = 4096


def _hits(number: int, pattern: str, group: int) -> Column:
    """An array of (kind, nth, gap, hit): code points between the last match and this, and the match's parts."""
    hits = F.regexp_extract_all(F.col("text"), F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(F.col("text"), F.lit(pattern), F.lit(group)) if group else hits
    gaps = F.transform(F.split(F.col("text"), pattern, -1), lambda p: F.length(p))
    # the text after the last match is cut off, so that the three arrays have one entry a match
    zipped = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(hits)).alias("gap"), hits.alias("hit"), values.alias("value"))
    return F.transform(
        zipped,
        lambda x, i: F.struct(
            F.lit(number).alias("kind"), i.alias("nth"), x["gap"].alias("gap"), F.length(x["hit"]).alias("len"), x["value"].alias("value")
        ),
    )


def candidates(docs: DataFrame, owner_col: str = "source", repo_col: str | None = None) -> DataFrame:
    """One row a span: doc_id, text_key, owner, repo, kind (0, 1, ...: base kinds, then the added one), start, end, value.

    Starts and ends are in code points, ends exclusive. Base kinds: leftmost matches that don't overlap, kept where
    the value is long enough. Rows repeated in full count once. A document's repository is repo_col, or without one
    its text, so that copies of a text are one repository.
    """
    kinds = (*BASE_KINDS, TOKEN)
    named = docs.select("doc_id", "text", F.col(owner_col).cast("string").alias("owner"), F.lit(None).cast("string").alias("repo") if repo_col is None else F.col(repo_col).cast("string").alias("repo"))
    found = keyed(named, "owner", "repo").where(F.col("text").rlike(ANY))
    repo = (F.col("text_key") if repo_col is None else F.xxhash64("repo")).alias("repo")
    hits = F.concat(*[_hits(n, p, g) for n, (_, p, g, _) in enumerate(kinds)])
    rows = found.select("doc_id", "text_key", "owner", repo, F.inline(hits)).dropDuplicates(["doc_id", "text_key", "owner", "repo", "kind", "nth"])
    ended = rows.selectExpr("*", "sum(gap + len) OVER (PARTITION BY doc_id, text_key, owner, repo, kind ORDER BY nth) AS end")
    least = F.lit(None)
    for n, (_, _, _, few) in enumerate(kinds):
        least = F.when(F.col("kind") == n, few).otherwise(least)
    mixed = F.col("value").rlike("[A-Z]") & F.col("value").rlike("[a-z]") & F.col("value").rlike("[0-9]")
    return ended.where(F.length("value") >= least).where((F.col("kind") < len(BASE_KINDS)) | mixed).select(
        "doc_id", "text_key", "owner", "repo", "kind", (F.col("end") - F.col("len")).cast("long").alias("start"), F.col("end").cast("long").alias("end"), "value"
    )


def ownership(spans: DataFrame) -> DataFrame:
    """value_hash, n_owners, n_repos, a row a value; a null owner counts as one."""
    seen = spans.select(F.sha2("value", 256).alias("value_hash"), F.coalesce("owner", F.lit("\0")).alias("owner"), "repo")
    owners = seen.select("value_hash", "owner").distinct().groupBy("value_hash").agg(F.count("*").alias("n_owners"))
    repos = seen.select("value_hash", "repo").distinct().groupBy("value_hash").agg(F.count("*").alias("n_repos"))
    return owners.join(repos, "value_hash")


def copied(max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> Column:
    """The corpus's verdict on n_owners and n_repos."""
    return (F.col("n_owners") > max_owners) & (F.col("n_repos") > max_repos)


def judged(docs: DataFrame, owner_col: str = "source", max_owners: int = MAX_OWNERS, repo_col: str | None = None, max_repos: int = MAX_REPOS) -> DataFrame:
    """The spans of candidates(): all base ones, and of the added kind the live ones; with n_owners, n_repos and live."""
    spans = materialize(candidates(docs, owner_col, repo_col), "secret-spans")
    with_hash = spans.withColumn("value_hash", F.sha2("value", 256))
    counts = ownership(spans).select(apart("value_hash").alias("o_hash"), "n_owners", "n_repos")
    rated = with_hash.join(counts, F.col("value_hash") == F.col("o_hash")).withColumn("live", ~copied(max_owners, max_repos))
    return rated.where((F.col("kind") < len(BASE_KINDS)) | F.col("live"))


def spans_by_document(docs: DataFrame, owner_col: str = "source", max_owners: int = MAX_OWNERS, repo_col: str | None = None, max_repos: int = MAX_REPOS) -> DataFrame:
    """doc_id, text_key, spans: array of (start, kind, end, secret_start, live, n_owners, n_repos), by start and kind; kept:
    array of (from, to), the stretches of text before each value, where values that overlap count as one; last: the end of
    the last value. Only documents with a span. An added span that touches a base one is none.

    Both go along the sorted spans once, with the greatest end so far.
    """
    by_doc = Window.partitionBy("doc_id", "text_key")
    base = F.col("kind") < len(BASE_KINDS)
    # a base span counts from its start on, an added one asks at its end for all that start before
    met = F.max(F.when(base, F.col("end"))).over(by_doc.orderBy(F.when(base, F.col("start")).otherwise(F.col("end")), base).rowsBetween(Window.unboundedPreceding, 0))
    rows = judged(docs, owner_col, max_owners, repo_col, max_repos).withColumn("met", met).where(base | F.coalesce(F.col("met") <= F.col("start"), F.lit(True)))
    rows = rows.withColumn("secret_start", F.col("end") - F.length("value"))
    before = F.coalesce(F.max("end").over(by_doc.orderBy("secret_start", "end").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    rows = rows.withColumn("before", before)
    one = F.struct("start", "kind", "end", "secret_start", "live", "n_owners", "n_repos")
    stretch = F.when(F.col("secret_start") >= F.col("before"), F.struct(F.col("before").alias("from"), F.col("secret_start").alias("to")))
    return rows.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set(one)).alias("spans"), F.array_sort(F.collect_set(stretch)).alias("kept"), F.max("end").alias("last"))


def _joined(spans: Column) -> Column:
    names = [k[0] for k in (*BASE_KINDS, TOKEN)]
    name = lambda n: F.element_at(F.array(*[F.lit(x) for x in names]), n + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _joined_counts(name: str) -> Column:
    return F.coalesce(F.array_join(F.transform("spans", lambda s: s[name].cast("string")), ","), F.lit(""))


def scan(docs: DataFrame, owner_col: str = "source", max_owners: int = MAX_OWNERS, repo_col: str | None = None, max_repos: int = MAX_REPOS) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied, n_owners, n_repos for every row of docs.

    A null text counts as empty and has no span; a null owner is an owner; rows repeated in full get the same result
    and count once in the corpus; rows that repeat only the doc_id are documents of their own; an empty table gives
    no rows; other columns are ignored. A text of any length is matched whole, in one task, in time that follows its length.
    n_live and n_copied count the spans by the corpus's verdict; n_owners and n_repos have a count for each of the spans, in
    their order.
    """
    found = spans_by_document(docs, owner_col, max_owners, repo_col, max_repos).select(F.col("doc_id").alias("f_id"), F.col("text_key").alias("f_key"), "spans")
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("text_key"))
    joined = ids.join(found, F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("text_key") == F.col("f_key")), "left")
    count = lambda cond: F.coalesce(F.size(F.filter("spans", cond)), F.lit(0)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < len(BASE_KINDS))
    n = lambda cond: F.when(F.col("spans").isNull(), F.lit(0)).otherwise(count(cond)).cast("long")
    return joined.select(
        "doc_id",
        n(lambda s: s["kind"] == 0).alias("n_assign"),
        n(lambda s: s["kind"] == 1).alias("n_access"),
        n(lambda s: s["kind"] == 2).alias("n_hex"),
        F.sha2(F.coalesce(_joined(base), F.lit("")), 256).alias("base_sha256"),
        F.coalesce(_joined(F.col("spans")), F.lit("")).alias("spans"),
        n(lambda s: s["live"]).alias("n_live"),
        n(lambda s: ~s["live"]).alias("n_copied"),
        *[_joined_counts(c).alias(c) for c in ("n_owners", "n_repos")],
    )


def _piece(stretch: Column) -> Column:
    """The code points from, ..., to of the text, out of its blocks."""
    start, end = stretch["from"], stretch["to"]
    first, last = F.floor(start / BLOCK).cast("int"), F.floor((end - 1) / BLOCK).cast("int")
    block = lambda i: F.get("__s_blocks", i)
    at = (start - first * BLOCK + 1).cast("int")
    within = F.substring(block(first), at, (end - start).cast("int"))
    between = F.array_join(F.slice("__s_blocks", first + 2, F.greatest(last - first - 1, F.lit(0))), "")
    across = F.concat(F.substring(block(first), at, F.lit(BLOCK)), between, F.substring(block(last), F.lit(1), (end - last * BLOCK).cast("int")))
    return F.when(end <= start, F.lit("")).when(first == last, within).otherwise(across)


def redact(docs: DataFrame, owner_col: str = "source", max_owners: int = MAX_OWNERS, mark: str = "<SECRET>", repo_col: str | None = None, max_repos: int = MAX_REPOS) -> DataFrame:
    """docs with the value of every span of scan() replaced by `mark` and n_chars counted anew; all rows stay.

    Values that overlap are replaced as one. A null text stays null and an empty one empty; rows repeated in full get
    the same text each; an empty table gives no rows. The stretches between the values are cut out of blocks of the text and
    joined once, so a long text with many spans takes time in proportion. Where the documents with spans are few, they are
    broadcast and the texts stay where they are; otherwise only documents whose text matches some pattern are joined with
    them and the others pass without a shuffle.
    """
    found = spans_by_document(docs, owner_col, max_owners, repo_col, max_repos).select(F.col("doc_id").alias("__s_id"), F.col("text_key").alias("__s_key"), F.col("kept").alias("__s_kept"), F.col("last").alias("__s_last"))
    found = materialize(found, "secret-found")
    size = found.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("__s_kept")), F.lit(0)).alias("spans")).first()
    few = size["n"] + size["spans"] <= FEW
    suspect = F.lit(True) if few else F.coalesce(F.col("text").rlike(ANY), F.lit(False))
    hit = docs.where(suspect).withColumn("__s_text", F.xxhash64(text_of()))
    side = F.broadcast(found) if few else found
    joined = hit.join(side, F.col("doc_id").cast("long").eqNullSafe(F.col("__s_id")) & (F.col("__s_text") == F.col("__s_key")), "left")
    hit_text = F.col("__s_kept").isNotNull()
    cut = joined.withColumn("__s_blocks", F.when(hit_text, F.regexp_extract_all("text", F.lit(f"(?s).{{1,{BLOCK}}}+"), F.lit(0))))
    rest = F.struct(F.col("__s_last").alias("from"), F.length("text").cast("long").alias("to"))
    pieces = F.transform(F.concat("__s_kept", F.array(rest)), _piece)
    # n_chars in a second step, so that the pieces are joined once
    redacted = cut.withColumn("text", F.when(hit_text, F.array_join(pieces, mark)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        redacted = redacted.withColumn("n_chars", F.when(~hit_text, F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    redacted = redacted.select(*docs.columns)
    return redacted if few else docs.where(~suspect).unionByName(redacted)
