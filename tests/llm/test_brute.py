"""Sharding, mixing, quality verdicts and every pipeline stage against plain Python."""

import hashlib
import math
import zlib
from collections import Counter

import corpus_brute as brute
import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from alluvium.llm import mixing, quality, secrets, sharding, simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, text_key long, bucket int, root long, u string, n int"
TAIL = (7, 1, 2, 3, "u", 4)


def rows():
    rng = np.random.default_rng(12)
    vocab = np.array(["".join(rng.choice(list("abcdefghijklmnoprst"), rng.integers(3, 9))) for _ in range(900)])
    prose = lambda n: list(rng.choice(vocab, n))
    key = lambda: "".join(rng.choice(list("ABCDEFabcdef0123456789"), 28))
    shared, out = [key() for _ in range(3)], []
    for i in range(260):
        w = prose(int(rng.integers(54, 130)))
        if i % 11 == 0:
            w = [x.upper() for x in w]
        if i % 13 == 0:
            w = [f"{x}!!" for x in w]
        if i % 17 == 0:
            w += ["<|>", "***", "#"] * 30
        if i % 19 == 0:
            w = w[:8] * 12
        if i % 7 == 0:
            w += ["password:", key(), "secret=" + shared[i % 3], key()]
        text = " ".join(w) if i % 5 else "\n".join(" ".join(w[k : k + 9]) for k in range(0, len(w), 9))
        lang, source = ("en", "de", None)[i % 3], ("hot", "hot", "b", "c", None)[i % 5]
        out.append((i, text, lang, source))
        for c in range(i % 4 if i % 6 == 0 else 0):  # 1 to 3 copies, changed at the end by 0, 4, 8 ... words
            n = int(rng.integers(0, 15))
            out.append((1000 + 10 * i + c, " ".join([*w[: len(w) - n], *prose(n)]), lang, ("b", "hot")[c % 2]))
    out += [out[5], out[5], out[8], (3, out[9][1], "en", "b"), (None, out[12][1], "de", None), (None, None, None, None)]
    out += [(5000, None, "en", "hot"), (5001, "", "en", "hot"), (5002, " \n ", None, "b"), (5003, "few words", "en", "b"), (5004, " ".join(prose(20_000)), "en", "hot")]
    return out


ROWS = rows()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, *TAIL) for r in ROWS], SCHEMA).repartition(5)


def four(df):
    return sorted(repr((r["doc_id"], r["text"], r["lang"], r["source"])) for r in df.collect())


def test_quality_verdicts(docs):
    kept = brute.kept_by_rules(ROWS, quality.FEATURES, quality.FENCE, quality.SHRINK)
    want = sorted(repr((r[0], *brute.counts(r[1] or "")[:5], k)) for r, k in zip(ROWS, kept))
    got = quality.rate(docs).collect()
    assert sorted(repr((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["kept"])) for r in got) == want
    assert any(k for k in kept) and sum(not r["base_failed"] and not r["kept"] for r in got) > 5
    adaptive = brute.kept_by_rules(ROWS, quality.FEATURES, quality.FENCE, quality.SHRINK, base=False)
    assert four(quality.keep_good(docs)) == sorted(repr(r) for r, k in zip(ROWS, adaptive) if k)
    assert (5003, "few words", "en", "b") in [r for r, k in zip(ROWS, adaptive) if k] and sum(adaptive) > sum(kept)


def test_near_copies(docs):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert [x.split(", ")[0] for x in four(kept)] == [x.split(", ")[0] for x in sorted(map(repr, brute.one_of_each(ROWS)))]


def test_redaction(docs):
    spans = brute.secret_spans(ROWS)
    want = sorted(repr((d, t if t is None else brute.redacted(t, spans.get((d, t), ())), lang, s)) for d, t, lang, s in ROWS)
    assert four(secrets.redact(docs)) == want


def test_mix(docs):
    want = Counter((r[0], size, total, round(target, 6), taken, at) for r, size, total, target, taken, at in brute.mixed(ROWS))
    got = Counter((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"], r["start"]) for r in mixing.mix(docs).collect())
    assert got == want
    by_source = {}
    for r, _, _, target, taken, _ in brute.mixed(ROWS):
        by_source.setdefault(r[3], [target, 0])[1] += taken
    assert all(abs(target - taken) <= 1 for target, taken in by_source.values())


def test_mixed_documents(docs):
    assert four(mixing.mixed_documents(docs)) == sorted(map(repr, brute.mixed_rows(ROWS)))


def shard_of(doc_id, tree):
    def least(children):
        draw = lambda name, w: -math.log(((brute.hash_of(doc_id, name) >> 11) + 0.5) * 2.0**-53) / w
        live = [(draw(name, w) if len(children) > 1 else 0, i, what) for i, (name, w, what) in enumerate(children) if w > 0]
        return min(live, key=lambda x: x[:2])[2]

    region = least([(r.name, r.weight, r) for r in tree])
    rack = least([(k.name, k.weight, k) for k in region.racks])
    return least([(f"{rack.name}/{s}", w, s) for s, w in rack.shards])


def test_shards(docs):
    tree = sharding.uniform_tree(16)
    got = sharding.shard_documents(docs).collect()
    want = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode()), shard_of(r[0], tree), shard_of(r[0], sharding.with_shard(tree, 16))) for r in ROWS)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["grown_shard"]) for r in got) == want


def test_a_weight_moves_its_subtree_only(spark):
    """Twice the weight of a shard: rows move into its shard, rack or region, and none between other subtrees."""
    tree = sharding.uniform_tree(16)
    heavy = tuple(sharding.Region(r.name, tuple(sharding.Rack(k.name, tuple((s, 2.0 if s == 5 else w) for s, w in k.shards)) for k in r.racks)) for r in tree)
    ids = spark.range(40_000)
    both = sharding.descend(sharding.descend(ids, ids["id"], tree, "a"), ids["id"], heavy, "b")
    moved = {(r["a"], r["b"]): r["count"] for r in both.groupBy("a", "b").count().collect()}
    per = Counter()
    for (a, _), n in moved.items():
        per[a] += n
    assert all(abs(n - 2500) < 250 for n in per.values()) and len(per) == 16
    region, rack = (lambda s: s // 8), (lambda s: s // 4)
    for (a, b), _ in moved.items():
        if a != b:
            assert b == 5 or (rack(b) == rack(5) and rack(a) != rack(5)) or (region(b) == region(5) and region(a) != region(5))
    assert moved.get((5, 5)) == per[5]


def test_pipeline(spark, docs, tmp_path):
    """run() against the plain stages, one after the other."""
    import corpus_pipeline

    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    kept = [r for r, k in zip(ROWS, brute.kept_by_rules(ROWS, quality.FEATURES, quality.FENCE, quality.SHRINK, base=False)) if k]
    kept = brute.one_of_each(kept)
    spans = brute.secret_spans(kept)
    kept = [(d, brute.redacted(t, spans.get((d, t), ())), lang, s) for d, t, lang, s in kept]
    mixed = brute.mixed_rows(kept)
    tok, sha = Tokenizer.from_file(P.path("word_bpe_49k.json")), hashlib.sha256
    want = []
    for d, t, _, _ in mixed:
        ids = tok.encode(t, add_special_tokens=False).ids
        want.append((d, len(ids), sha(np.array(ids, "<u4").tobytes()).hexdigest(), sha(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(repr((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])) for r in got) == sorted(map(repr, want))
    assert 100 < len(want)


def test_stages_on_odd_tables(spark, tmp_path):
    """Empty tables, and tables of nulls, pass every stage."""
    import corpus_pipeline

    kind = "doc_id long, text string, lang string, source string, n_chars long"
    for k, data in enumerate(([], [(None, None, None, None, None)] * 3, [(1, "", "en", "a", 0), (1, "", "en", "a", 0)])):
        out = spark.createDataFrame(data, kind)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, out, "")
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"] and out.count() == 0
            out = spark.createDataFrame([], kind)
        for stage, n in ((corpus_pipeline.near_dedup, 1 if data else 0), (corpus_pipeline.secret_scan, len(data))):
            assert stage(spark, spark.createDataFrame(data, kind), "").count() == n


def test_targets_of_many_sources(spark):
    """Sizes over many scales fill up round by round; names by code point, the null one last."""
    sums = {f"s{i * 7919 % 1000:03d}" if i % 2 else f"é{i}": 1 + int(1.06**i) for i in range(400)} | {None: 5, "": 40}
    rows = spark.createDataFrame([(s or "", s is None, n) for s, n in sums.items()], "src string, src_null boolean, source_size long").repartition(7)
    got = {None if r["src_null"] else r["src"]: (r["source_size"], r["target"]) for r in mixing.source_targets(rows).collect()}
    want = brute.targets([(0, "w " * n if n < 1000 else None, None, s) for s, n in sums.items() if n < 1000])
    small = {s: n for s, n in sums.items() if n < 1000}
    rows = spark.createDataFrame([(s or "", s is None, n) for s, n in small.items()], "src string, src_null boolean, source_size long").repartition(7)
    few = {None if r["src_null"] else r["src"]: (r["source_size"], r["target"]) for r in mixing.source_targets(rows).collect()}
    assert {s: (n, round(t, 6)) for s, (n, t) in few.items()} == {s: (n, round(t, 6)) for s, (n, t) in want.items()}
    assert len(got) == 402 and abs(sum(t for _, t in got.values()) - sum(sums.values())) < 1e-3 * sum(sums.values())
    assert all(t <= 3 * n for n, t in got.values()) and sum(t == 3 * n for n, t in got.values()) > 200
