"""The verdict on a secret by owners and repositories; spans and redaction by brute force."""

import re
import time

import numpy as np
import pytest

from pyspark.sql import functions as F

from alluvium.llm import secrets

HEX, TOKEN, EXAMPLE, WIDE = "deadbeefdeadbeef01", "Zq7Rt2Lm9Xc4Vb8Np1Ks6Wd3Yf", "Ab1Cd2Ef3Gh4Ij5Kl6Mn7Op8Qr", "Wa1Wb2Wc3Wd4We5Wf6Wg7Wh8"


def test_owners_and_repositories(spark):
    rows = [(i, f"one text with {HEX} and {TOKEN} in it", f"s{i}") for i in range(5)]  # one repository, five owners
    rows += [(100 + i, f"text {i} of the hot source shows {EXAMPLE} again", "hot") for i in range(101)]  # one owner
    rows += [(500 + i, f"text {i} shows {WIDE} too", f"s{i}") for i in range(3)]  # many owners in many repositories
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = {r["doc_id"]: r for r in secrets.scan(docs).collect()}
    assert len(got) == len(rows)
    for i in range(5):
        r = got[i]
        assert r["n_hex"] == 1 and r["spans"].count("live:") == 1
        assert (r["n_live"], r["n_copied"], r["n_owners"], r["n_repos"]) == (2, 0, "5,5", "1,1")
    assert all(got[100 + i]["spans"].startswith("live:") for i in range(101))
    assert all(got[500 + i]["spans"] == "" for i in range(3))
    red = {r["doc_id"]: r["text"] for r in secrets.redact(docs).collect()}
    assert all(red[i] == "one text with <SECRET> and <SECRET> in it" for i in range(5))
    assert EXAMPLE not in red[100] and WIDE in red[500]


@pytest.mark.parametrize("texts", [99, 101, 5000])
def test_one_owner_s_key_stays_live_in_any_number_of_texts(spark, texts):
    """Alone, and of two owners; with a third the same value is an example at either number of texts."""
    rows = [(i, f"text {i} uses {TOKEN} here", "one") for i in range(texts)] + [(100_000 + i, f"text {i} uses {EXAMPLE} here", f"o{i % 2}") for i in range(texts)]
    rows += [(200_000 + i, f"text {i} uses {WIDE} here", f"o{i % 3}") for i in range(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    found = secrets.scan(docs).where("n_live > 0").selectExpr("doc_id div 100000 AS k").groupBy("k").count().collect()
    assert sorted(tuple(r) for r in found) == [(0, texts), (1, texts)]
    red = secrets.redact(docs).where("text LIKE '%<SECRET>%'").selectExpr("doc_id div 100000 AS k").groupBy("k").count().collect()
    assert sorted(tuple(r) for r in red) == [(0, texts), (1, texts)]


def test_bounds_are_parameters(spark):
    for owners, repos in ((3, 9), (2, 3)):
        rows = [(i, f"text {i % repos} shows {WIDE}", f"s{i % owners}") for i in range(9)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
        live = lambda **bound: secrets.scan(docs, **bound).where("n_live > 0").count()  # noqa: E731, B023
        assert live(max_owners=owners, max_repos=repos - 1) == live(max_owners=owners - 1, max_repos=repos) == 9
        assert live(max_owners=owners - 1, max_repos=repos - 1) == 0


def test_very_long_texts_take_time_in_proportion(spark):
    """20 MB with 100,000 spans, scanned and redacted; a tenth of it for comparison."""
    keys = [f"{i:016x} Zq{i:06d}Rt2Lm9Xc4Vb8Np1Ks6Wd3Yf" + " é" * 75 for i in range(50_000)]
    took = []
    for n in (5_000, 50_000):
        text = "\n".join(keys[:n])
        docs = spark.createDataFrame([(1, text, "s", 0)], "doc_id long, text string, source string, n_chars long")
        began = time.time()
        r = secrets.scan(docs).first()
        assert (r["n_hex"], r["n_live"], r["spans"].count(",") + 1) == (n, 2 * n, 2 * n)
        red = secrets.redact(docs).first()
        want = "\n".join("<SECRET> <SECRET>" + " é" * 75 for _ in range(n))
        assert red["text"] == want and red["n_chars"] == len(want)
        took.append(time.time() - began)
    assert took[1] < 40 * took[0]


def test_repositories_from_a_column(spark):
    rows = [(i, f"text {i} shows {WIDE} too", f"s{i}", "fork" if i < 4 else None) for i in range(5)]
    got = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string, source string, repo string"), repo_col="repo").collect()
    assert all(r["n_repos"] == "2" and r["n_owners"] == "5" and r["n_live"] == 1 for r in got)
    same = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string, source string, repo string"), repo_col="source").collect()
    assert all(r["spans"] == "" for r in same)


ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
KINDS = (("assign", ASSIGN, 2, 12), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18), ("hex", re.compile("[0-9a-f]+"), 0, 16), ("live", re.compile("(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]+"), 0, 24))


def brute(rows):
    """(doc_id, text) -> spans (start, kind, end, secret's start, live) that stay."""
    found, owners, repos = {}, {}, {}
    for d, t, s in rows:
        t = t or ""
        for k, (_, pattern, group, least) in enumerate(KINDS):
            for m in pattern.finditer(t):
                v = m[group]
                if len(v) < least or k == 3 and not (re.search("[A-Z]", v) and re.search("[a-z]", v) and re.search("[0-9]", v)):
                    continue
                found.setdefault((d, t), set()).add((m.start(), k, m.end(), v))
                owners.setdefault(v, set()).add(s)
                repos.setdefault(v, set()).add(t)
    out = {}
    for key, spans in found.items():
        rated = [(a, k, b, b - len(v), not (len(owners[v]) > 2 and len(repos[v]) > 2)) for a, k, b, v in sorted(spans)]
        base = [x for x in rated if x[1] < 3]
        out[key] = [x for x in rated if x[1] < 3 or x[4] and not any(b[0] < x[2] and x[0] < b[2] for b in base)]
    return out


def many_rows():
    rng = np.random.default_rng(6)
    pool = ["".join(rng.choice(list("ABCDEFabcdef0123456789xyzXYZ"), 30)) for _ in range(12)]
    marks = [lambda v: f"password = {v}", lambda v: f'API_key:"{v}"', lambda v: v, lambda v: f"AKIA{v.upper()}", lambda v: v.lower().replace("x", "0"), lambda v: f"token= {v[:9]}"]
    rows = []
    for i in range(160):
        words = [f"ü{i}"] + [marks[rng.integers(len(marks))](pool[int(rng.integers(12)) if rng.random() < 0.6 else 0]) for _ in range(int(rng.integers(0, 4)))]
        rows.append((i, " 中 ".join(words), f"s{rng.integers(4)}" if i % 9 else None))
    return [*rows, rows[3], rows[3], (3, rows[5][1], "s1"), (None, rows[7][1], "s9"), (500, None, "s1"), (501, "", None)]


@pytest.mark.parametrize("few", [0, 10**6])
def test_spans_and_redaction(spark, monkeypatch, few):
    monkeypatch.setattr(secrets, "FEW", few)
    rows = many_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("n_chars", F.lit(-1)).repartition(4)
    found = brute(rows)
    names = [k[0] for k in KINDS]
    want = sorted(repr((d, ",".join(f"{names[k]}:{a}:{b}" for a, k, b, *_ in found.get((d, t or ""), ())))) for d, t, _ in rows)
    scanned = secrets.scan(docs).collect()
    assert sorted(repr((r["doc_id"], r["spans"])) for r in scanned) == want
    live = sorted(repr((d, sum(x[4] for x in found.get((d, t or ""), ())))) for d, t, _ in rows)
    assert sorted(repr((r["doc_id"], r["n_live"])) for r in scanned) == live
    assert any("live" in r["spans"] for r in scanned) and any(r["n_copied"] for r in scanned)

    def redacted(d, t):
        spans, out, at = sorted((x[3], x[2]) for x in found.get((d, t or ""), ())), "", 0
        if not spans:
            return d, t, -1
        for a, b in spans:
            if b <= at:
                continue
            out += t[at:a] + "<SECRET>" if a >= at else ""
            at = b
        return d, out + t[at:], len(out + t[at:])

    got = [(r["doc_id"], r["text"], r["n_chars"]) for r in secrets.redact(docs).collect()]
    assert sorted(map(repr, got)) == sorted(repr(redacted(d, t)) for d, t, _ in rows)


def test_redact_on_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string, owner string, repo string")
    assert secrets.redact(docs).columns == docs.columns and secrets.redact(docs).count() == 0
