"""Every language is learned, whatever their number, and hot rows push none out."""

import zlib

import numpy as np

from alluvium.llm import langid


def test_more_languages_than_64(spark):
    rows = [(100 * k + i, f"text {i} of {k}", f"l{k:02d}") for k in range(70) for i in range(8)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(model.langs) == 70


def test_one_doc_id_does_not_fill_the_sample(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(langid, "fit", lambda x, labels: seen.update(x=x, labels=labels))
    rows = [(None, f"hot text {i}", "en") for i in range(400)] + [(7, "same row", "en")] * 400
    rows += [(1000 + i, f"andere Zeile {i}", "de") for i in range(100)]
    langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample=50)
    assert 20 <= seen["labels"].count("en") <= 50 and seen["labels"].count("de") == 50
    same = langid._sparse("same row")[0].tolist()
    assert sum(x[0].tolist() == same for x in seen["x"]) <= 1


def test_many_languages_with_long_texts_stay_small(spark, monkeypatch):
    """What reaches the driver is bounded by documents, not by their length."""
    seen = {}
    monkeypatch.setattr(langid, "fit", lambda x, labels: seen.update(x=x, labels=labels))
    rng = np.random.default_rng(0)
    vocab = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyzäöüß"), 8)) for _ in range(3000)]
    rows = [(k * 100 + i, " ".join(rng.choice(vocab, 8000)), f"l{k}") for k in range(64) for i in range(3)]
    langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(set(seen["labels"])) == 64
    assert max(x[0].nbytes + x[1].nbytes for x in seen["x"]) <= 6 * langid.BUCKETS


def test_prediction_by_hand(spark):
    """identify() against the model applied text by text."""
    rows = [(i, ("the cat sits here " if i % 2 else "der Hund liegt dort ") * (1 + i % 7) + f"{i}", "en" if i % 2 else "de", "c") for i in range(80)]
    rows += [(200, None, "en", "c"), (201, "", "de", "c"), (202, "1234", None, "c"), (None, "the cat", "en", "c"), (203, "und so weiter " * 30_000, "de", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    model = langid.train(docs)
    want = []
    for d, t, *_ in rows:
        known = t is not None and any(c.isalpha() for c in t)
        p = model.probabilities(langid.bucket_counts(t)[None])[0] if known else None
        held = d is not None and zlib.crc32(str(d).encode()) % 4 == 2
        want.append((d, held, model.langs[int(p.argmax())] if known else "und", round(float(p.max()), 9) if known else 0.0))
    got = [(r["doc_id"], r["held_out"], r["lang_pred"], round(r["score"], 9)) for r in langid.identify(docs).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
