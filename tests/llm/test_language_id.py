from odd_rows import no_docs, odd_docs  # noqa: F401

import itertools

import numpy as np
from pyspark.sql import functions as F

from martwright.llm import language_id as lid
from martwright.llm.common import bucket_of, table

DATA = "/root/testdata/sf0.001"


def best_path(scores, penalty):
    best = None
    for path in itertools.product(range(scores.shape[1]), repeat=len(scores)):
        value = sum(scores[i, p] for i, p in enumerate(path))
        value -= penalty * sum(a != b for a, b in zip(path, path[1:], strict=False))
        best = max(best or -1e9, value)
    return best


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(3)
    sizes = np.array([0, 4, 1, 6, 3])
    scores = rng.normal(0, 2, (sizes.sum(), 3)).astype(np.float32)
    path = lid.viterbi(scores, sizes, 1.5)
    at = 0
    for n in sizes:
        own, s = path[at : at + n], scores[at : at + n]
        value = s[np.arange(n), own].sum() - 1.5 * (np.diff(own) != 0).sum()
        assert n == 0 or abs(value - best_path(s, 1.5)) < 1e-3
        at += n


def test_held_out_accuracy_and_spans(spark):
    docs = table(spark, DATA, "documents")
    model = lid.train(docs, bucket_of("doc_id", 4) != 2)
    rows = lid.identify(docs, model).collect()
    held = [r for r in rows if r["lang"] is not None]
    assert sum(r["lang_pred"] == r["lang"] for r in held) / len(held) > 0.98
    for r in rows:
        assert 0 <= r["score"] <= 1
        assert all(0 <= s["start"] < s["stop"] <= len(r["text"]) for s in r["spans"])
    french = next(r["text"] for r in rows if r["lang"] == "fr" and len(r["text"]) > 300)[:300]
    german = next(r["text"] for r in rows if r["lang"] == "de" and len(r["text"]) > 600)[:600]
    mixed = spark.createDataFrame([(french + " " + german,)], "text string")
    row = lid.identify(mixed, model).first()
    assert [s["lang"] for s in row["spans"]] == ["fr", "de"] and row["lang_pred"] == "de"
    assert abs(row["spans"][0]["stop"] - 300) < 30


def test_scripts_narrow_the_candidates(spark):
    rows = [(i, "привет мир как дела", "ru") for i in range(5)]
    rows += [(10 + i, "hello world how are you", "en") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lid.train(docs, F.lit(True))
    asked = spark.createDataFrame([("щука",), ("zzz qqq",), ("漢字",)], "text string")
    assert [r["lang_pred"] for r in lid.identify(asked, model).collect()][:2] == ["ru", "en"]
    unknown = lid.identify(asked, model).collect()[2]
    assert unknown["lang_pred"] in ("ru", "en") and unknown["score"] < 0.01


def test_odd_rows(spark, odd_docs, no_docs):
    model = lid.train(odd_docs, F.lit(True))
    assert model.languages == ["en"]  # the German row has no key
    out = {r["doc_id"]: r for r in lid.identify(odd_docs, model).collect()}
    assert all(out[i]["lang_pred"] == "und" and out[i]["score"] == 0 for i in (2, 3, 4, 6))
    assert out[5]["lang_pred"] == "en" and lid.identify(odd_docs, model).count() == 8
    assert lid.identify(no_docs, model).count() == 0
    nothing = lid.train(no_docs, F.lit(True))
    assert {r["lang_pred"] for r in lid.identify(odd_docs, nothing).collect()} == {"und"}
