"""The queries without SQL, on whole small tables, against plain versions of their contract."""

import re
import zlib

import numpy as np
import pytest
import sentencepiece
from test_simhash import brute_components, brute_fingerprint

from martwright.llm.common import table
from martwright.llm.queries import QUERIES, piece_model

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, DATA, "documents").select("doc_id", "text", "lang").collect()


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def run(spark, name):
    rows = QUERIES[name](spark, DATA).collect()
    return {r["doc_id"]: r for r in rows}, len(rows)


def test_language(spark, docs):
    got, count = run(spark, "op2_language_id")
    assert count == len(docs) == len(got)
    learned = {d["lang"] for d in docs if crc(d["doc_id"]) % 4 != 2}
    right = []
    for d in docs:
        r = got[d["doc_id"]]
        assert r["held_out"] == (crc(d["doc_id"]) % 4 == 2) and 0 <= r["score"] <= 1
        assert r["lang_pred"] in (learned if re.search(r"[^\W\d_]", d["text"]) else {"und"})
        if r["held_out"]:
            right.append(r["lang_pred"] == d["lang"])
    assert sum(right) / len(right) > 0.97


def test_quality(spark, docs):
    got, count = run(spark, "op10_quality")
    assert count == len(docs) == len(got)
    marks = {r["doc_id"]: r["quality"] for r in table(spark, DATA, "labels").collect()}
    right = []
    for d in docs:
        r = got[d["doc_id"]]
        assert r["held_out"] == (crc(d["doc_id"]) % 5 == 0)
        assert r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1
        if r["held_out"] and d["doc_id"] in marks:
            right.append(r["predicted"] == marks[d["doc_id"]])
    assert sum(right) / len(right) > 0.9


def test_simhash(spark, docs):
    got, count = run(spark, "op9_simhash")
    codes = [brute_fingerprint(d["text"], 3) for d in docs]
    root = brute_components(codes, 2)
    first = {}
    for d, c in zip(docs, root, strict=True):
        first[c] = min(first.get(c, d["doc_id"]), d["doc_id"])
    assert count == len(docs)
    for d, f, c in zip(docs, codes, root, strict=True):
        r = got[d["doc_id"]]
        assert (r["fingerprint"], r["component_id"]) == (f"{f:016x}", first[c])


def test_decontamination(spark, docs):
    """Every alignment of every item with every document, without seeds."""
    found = QUERIES["op8_decontaminate"](spark, DATA).collect()
    items = table(spark, DATA, "benchmark").collect()
    number = {}

    def words(text):
        return np.array([number.setdefault(w, len(number)) for w in re.findall(r"[^\W_]+", text.lower())])

    benchmark = {i["item_id"]: words(i["text"]) for i in items}
    want = {}
    for d in docs:
        own = words(d["text"])
        for item, w in benchmark.items():
            wide = min(20, len(w))
            if len(w) < 8 or len(np.intersect1d(own, w)) < 0.8 * min(wide, len(set(w.tolist()))):
                continue
            padded = np.concatenate([np.full(len(w), -1), own, np.full(len(w), -1)])
            same = np.lib.stride_tricks.sliding_window_view(padded, len(w)) == w
            sums = np.cumsum(np.pad(same, ((0, 0), (1, 0))), axis=1)
            best = int((sums[:, wide:] - sums[:, :-wide]).max())
            if best >= 0.8 * wide:
                want[d["doc_id"], item] = best
    assert {(r["doc_id"], r["item_id"]): r["matched_words"] for r in found} == want and want


def test_pieces(spark, docs):
    got, count = run(spark, "op4_sentence_pieces")
    library = sentencepiece.SentencePieceProcessor(model_proto=piece_model())
    assert count == len(docs)
    for d in docs:
        r = got[d["doc_id"]]
        assert r["ids"] == library.encode(d["text"]) and r["n_pieces"] == len(r["ids"])
        assert r["round_trip"]


def test_scores(spark, docs):
    got, count = run(spark, "op3_lm_scoring")
    assert count == len(docs)
    for d in docs:
        r = got[d["doc_id"]]
        assert r["n_tokens"] == len(d["text"].split()) and r["log_prob"] < 0
        assert abs(r["mean_log_prob"] * r["n_tokens"] - r["log_prob"]) < 1e-6 * -r["log_prob"]
