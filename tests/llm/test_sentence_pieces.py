from odd_rows import no_docs, odd_docs  # noqa: F401

import numpy as np
import pytest

from martwright.llm import sentence_pieces as sp
from martwright.llm.piece_model import SPACE, START, Encoder, PieceModel, between, compose
from martwright.llm.queries import piece_model

sentencepiece = pytest.importorskip("sentencepiece")

TEXTS = [
    "", " ", "a", "Hello world", "  two  spaces  ", "line\n\nbreaks \n here\t.", "日本語 テキスト 混ぜる",
    "😀 emoji ✌🏽", "aaaaaaaaaaaaaaaaaaaaaaaaa", "the" * 200, "x" * 700, "def f(x):\n    return x**2",
    " " * 40 + "end", "naïve café", "<s> [INST] </s> <unk> <0x0A>", "\u0000\u0001",
]


@pytest.fixture(scope="module")
def content():
    return piece_model()


@pytest.fixture(scope="module")
def library(content):
    return sentencepiece.SentencePieceProcessor(model_proto=content)


def test_ids_and_text_are_those_of_the_library(content, library):
    encoder = Encoder(PieceModel(content))
    for text in TEXTS:
        ids = encoder.encode(text)
        assert ids == library.encode(text), text
        assert encoder.decode(ids) == text == library.decode(ids)
    sizes, ids = encoder.encode_all(TEXTS)
    assert [library.encode(t) for t in TEXTS] == [
        part.tolist() for part in np.split(ids, np.cumsum(sizes)[:-1])
    ]


@pytest.mark.parametrize("chunk", [17, 50, 301])
def test_any_cuts_give_the_same_ids(content, library, chunk):
    encoder = Encoder(PieceModel(content))
    margin = encoder.model.longest
    for text in [t for t in TEXTS if t]:
        whole = (" " + text).replace(" ", SPACE)
        cuts = [*range(0, max(1, len(whole) - chunk + 1), chunk), len(whole)]
        views = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            low = max(0, a - margin)
            views.append((whole[low : b + margin], a - low, b - low))
        parts = [encoder.matrix(*v) for v in views]
        states = between(parts, START, START)
        ids = [
            i
            for v, came, goes in zip(views, states, states[1:], strict=False)
            for i in encoder.chunk_ids(*v, came, goes)
        ]
        assert ids == library.encode(text)
        left = right = None
        for p in parts:
            left = p if left is None else compose(left, p)
        for p in reversed(parts):
            right = p if right is None else compose(p, right)
        assert left == right  # associative, and one path has finite weight
        assert left[2] == [[0.0]]


def test_unigram_weights_give_the_best_path(content):
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(content)
    proto.trainer_spec.model_type = 1
    encoder = Encoder(PieceModel(proto.SerializeToString()))
    text = SPACE + "understanding" + SPACE + "things"

    def best(s):
        value = [0.0] + [float("-inf")] * len(s)
        for i in range(len(s)):
            for t in encoder.starting(s, i):
                step = encoder.model.scores.get(t, encoder.model.worst)
                value[i + len(t)] = max(value[i + len(t)], value[i] + step)
        return value[-1]

    whole = encoder.matrix(text, 0, len(text))
    assert whole[2] == [[best(text)]]
    cut = [encoder.matrix(text[: 9 + 16], 0, 9), encoder.matrix(text, 9, len(text))]
    assert compose(*cut)[2] == [[best(text)]]


def test_giant_documents_through_spark(spark, content, library, monkeypatch):
    monkeypatch.setattr(sp, "FAN", 3)
    texts = [" ".join(TEXTS) * 3, "y" * 900, "short one", None, "word " * 400, " ".join(TEXTS)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sp.encode(docs, content, chunk=100).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r["ids"] == library.encode(texts[r["doc_id"]] or "")


def test_odd_rows(odd_docs, no_docs, content, library):
    docs = odd_docs.withColumnRenamed("score", "ids").withColumnRenamed("fp", "decoded")
    out = sp.decode(sp.encode(docs, content, chunk=20_000), content).collect()
    assert len(out) == 8
    for r in out:
        assert r["ids"] == library.encode(r["text"] or "") and r["decoded"] == (r["text"] or "")
    assert sp.decode(sp.encode(no_docs, content), content).count() == 0
