from odd_rows import no_docs, odd_docs  # noqa: F401

import hashlib
import random
import struct

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martwright.llm import word_bpe
from martwright.llm.common import table
from martwright.llm.queries import QUERIES, word_vocabulary

tokenizers = pytest.importorskip("tokenizers")
DATA = "/root/testdata/sf0.001"

TEXTS = [
    "", " ", "\n\t\x0b", "a", "Hello   World's it's I'd they'll", "'S 't're'x", "ΑΣ ΟΔΟΣ. Σ σς",
    "<|endoftext|>a b<|startoftext|><|endoftext|>", "<|ENDOFTEXT|> <|end", "\0<|endoftext|>\0 \0a",
    "\x1c x\x85y​z\xa0w ", "İstanbul ﬁ Å Å é ẞ ǅ", "12345 ½ ²Ⅷ ٣٤", "_-_'sdon't ...!?",
    "힤 각 日本語テキスト", "😀✌🏽 👩‍👩‍👧", "՘ Ᲊ Ɤ₏ \U00010d50", "a" * 500 + "é" * 300,
    "x" * 64 + " " + "x" * 65 + " " + "ab" * 32 + " " + "日" * 21 + "b", "\U000e0041\U0010ffff",
]


@pytest.fixture(scope="module")
def content():
    return word_vocabulary()


@pytest.fixture(scope="module")
def library(content):
    return tokenizers.Tokenizer.from_str(content)


@pytest.fixture(scope="module")
def model(content):
    return word_bpe.WordBpe(content)


def ids_of(model, texts):
    sizes, ids = model.encode_all(texts)
    return [part.tolist() for part in np.split(ids, np.cumsum(sizes)[:-1])]


def check(model, library, texts):
    for text, got in zip(texts, ids_of(model, texts), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert got == want, ascii(text)
        assert model.decode(got) == library.decode(want, skip_special_tokens=False)


def test_ids_and_text_are_those_of_the_library(model, library):
    check(model, library, TEXTS)
    assert model.encode_all([])[1].size == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=80), min_size=1, max_size=5))
def test_any_text(model, library, texts):
    check(model, library, texts)


def test_every_assigned_and_unassigned_character(model, library):
    points = [c for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    random.Random(5).shuffle(points)
    check(model, library, ["".join(map(chr, points[i : i + 40])) for i in range(0, len(points), 40)])


@pytest.mark.parametrize("letters", ["ab", "the", "éa", "x"])
def test_long_words_take_the_same_merges(model, library, letters):
    rng = random.Random(letters)
    words = ["".join(rng.choices(letters, k=n)) for n in (62, 63, 64, 65, 66, 130, 5000)]
    check(model, library, words)
    short = [w.encode() for w in words[:3] if len(w.encode()) <= word_bpe.LONGEST]
    sizes, ids = model._merge(short)
    assert ids.tolist() == [i for w in short for i in model._merge_long(w)]


def test_forgetting_words_changes_nothing(content, library, monkeypatch):
    monkeypatch.setattr(word_bpe, "CACHED", 3)
    model = word_bpe.WordBpe(content)
    for text in TEXTS * 2:
        check(model, library, [text])


def test_odd_rows(spark, odd_docs, no_docs, content, library):
    plain = word_bpe.encode(odd_docs, content)
    packed = word_bpe.encode(odd_docs.withColumn("ids", F.lit("x")), content, packed=True)
    assert set(odd_docs.columns) < set(plain.columns)
    again = word_bpe.decode(packed.withColumnRenamed("decoded", "beside"), content)
    want = sorted(
        (r["doc_id"] or -1, tuple(library.encode(r["text"] or "", add_special_tokens=False).ids))
        for r in odd_docs.collect()
    )
    assert sorted((r["doc_id"] or -1, tuple(r["ids"])) for r in plain.collect()) == want
    rows = again.collect()
    assert all(r["beside"] == r["decoded"] for r in rows)
    got = [(r["doc_id"] or -1, struct.unpack(f"<{len(r['ids']) // 4}I", r["ids"])) for r in rows]
    assert sorted(got) == want
    assert word_bpe.encode(no_docs, content).collect() == []
    nothing = spark.createDataFrame([(None,)], "ids array<int>")
    assert [r["decoded"] for r in word_bpe.decode(nothing, content).collect()] == [""]


def test_query_on_the_whole_table(spark, library):
    got = QUERIES["op13_word_bpe"](spark, DATA).collect()
    docs = table(spark, DATA, "documents").select("doc_id", "text").collect()
    want = []
    for d in docs:
        ids = library.encode(d["text"] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        digest = hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        want.append((d["doc_id"], len(ids), digest, hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(tuple, got)) == sorted(want)
