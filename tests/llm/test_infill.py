from odd_rows import no_docs, odd_docs  # noqa: F401

import hashlib
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from martwright.llm import infill
from martwright.llm.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"
TOKENS = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")
OUTPUTS = ["n", "form", "prefix_chars", "middle_chars", "output"]


def plain_version(key, text):
    """The contract, with the tokens as a list."""
    text = text or ""
    tokens = TOKENS.findall(text)
    assert "".join(tokens) == text
    digest = hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(tokens)
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted(x % (n + 1) for x in h[:2])
    p, m, s = ("".join(t) for t in (tokens[:a], tokens[a:b], tokens[b:]))
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize(
    "places, kinds",
    [
        (np.arange(0, 70_000, 3), ["bitmap", "array"]),
        (np.arange(5, 300_000), ["runs"] * 5),
        (np.array([7]), ["array"]),
        (np.array([0, 65_535, 65_536, 1 << 31]), ["array"] * 3),
        (np.concatenate([np.arange(100), np.arange(200, 65_536, 2), [200_000]]), ["bitmap", "array"]),
        (np.zeros(0, np.int64), []),
    ],
)
def test_select_is_that_of_a_list(places, kinds):
    found = infill.BoundarySet(places)
    assert [kind for kind, _ in found.containers] == kinds and len(found) == len(places)
    for nth in {0, 1, 63, 64, 4095, 4096, len(places) // 2, len(places) - 1}:
        if 0 <= nth < len(places):
            assert found.select(nth) == places[nth]


def test_every_member_of_random_sets():
    rng = np.random.default_rng(3)
    for density in (0.001, 0.05, 0.3, 0.7, 0.999):
        places = np.flatnonzero(rng.random(150_000) < density)
        found = infill.BoundarySet(places)
        assert [found.select(i) for i in range(0, len(places), 7)] == places[::7].tolist()


def check(df, key="doc_id"):
    back = infill.transform(df, key).withColumn("restored", infill.restored())
    want = sorted(map(str, ((r[key], *plain_version(r[key], r["text"]), r["text"] or "") for r in df.collect())))
    assert sorted(map(str, map(tuple, back.select(key, *OUTPUTS, "restored").collect()))) == want


def test_odd_rows(spark, odd_docs, no_docs):
    check(odd_docs)
    assert infill.transform(no_docs).collect() == []
    assert set(odd_docs.columns) < set(infill.transform(odd_docs).columns)
    clash = odd_docs.withColumn("form", F.lit("x")).withColumn("output", F.lit(3))
    check(clash)


def test_markers_and_cuts(spark):
    texts = ["a <P> b", "<S>", "x<M>y z", "< P> <P", "<<P", "a <S b <", "日本 語 <", "\x0b\x0c a\x1cb\xa0c \n", "<"]
    rows = [(i, t) for i, t in enumerate(texts * 40)]
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_long_texts(spark):
    rows = [(i, ("ab " * 60_000 + "é" * 70_000) if i % 2 else "w\t" * 90_000) for i in range(24)]
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_query_is_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    want = con.execute(ORACLE_SQL["op11_fill_in_middle"])
    names = [d[0] for d in want.description]
    got = QUERIES["op11_fill_in_middle"](spark, DATA)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(names).collect())) == sorted(want.fetchall())
