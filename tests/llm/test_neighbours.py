import math

import numpy as np
from pyspark.sql import functions as F

from martwright.llm import neighbours


def brute(vectors, k):
    good = {
        i: np.array(v, float)
        for i, v in vectors
        if i is not None and v and None not in v and np.isfinite(v).all() and any(v)
    }
    found = {}
    for q in (i for i in good if i % 50 == 0):
        scores = [
            (-float(good[q] @ v / math.sqrt(good[q] @ good[q]) / math.sqrt(v @ v)), i)
            for i, v in good.items()
            if i != q and len(v) == len(good[q])
        ]
        found[q] = sorted(scores)[:k]
    return found


def check(spark, vectors, k=5, block=64):
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, score string")
    rows = neighbours.nearest(df, F.col("vec_id") % 50 == 0, k, block=block).collect()
    got = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"], r["rank"]))
    want = {q: n for q, n in brute([v[:2] for v in vectors], k).items() if n}
    assert got.keys() == want.keys()
    for q, near in want.items():
        assert [r for *_, r in got[q]] == list(range(1, len(near) + 1))
        assert [i for i, *_ in got[q]] == [i for _, i in near]
        assert np.allclose([s for _, s, _ in got[q]], [-s for s, _ in near], atol=1e-12)


def floats(a):
    return [float(x) for x in np.asarray(a, np.float32)]


def test_all_queries_against_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(20, 16))
    vectors = [(i, floats(base[i % 20] + rng.normal(0, 0.05, 16)), "x") for i in range(600)]
    check(spark, vectors)


def test_copies_ties_and_few_candidates(spark):
    rng = np.random.default_rng(4)
    hot, near = floats(rng.normal(size=8)), floats(rng.normal(size=8))
    check(spark, [(i, hot if i % 3 else near, None) for i in range(300)])
    check(spark, [(0, hot, None), (50, near, None), (7, hot, None)])
    check(spark, [(0, hot, None)])


def test_vectors_without_a_direction(spark):
    vectors = [
        (0, [1.0, 2.0], "a"), (1, [1.0, 2.1], None), (2, None, None), (3, [0.0, 0.0], None),
        (4, [None, 1.0], None), (5, [float("nan"), 1.0], None), (6, [float("inf"), 1.0], None),
        (None, [1.0, 2.0], None), (50, [], None), (100, [1.0, 2.0, 3.0], None), (7, [-1.0, 0.0], None),
        (8, [1e-30, 2e-30], None), (9, [1e30, 2e30], None), (1, [1.0, 2.1], None),
    ]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label string")
    rows = neighbours.nearest(df, F.col("vec_id") % 50 == 0).orderBy("rank").collect()
    assert {r["query_id"] for r in rows} == {0} and len(rows) == 4
    assert sorted(r["vec_id"] for r in rows[:2]) == [8, 9] and rows[3]["vec_id"] == 7
    empty = neighbours.nearest(df.limit(0), F.col("vec_id") % 50 == 0)
    assert empty.count() == 0


def test_bounds_hold(spark):
    rng = np.random.default_rng(9)
    a = rng.normal(size=(50, 32))
    unit = a / np.linalg.norm(a, axis=1)[:, None]
    whole, scale, lost = neighbours.quantise(unit)
    about = (whole @ whole.T) * scale[:, None] * scale
    error = lost[:, None] * (1 + lost) + lost + neighbours.FUZZ
    assert (np.abs(about - unit @ unit.T) <= error).all() and error.max() < 0.05


def test_a_repeated_id_is_its_least_vector(spark):
    rng = np.random.default_rng(6)
    vectors = [(i, floats(rng.normal(size=6)), None) for i in range(120)]
    more = [(i, floats(rng.normal(size=6)), None) for i in (0, 0, 1, 50, 77)] + vectors[:3]
    least = {}
    for i, v, _ in vectors + more:
        least[i] = min(v, least.get(i, v))
    schema = "vec_id long, embedding array<float>, score string"
    both = [
        spark.createDataFrame(rows, schema)
        for rows in (vectors + more, [(i, v, None) for i, v in least.items()])
    ]
    got, want = (
        sorted(map(tuple, neighbours.nearest(df, F.col("vec_id") % 50 == 0, block=32).collect())) for df in both
    )
    assert got == want and len(got) == 15


def test_numbers_of_a_byte_travel(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0, float(i)]) for i in range(9)], "id long, vector array<float>")
    coded = neighbours.quantised(df)
    assert dict(coded.dtypes) == {"id": "bigint", "whole": "binary", "scale": "double", "lost": "double"}
    assert {len(r["whole"]) for r in coded.collect()} == {3}
