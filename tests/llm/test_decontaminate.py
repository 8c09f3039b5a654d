from odd_rows import no_docs, odd_docs  # noqa: F401

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from martwright.llm import decontaminate as dec

RNG = random.Random(5)
VOCABULARY = [f"w{i}" for i in range(400)]


def words(n):
    return [RNG.choice(VOCABULARY) for _ in range(n)]


def planted(item, change=0, cut=None):
    own = list(item[: cut or len(item)])
    for i in RNG.sample(range(len(own)), change):
        own[i] = "changed"
    return words(60) + own + words(60)


def brute(doc, item, window, share):
    wide = min(window, len(item))
    for start in range(-len(item) + 1, len(doc)):
        same = [0 <= start + k < len(doc) and doc[start + k] == w for k, w in enumerate(item)]
        if max(sum(same[i : i + wide]) for i in range(len(item) - wide + 1)) >= share * wide:
            return True
    return False


def test_against_brute_force(spark):
    items = [words(n) for n in (9, 15, 30, 59, 700)]
    docs = [words(200) for _ in range(10)]
    docs += [planted(i) for i in items]
    docs += [planted(i, len(i) // 10) for i in items[1:]]
    docs += [planted(i, cut=8) for i in items[2:]]  # a short phrase alone is no leak
    docs += [planted(items[3], cut=30), items[1][:], [w.upper() for w in items[2]]]
    frame = spark.createDataFrame(
        [(n, " ".join(d) if n % 2 else ",\n".join(d)) for n, d in enumerate(docs)],
        "doc_id long, text string",
    )
    bench = spark.createDataFrame(
        [(n, " ".join(i)) for n, i in enumerate(items)], "item_id long, text string"
    )
    want = {
        (n, m)
        for n, d in enumerate(docs)
        for m, i in enumerate(items)
        if brute([w.lower() for w in d], i, 20, 0.8)
    }
    for block_words in (200_000, 300):
        found = dec.overlaps(frame, bench, block_words=block_words)
        assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == want
    assert len(want) >= 11
    kept = {r["doc_id"] for r in dec.clean(frame, bench).collect()}
    assert kept == set(range(len(docs))) - {n for n, _ in want}


def test_place_and_count(spark):
    item = words(25)
    docs = spark.createDataFrame([(7, " ".join(["x"] * 5 + item))], "doc_id long, text string")
    bench = spark.createDataFrame([(3, " ".join(item))], "item_id long, text string")
    assert [tuple(r) for r in dec.overlaps(docs, bench).collect()] == [(7, 3, 20, 20, 5)]


@pytest.mark.parametrize("length", range(1, 21))
def test_masks_meet_every_accepted_pattern(length):
    """Every way to change as many words as the check forgives leaves a whole mask."""
    masks = dec.masks_for(length, 0.8)
    placed = [{i + o for o in m} for m in masks for i in range(length - m[-1])]
    changed = length - math.ceil(length * 0.8)
    for pattern in itertools.combinations(range(length), changed):
        assert any(p.isdisjoint(pattern) for p in placed), (masks, pattern)


def test_masks_leave_places_out():
    """No item from 8 words on needs a run of words."""
    for lengths in (range(8, 21), range(15, 21), [20]):
        used = dec.choose_masks(list(lengths), 0.8)
        assert len(used) <= dec.FEW and all(m[-1] >= len(m) >= 5 for m in used)
        assert {n for own in used.values() for n in own} == set(lengths)


def test_short_items_do_not_make_documents_go(spark):
    docs = spark.createDataFrame([(1, "some of the words"), (2, " ".join(VOCABULARY[:30]))], "doc_id long, text string")
    bench = spark.createDataFrame(
        [(1, "the"), (2, "of the"), (3, " ".join(VOCABULARY[5:25]))], "item_id long, text string"
    )
    found = {(r["doc_id"], r["item_id"]) for r in dec.overlaps(docs, bench).collect()}
    assert found == {(1, 1), (1, 2), (2, 3)}
    assert [r["doc_id"] for r in dec.clean(docs, bench).collect()] == [1]
    assert dec.clean(docs, bench, least=1).count() == 0


def test_large_benchmarks_read_the_documents_once(spark, odd_docs):
    bench = spark.createDataFrame([(n, " ".join(words(30))) for n in range(40)], "item_id long, text string")
    plans = []
    written = dec.common.written
    dec.common.written = lambda df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or written(df, name)
    try:
        few = dec.overlaps(odd_docs, bench, block_words=100).collect()
    finally:
        dec.common.written = written
    assert len(plans) == 1 and plans[0].count("posexplode") == 2 and "strategy=broadcast" not in plans[0]
    assert few == dec.overlaps(odd_docs, bench).collect()


def test_short_items_odd_places_and_all_changes(spark):
    """Items of 1 to 21 words, at even and odd places, with as many changes as are accepted."""
    items = [[f"i{n}x{k}" for k in range(n)] for n in range(1, 22)]
    docs = []
    for item in items:
        wide = min(20, len(item))
        for change in (0, wide - math.ceil(0.8 * wide), wide - math.ceil(0.8 * wide) + 1):
            for lead in (0, 1, 2, 3):
                own = list(item)
                for i in RNG.sample(range(wide), change):
                    own[i] = "changed"
                docs.append(words(lead) + own + words(5))
    frame = spark.createDataFrame(
        [(n, " ".join(d)) for n, d in enumerate(docs)], "doc_id long, text string"
    )
    bench = spark.createDataFrame(
        [(n, " ".join(i)) for n, i in enumerate(items)], "item_id long, text string"
    )
    want = {
        (n, m)
        for n, d in enumerate(docs)
        for m, i in enumerate(items)
        if brute(d, i, 20, 0.8)
    }
    found = {(r["doc_id"], r["item_id"]) for r in dec.overlaps(frame, bench).collect()}
    assert found == want and len(want) >= 8 * len(items)


@pytest.mark.parametrize("window, share", [(8, 0.5), (12, 0.75), (30, 0.9), (20, 1.0)])
def test_other_limits(spark, window, share):
    items = [words(n) for n in (3, 8, 14, 40)]
    docs = [planted(i, c) for i in items for c in (0, 1, 2, 3)] + [words(40) for _ in range(4)]
    frame = spark.createDataFrame(
        [(n, " ".join(d)) for n, d in enumerate(docs)], "doc_id long, text string"
    )
    bench = spark.createDataFrame(
        [(n, " ".join(i)) for n, i in enumerate(items)], "item_id long, text string"
    )
    want = {
        (n, m)
        for n, d in enumerate(docs)
        for m, i in enumerate(items)
        if brute(d, i, window, share)
    }
    found = dec.overlaps(frame, bench, window=window, share=share)
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == want and want


def test_odd_rows(spark, odd_docs, no_docs):
    fox = "The quick, brown fox jumps over the lazy dog!"
    bench = spark.createDataFrame(
        [(1, fox), (1, fox), (2, None), (3, ""), (4, "too short"), (None, fox)],
        "item_id long, text string",
    )
    found = dec.overlaps(odd_docs, bench).collect()
    assert sorted((r["doc_id"], r["item_id"] or 0) for r in found) == [(1, 0), (1, 1)]
    kept = dec.clean(odd_docs, bench)
    assert kept.columns == odd_docs.columns and kept.count() == 6
    assert kept.filter(F.col("doc_id").isNull()).count() == 1
    assert dec.overlaps(no_docs, bench).count() == 0
    assert dec.overlaps(odd_docs, bench.limit(0)).count() == 0


def test_plan_is_native_and_drops_no_column_late(spark, odd_docs):
    bench = spark.createDataFrame([(1, " ".join(words(30)))], "item_id long, text string")
    plan = dec.overlaps(odd_docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))
