from odd_rows import no_docs, odd_docs  # noqa: F401

import numpy as np
from pyspark.sql import functions as F

from martwright.llm import quality
from martwright.llm.common import bucket_of, table

DATA = "/root/testdata/sf0.001"


def labels(spark, *rows):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def test_pairwise_sum_is_that_of_all_pairs():
    rng = np.random.default_rng(0)
    params = quality.FMParams(buckets=64, bins=4, rank=3)
    size = params.buckets + len(quality.STATS) * (params.bins + 1)
    edges = np.sort(rng.normal(size=(len(quality.STATS), params.bins - 1)), axis=1)
    model = quality.FMModel(
        params, edges, 0.3, rng.normal(size=size).astype(np.float32),
        rng.normal(size=(size, 3)).astype(np.float32),
    )
    doc, bucket = np.array([0, 0, 0, 2]), np.array([5, 9, 40, 7])
    x, stats = np.array([0.5, 0.25, 1, 0.1], np.float32), rng.normal(size=(3, len(quality.STATS)))
    got = quality.logits(model, doc, bucket, x, stats)
    ids = quality.binned(stats, edges, params)
    for d in range(3):
        entries = list(zip(bucket[doc == d], x[doc == d], strict=True))
        entries += [(i, quality.STAT_X) for i in ids[d]]
        want = 0.3 + sum(model.weights[i] * v for i, v in entries)
        for n, (i, v) in enumerate(entries):
            for j, w in entries[n + 1 :]:
                want += model.factors[i] @ model.factors[j] * v * w
        assert abs(got[d] - want) < 1e-4


def test_held_out_accuracy(spark):
    docs, marks = table(spark, DATA, "documents"), table(spark, DATA, "labels")
    model = quality.train(docs, marks, bucket_of("doc_id", 5) != 0)
    rows = quality.score(docs, model, keep=["doc_id"]).join(marks, "doc_id").collect()
    assert all(0 <= r["score"] <= 1 for r in rows)
    right = [(r["score"] >= 0.3) == bool(r["quality"]) for r in rows]
    assert sum(right) / len(right) > 0.95


def test_odd_rows_and_labels(spark, odd_docs, no_docs):
    marks = labels(spark, (1, 1, 0), (3, 0, 0), (2, None, 0), (None, 1, 0), (99, 0, 0), (5, 1, 0))
    model = quality.train(odd_docs, marks, F.lit(True))
    out = quality.score(odd_docs, model)
    assert out.count() == odd_docs.count() and out.schema["score"].dataType.simpleString() == "double"
    assert out.filter("score is null or score < 0 or score > 1").count() == 0
    repeated = {r["score"] for r in out.filter("doc_id = 1").collect()}
    assert len(repeated) == 1
    assert quality.score(no_docs, model).count() == 0
    assert quality.score(no_docs, quality.train(no_docs, marks, F.lit(True))).count() == 0


def test_without_labels_every_score_is_a_half(spark, odd_docs):
    model = quality.train(odd_docs, labels(spark).limit(0), F.lit(True))
    scores = {round(r["score"], 6) for r in quality.score(odd_docs, model).collect()}
    assert scores == {0.5}
    one_class = quality.train(odd_docs, labels(spark, (1, 1, 0)), F.lit(True))
    assert min(r["score"] for r in quality.score(odd_docs, one_class).collect()) > 0.99
