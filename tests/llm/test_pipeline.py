
from odd_rows import no_docs, odd_docs  # noqa: F401

import pytest

import corpus_pipeline as pipeline
from martwright.llm.common import table, written
from martwright.llm.queries import ORACLE_SQL, QUERIES
from martwright.session import fresh_path

DATA = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark):
    docs = table(spark, DATA, "documents")
    columns, rows = docs.columns, {r["doc_id"]: r for r in docs.collect()}
    for name, stage in pipeline.STAGES[:-1]:
        before = docs.count()
        docs = written(stage(spark, docs, DATA), name)
        assert docs.columns == columns and 0 < docs.count() <= before
        assert all(rows[r["doc_id"]] == r for r in docs.collect())
    last = pipeline.STAGES[-1][1](spark, docs, DATA).collect()
    assert {r["doc_id"] for r in last} == {r["doc_id"] for r in docs.collect()}
    assert all(r["round_trip"] and r["n_pieces"] == len(r["ids"]) for r in last)


def test_run_on_nothing(spark):
    folder = fresh_path(spark, "empty-tables")
    for name in ("documents", "labels", "benchmark"):
        table(spark, DATA, name).limit(0).write.parquet(f"{folder}/{name}.parquet")
    assert pipeline.run(spark, folder).count() == 0


def test_odd_rows(spark, odd_docs):
    docs = odd_docs
    for name, stage in pipeline.STAGES:
        docs = written(stage(spark, docs, DATA), name)
    ids = [r["doc_id"] for r in docs.collect()]
    assert len(ids) == len(set(ids))


def test_every_query_is_registered():
    assert [int(n[2:].split("_")[0]) for n in sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    from tools.check import compare, connect

    assert compare(QUERIES[name](spark, DATA), connect(DATA), ORACLE_SQL[name]) == []




def test_texts_in_two_languages_stay(spark):
    """Half French, half German, with a few words in a script nobody learned."""
    docs = table(spark, DATA, "documents")
    parts = {r["lang"]: r["text"].split()[:60] for r in docs.filter("length(text) > 600").collect()}
    mixed = " ".join([*parts["fr"], "пара слов", *parts["de"]])
    odd = docs.limit(1).selectExpr("doc_id + 900000 AS doc_id", "lang", "source", "n_chars")
    rows = [(mixed, 1), ("только чужие буквы и слова", 2), (None, 3), ("12 34 !", 4)]
    extra = spark.createDataFrame(rows, "text string, n int").crossJoin(odd).selectExpr(
        "doc_id + n AS doc_id", "text", "lang", "source", "n_chars"
    )
    kept = pipeline.keep_language(spark, docs.unionByName(extra), DATA)
    first = odd.first()["doc_id"]
    assert {r["doc_id"] - first for r in kept.filter("doc_id > 900000").collect()} == {1}
