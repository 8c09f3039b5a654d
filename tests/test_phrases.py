import pytest
from pyspark.sql import functions as F

from martwright.operators import phrases
from martwright.operators.phrases import phrase_hits, phrase_index, tag_phrases, taxonomy_index
from martwright.operators.tagging import Term, skill_taxonomy, tag_terms
from martwright.plans import roles

DATA = "/root/testdata/sf0.001"


def test_equal_to_the_taxonomy_in_code(spark):
    docs = roles.skill_texts(spark, DATA).withColumn("source", F.lit("x"))
    for taxonomy in (skill_taxonomy(), roles.TAXONOMY):
        taxonomy = [t for t in taxonomy if t.alternatives()]
        want = tag_terms(docs, "text", taxonomy).select("doc_id", F.array_sort("terms").alias("terms"))
        got = tag_phrases(docs, "doc_id", "text", taxonomy_index(spark, taxonomy))
        assert got.columns == [*docs.columns, "terms"]
        assert sorted(map(str, got.select("doc_id", "terms").collect())) == sorted(map(str, want.collect()))


def test_phrases_of_any_length_and_patterns(spark):
    table = spark.createDataFrame(
        [
            ("data", "Data", None), ("lake", "data lake", None), ("lake", "lake house", None), ("long", "a b c d e", None),
            ("exact", "Power BI", r"Power BI\b"), ("none", " !! ", None), ("é", "été", None),
        ],
        "name string, words string, pattern string",
    )
    index = phrase_index(table, "name", "words", "pattern")
    assert index.count() == 6
    docs = spark.createDataFrame(
        [
            (1, "DATA-lake; data lake house"), (2, "x a b, c D e f a b c d"), (3, "power bi Power  BI"), (4, "Power BI"),
            (5, None), (6, ""), (7, "L'Été database"), (None, "data"),
        ],
        "id long, t string",
    )
    hits = sorted(phrase_hits(docs, "id", "t", index).collect(), key=str)
    assert [tuple(h) for h in hits] == sorted(
        [(1, "data"), (1, "lake"), (2, "long"), (4, "exact"), (7, "é"), (None, "data")], key=str
    )
    tagged = {r["id"]: r["terms"] for r in tag_phrases(docs, "id", "t", index).filter("id < 9").collect()}
    assert tagged == {1: ["data", "lake"], 2: ["long"], 3: [], 4: ["exact"], 5: [], 6: [], 7: ["é"]}


def test_no_phrases(spark):
    docs = spark.createDataFrame([(1, "a")], "id long, t string")
    index = phrase_index(spark.createDataFrame([], "n string, p string"), "n", "p")
    assert tag_phrases(docs, "id", "t", index).collect() == [(1, "a", [])]
    with pytest.raises(ValueError, match="names no phrase"):
        taxonomy_index(spark, [Term("x", r"x\d")])


def test_many_phrases(spark):
    """Every word of the texts and as many that are in none."""
    docs = roles.table(spark, DATA, "documents").select("doc_id", "text")
    words = docs.select(F.explode(F.split(F.lower("text"), r"[^\p{L}\p{N}_]+")).alias("w")).distinct()
    table = words.unionByName(spark.range(50_000).select(F.concat(F.lit("no phrase "), "id").alias("w")))
    index = phrase_index(table.filter("w <> ''"), "w", "w")
    found = phrase_hits(docs, "doc_id", "text", index)
    assert found.select("term").distinct().count() == words.filter("w <> ''").count()


@pytest.mark.parametrize("heads", [0, 2, 3, 1000])
def test_few_and_many_first_words(spark, monkeypatch, heads):
    monkeypatch.setattr(phrases, "HEADS", heads)
    rows = [("p", "a b"), ("q", "b c"), ("r", "a b c"), ("s", "c"), ("t", "c a"), ("u", "a a")]
    index = phrase_index(spark.createDataFrame(rows, "n string, p string"), "n", "p")
    docs = spark.createDataFrame([(1, "a b c"), (2, "c, A a"), (3, "a"), (4, " b  c ")], "id long, t string")
    found = {tuple(r) for r in phrase_hits(docs, "id", "t", index).collect()}
    assert found == {
        (1, "p"), (1, "q"), (1, "r"), (1, "s"), (2, "s"), (2, "t"), (2, "u"), (4, "q"), (4, "s"),
    }


def test_texts_stay_where_they_are(spark):
    """With terms in code no n-gram is shuffled, however large the documents; without patterns the
    texts are read once."""
    docs = roles.table(spark, DATA, "documents").select("doc_id", "text")
    named = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as for tables above it
    try:
        for terms in (roles.TAXONOMY, [t for t in roles.TAXONOMY if t.whole_words()]):
            hits = phrase_hits(docs, "doc_id", "text", taxonomy_index(spark, terms))
            plan = hits._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin [phrase" in plan and "SortMergeJoin [phrase" not in plan
            want = tag_terms(docs, "text", terms).selectExpr("doc_id", "explode(terms) AS term")
            assert sorted(hits.collect()) == sorted(want.collect())
        assert plan.count("FileScan parquet") == plan.count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", named)
