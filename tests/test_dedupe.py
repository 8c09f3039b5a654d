import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from martwright.operators.dedupe import (
    dedupe_first,
    upsert_latest,
    with_rank,
    with_rank_large,
    with_row_id,
)


def test_dedupe_first(spark):
    df = spark.createDataFrame(
        [(3, "a", "x"), (1, "a", "x"), (2, None, "x"), (5, None, "x"), (4, "a", "y")],
        "id int, k string, l string",
    )
    assert rows(dedupe_first(df, ["k", "l"], ["id"]), "id") == [
        (1, "a", "x"), (2, None, "x"), (4, "a", "y"),
    ]


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    df = spark.range(100).select("id", (F.col("id") % 2).alias("k"))
    plan = dedupe_first(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    before = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[:before] and "WindowGroupLimit" in plan[before:]


def test_upsert_latest(spark):
    schema = "k int, v string, n int"
    current = spark.createDataFrame([(1, "old", 9), (2, "keep", 1)], schema)
    incoming = spark.createDataFrame([(1, "new", 1), (1, "newer", 2), (3, "add", 1)], schema)
    assert rows(upsert_latest(current, incoming, ["k"], "n"), "k") == [
        (1, "newer", 2), (2, "keep", 1), (3, "add", 1),
    ]


def test_row_id_with_a_hot_leading_value(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 11).alias("day"), "id"
    )
    got = with_row_id(df, ["day", "id"])
    want = df.withColumn("want", F.row_number().over(Window.orderBy("day", "id")))
    assert got.join(want, ["day", "id"]).filter("row_id != want").count() == 0
    assert got.select("row_id").distinct().count() == 1000


def test_rank_ties(spark):
    df = spark.createDataFrame([(10,), (10,), (9,)], "n int")
    assert rows(with_rank(df, "n"), "rank", "n") == [(10, 1), (10, 1), (9, 3)]


@pytest.mark.parametrize("by", [None, ["g"]])
def test_large_rank_equals_window_rank(spark, by):
    df = spark.range(2000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 5).cast("string")).alias("g"),
        F.when(F.col("id") % 4 == 0, 50).otherwise(F.pmod(F.hash("id"), F.lit(300))).alias("n"),
    )
    df = df.withColumn("g", F.nullif("g", F.lit("2"))).withColumn("n", F.nullif("n", F.lit(17)))
    assert rows(with_rank(df, "n", by), "id") == rows(with_rank_large(df, "n", by), "id")
