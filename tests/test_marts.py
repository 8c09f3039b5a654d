import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from martwright.operators import kpis, marts, volumes
from martwright.operators.shares import flag_pct, joined_lists, share_of_total, top_k

ITEMS = [
    (1, "A", "x", True, True), (2, "B", "x", False, True), (3, "C", "y", False, False),
]


def items(spark):
    schema = "item_id bigint, item_name string, category string, is_flagship boolean, is_spirits boolean"
    return spark.createDataFrame(ITEMS, schema)


ARGS = ("category", "is_flagship", "is_spirits", "item_name", "item_id")


def test_category_mart(spark):
    mart = marts.category_mart(items(spark), *ARGS[:3])
    got = {r["category"]: r.asDict() for r in mart.collect()}
    assert len(got) == mart.count() and got["x"]["pct_of_items"] == 66.7
    names = marts.category_names(items(spark), ARGS[0], *ARGS[3:])
    assert {r["category"]: r["item_names"] for r in names.collect()}["x"] == "A, B"
    assert (got["y"]["item_count"], got["y"]["flagged_count"], got["y"]["kind_flag"]) == (1, 0, 0)


def test_flagged_names_are_null_without_any(spark):
    ext = marts.category_mart_ext(items(spark), *ARGS[:3])
    assert dict(rows(ext.select("category", "kind_label"))) == {"x": "Spirits", "y": "Non-Spirits"}
    names = marts.category_flagged_names(items(spark), *ARGS[:2], *ARGS[3:])
    assert dict(rows(names.select("category", "flagged_names"))) == {"x": "A", "y": None}


def test_long_lists_come_in_parts_that_join_to_the_whole(spark):
    df = spark.range(1000).select(
        "id", F.lit("hot").alias("k"), F.concat(F.lit("n"), F.col("id")).alias("name")
    )
    parts = joined_lists(df, ["k"], "name", "id", ", ", "names", width=64)
    got = [r["names"] for r in parts.orderBy("list_part").collect()]
    assert len(got) == 16
    assert ", ".join(got) == ", ".join(f"n{i}" for i in range(1000))
    # while the mart has one row however high the ids are
    high = df.withColumns({"f": F.lit(True), "id": F.col("id") * 1_000_000_007})
    assert marts.category_mart(high, "k", "f", "f").count() == 1


SITES = [
    (1, "s1", "R", "Office", "US", 10), (2, "s2", "R", "Office", "CA", 5),
    (3, "s3", "R", "Lab", "US", 1), (4, "s4", "R", "Office", "US", None),
]


def sites(spark):
    schema = "site_id bigint, site_name string, region string, site_type string, country string, headcount bigint"
    return spark.createDataFrame(SITES, schema)


SITE = ("region", "site_type", "headcount", "country", "site_id")


def test_region_marts(spark):
    mart = marts.region_type_mart(sites(spark), *SITE)
    assert rows(mart, "site_type") == [("R", "Lab", 1, 1, 1, "US"), ("R", "Office", 3, 15, 2, "US,CA")]
    assert rows(marts.region_rollup(mart, "region")) == [("R", 4, 16, 3)]  # US counts twice
    dated = sites(spark).withColumn("year", (F.lit(1990) + F.col("site_id")).cast("int"))
    ext = marts.region_type_mart_ext(dated, *SITE, "year").filter("site_type = 'Office'").first()
    assert (ext["avg_headcount"], ext["oldest_year"], ext["newest_year"]) == (8.0, 1991, 1994)
    summary = marts.region_summary(sites(spark), "region", "site_name", "headcount", "country")
    assert rows(summary) == [("R", 4, 16, 2)]


def test_small_reports(spark):
    df = items(spark)
    assert rows(flag_pct(df, "is_flagship", "p", "n")) == [(33.3, 3)]
    assert rows(share_of_total(df, ["category"], "n", "p"), "category") == [("x", 2, 66.7), ("y", 1, 33.3)]
    assert rows(marts.singleton_groups(df, "category")) == [("y", 1)]
    assert [r["item_id"] for r in top_k(df, "is_spirits", 2, "item_id").collect()] == [1, 2]
    assert rows(marts.segment_split(df, "is_spirits", "S", "N"), "segment") == [
        ("N", 1, 33.3), ("S", 2, 66.7),
    ]


def test_kpis(spark):
    posts = spark.createDataFrame(
        [("Data", True, False, 3), ("Sales", False, False, 2)],
        "department string, is_remote boolean, is_hybrid boolean, term_count int",
    )
    terms = spark.createDataFrame(
        [("SQL", 2, "Tier 1 — Must Have"), ("R", 1, "x")],
        "term string, frequency bigint, demand_tier string",
    )
    tables = (items(spark), sites(spark), posts, terms)
    core = {r["kpi"]: r["value"] for r in kpis.kpi_table(*tables).collect()}
    assert len(core) == 9 and core["Countries Served"] == 2 and core["Remote Positions"] == 1
    text = {r["kpi"]: r["value"] for r in kpis.kpi_text(*tables, home="US").collect()}
    assert len(text) == 13 and text["International Locations"] == "1"
    assert text["Tier-1 Must-Have Skills"] == "1"
    exe = kpis.kpi_exec(*tables, as_of=dt.date(2026, 1, 1), home="US")
    got = {r["kpi"]: (r["value"], r["display_format"]) for r in exe.collect()}
    assert len(got) == 16
    assert got["Spirits Brands (%)"] == ("66.7", "pct")
    assert got["Top Required Skill"] == ("SQL", "text")
    assert got["Avg Skills/Posting"] == ("2.5", "number")
    assert got["Data Roles (%)"] == ("50.0", "pct")


def test_each_kpi_source_is_scanned_once(spark):
    posts = items(spark).selectExpr("category department", "is_flagship is_remote")
    table = kpis.kpi_table(items(spark), sites(spark), posts, items(spark))
    assert table._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 4


def test_top_term_of_an_empty_table(spark):
    df = items(spark)
    posts = df.selectExpr("category department", "is_flagship is_remote", "is_flagship is_hybrid", "1 term_count")
    terms = spark.createDataFrame([], "term string, frequency bigint, demand_tier string")
    exe = kpis.kpi_exec(df, sites(spark), posts, terms, dt.date(2026, 1, 1))
    assert exe.filter("kpi = 'Top Required Skill'").first()["value"] == "N/A"


FACT = "item string, category string, year int, month int, state string, flag boolean, cases bigint"


def facts(spark):
    return spark.createDataFrame(
        [("a", "c", 2026, 1, "X", True, 10), ("a", "c", 2026, 1, "Y", False, 4),
         ("a", "c", 2026, 2, "Y", False, 7), ("b", "c", 2026, 1, "X", True, 9)], FACT,
    )


def test_volumes(spark):
    trend = volumes.volume_trend(facts(spark), ["item", "year", "month"], {"cases": "total"})
    assert rows(trend, "item", "month") == [("a", 2026, 1, 14), ("a", 2026, 2, 7), ("b", 2026, 1, 9)]
    summary = volumes.flag_summary(facts(spark), "item", "flag", "state", "cases")
    assert rows(summary, "item", "state_type")[1] == ("a", "Open State", 11, 1, 6.0)
    states = spark.createDataFrame([("X",), ("Y",), ("Z",), ("W",)], "state string")
    shares = volumes.share_metrics(facts(spark), ["item", "category"], "category", "state", "cases", states)
    assert rows(shares, "item") == [("a", "c", 70.0, 50.0, 0.4), ("b", "c", 30.0, 25.0, 0.4)]


def test_dense_series_fills_with_zero(spark):
    dated = facts(spark).withColumn("day", F.make_date("year", "month", F.lit(15)))
    first, last = F.lit("2025-12-03").cast("date"), F.lit("2026-02-01").cast("date")
    dense = volumes.dense_series(dated, ["item", "state"], "day", "cases", first, last)
    assert dense.count() == dense.select("item", "state", "month_start").distinct().count() == 9
    assert dense.filter("cases = 0").count() == 5 and dense.agg(F.sum("cases")).first()[0] == 30
    assert "Join" not in dense._jdf.queryExecution().executedPlan().toString()


def test_months_merge(spark):
    keys = ["item", "year", "month"]
    whole = volumes.volume_trend(facts(spark), keys, {"cases": "total"})
    old = volumes.volume_trend(facts(spark).filter("state = 'X'"), keys, {"cases": "total"})
    new = volumes.volume_trend(facts(spark).filter("state <> 'X'"), keys, {"cases": "total"})
    merged = volumes.merge_months(old, new, keys, ["total"])
    assert rows(merged, *keys) == rows(whole, *keys)
