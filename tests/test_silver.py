import datetime as dt

import pytest
from conftest import rows

from martwright import fixed
from martwright.plans import gold, silver
from martwright.operators.tagging import skill_taxonomy
from martwright.operators.volumes import share_metrics
from martwright.sources import specs

AT = dt.datetime(2026, 1, 1)


def raw_items(spark):
    return spark.createDataFrame(
        [(2, "old  oak", "whisky", "short", False), (1, " old  oak ", " Bourbon Whiskey", "A long text here", True),
         (3, "mixer one", "Soda", None, False)],
        "item_id bigint, item_name string, category string, description string, is_flagship boolean",
    )


def raw_sites(spark):
    return spark.createDataFrame(
        [(1, " Site ", "Canada ", "OFFICE", "1.5", "x", "12.9"), (2, "Site", "Canada", "Lab", "1", "2", ""),
         (3, "Far", "Chile", "Lab", None, "2", None)],
        "site_id bigint, site_name string, country string, site_type string, latitude string, "
        "longitude string, headcount string",
    )


def raw_posts(spark):
    return spark.createDataFrame(
        [(1, "Data Director", None, "Louisville, KY (Hybrid)", None, "2025-05-01", "SQL and Python"),
         (2, "Data Director", None, "Remote", None, "bad", "SQL"),
         (3, "Clerk", "Sales", None, "Part-Time", None, None)],
        "post_id bigint, title string, department string, location string, employment_type string, "
        "posted_date string, description string",
    )


def test_items(spark):
    got = {r["item_id"]: r for r in silver.clean_items(raw_items(spark), AT, "test").collect()}
    assert set(got) == {1, 3}
    assert (got[1]["item_name"], got[1]["category"], got[1]["is_spirits"]) == (
        "Old  Oak", "Bourbon Whiskey", True,
    )
    assert (got[3]["category"], got[3]["is_spirits"], got[3]["has_description"]) == (
        "Uncategorized", False, False,
    )
    assert (got[1]["processed_at"], got[1]["data_source"]) == (AT, "test")


def test_sites(spark):
    cleaned = silver.clean_sites(raw_sites(spark), AT)
    got = {r["site_id"]: r for r in cleaned.collect()}
    assert set(got) == {1, 3}
    assert (got[1]["region"], got[1]["site_type"], got[1]["headcount"]) == ("Americas", "Office", 12)
    assert (got[3]["region"], got[3]["site_type"], got[3]["headcount"]) == ("Other", "Lab", 0)
    assert silver.invalid_rows(cleaned, ["latitude", "longitude"]).count() == 2


def test_whole_job(spark, tmp_path):
    """Tag, clean, load, build the views, check, export."""
    tagged = gold.tag_posts(raw_posts(spark), skill_taxonomy(), "description", str(tmp_path / "tags"))
    assert tagged["pairs"].count() == 3
    posts = silver.clean_posts(tagged["posts"], AT)
    got = {r["post_id"]: r for r in posts.collect()}
    assert set(got) == {1, 3}
    assert (got[1]["department"], got[1]["state"], got[1]["is_hybrid"], got[1]["term_count"]) == (
        "Unknown", "KY", True, 2,
    )
    assert (got[1]["seniority"], got[3]["seniority"]) == ("Senior Leadership", "Mid-Level")
    assert (got[3]["location"], got[3]["posted_date"]) == (fixed.DEFAULT_POST_LOCATION, AT.date())

    terms = silver.clean_terms(tagged["terms"], AT)
    facts = spark.createDataFrame(
        [(2026, 1, "Jan 2026", "a", "c", "Value", "KY", "Kentucky", 1, 22, 78, 100)],
        specs.FACT_VOLUMES.schema(),
    )
    states = spark.createDataFrame([("KY",)], "s string")
    shares = share_metrics(
        facts, ["item", "category", "price_tier"], "category", "state_code", "total_cases", states
    )
    house = gold.Warehouse(spark, str(tmp_path / "house"))
    result = house.build(
        {
            specs.DIM_ITEM: silver.clean_items(raw_items(spark), AT, "test"),
            specs.DIM_SITE: silver.clean_sites(raw_sites(spark), AT),
            specs.FACT_POSTS: posts.unionByName(posts),  # repeated ids
            specs.FACT_TERMS: terms,
            specs.FACT_VOLUMES: facts,
            specs.FACT_SHARES: shares,
        },
        AT,
        {
            "dim_item": "item_id", "dim_site": "site_id", "fact_posts": "post_id",
            "fact_terms": "frequency",
        },
        str(tmp_path / "marts"),
    )
    assert house.table(specs.FACT_POSTS).count() == 2
    with pytest.raises(ValueError):
        house.build({specs.DIM_ITEM: silver.clean_items(raw_items(spark), AT, "test")}, AT)
    assert result["failed_views"] == {}
    assert result["exported"] == {
        "items_by_category": 2, "sites_by_region": 2, "term_ranking": 2, "top_terms": 1,
        "category_names": 2, "posts_by_department": 2, "department_levels": 2, "portfolio_summary": 9, "volume_trend": 1,
        "control_state_summary": 1, "market_share": 1,
    }
    assert rows(result["checks"]["dim_item row count"]) == [(2,)]
    assert rows(result["checks"]["top terms"]) == [("SQL", 2), ("Python", 1)]
    logged = rows(house.table(specs.DQ_LOG).select("table_name"), "table_name")
    assert [name for (name,) in logged] == sorted(s.name for s in (
        specs.DIM_ITEM, specs.DIM_SITE, specs.FACT_POSTS, specs.FACT_TERMS, specs.FACT_VOLUMES,
        specs.FACT_SHARES,
    ))
    marts = gold.gold_marts(
        *(house.table(s) for s in (specs.DIM_ITEM, specs.DIM_SITE, specs.FACT_POSTS, specs.FACT_TERMS)),
        AT.date(),
    )
    assert list(marts) == ["category_mart_first", "region_type_mart_basic", "top_terms", "kpi_exec"]
    assert rows(marts["top_terms"].select("term")) == [("SQL",), ("Python",)]
    assert marts["kpi_exec"].count() == 16 and marts["region_type_mart_basic"].count() == 2
    reports = gold.report_exports(
        *(house.table(s) for s in (specs.DIM_ITEM, specs.DIM_SITE, specs.FACT_POSTS, specs.FACT_TERMS))
    )
    gold.write_frames(marts | reports, str(tmp_path / "reports"))
    written = spark.read.csv(str(tmp_path / "reports/category_distribution"), header=True)
    assert written.columns == ["Category", "Item Count", "% of Items"] and written.count() == 2
    assert rows(result["read_outs"].filter("label = 'dim_item row count'").select("record", "error")) == [
        ('{"count(1)":2}', None)
    ]
    log = house.check(specs.DIM_ITEM, ["item_name", "category"], ["item_name"], AT, "another run")
    assert rows(log.select("run", "table_name", "total_rows")) == [("another run", "dim_item", 2)]
    for _ in range(2):
        house.check(specs.DIM_ITEM, ["item_name", "category"], ["item_name"], AT, "another run")
    assert house.table(specs.DQ_LOG).count() == 7
