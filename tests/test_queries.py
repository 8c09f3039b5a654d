"""Every registered query against its SQL, and what the plans must not hold."""

import pytest
from conftest import DATA

import __spark_entry__ as driver
from martwright.plans.oracle import ORACLE_SQL as ORACLE
from martwright.plans.queries import QUERIES
from tools.check import compare, connect


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, DATA), duck, ORACLE[name]) == []


def test_a_wrong_result_is_noticed(spark, duck):
    df = QUERIES["region_headcount"](spark, DATA)
    changed = ORACLE["region_headcount"].replace("sum(headcount)", "sum(headcount + 1)")
    assert compare(df, duck, changed)
    assert compare(df.limit(1), duck, ORACLE["region_headcount"])


def test_entry(spark):
    assert driver.entry(spark).count() > 0
    assert QUERIES.keys() <= driver.queries().keys() and ORACLE.keys() <= driver.oracle_sql().keys()


def test_texts_are_tagged_once(spark):
    plan = QUERIES["clean_posts"](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_intersect") == 1
    for name in ("kpi_core", "kpi_text", "kpi_exec"):  # tagged when the posts were written
        plan = QUERIES[name](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
        assert "array_intersect" not in plan


# These write or checkpoint first, so their plans start from files or RDDs.
@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ("surrogate_key", "item_rank")])
def test_plan_stays_in_the_jvm_and_distributed(spark, name):
    plan = QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("PythonUDF", "ArrowEval", "MapInPandas", "CartesianProduct", "NestedLoop"):
        assert unwanted not in plan
    if name not in ("term_rank", "term_rank_ext"):  # one row per taxonomy term
        assert not ("Window " in plan and "windowspecdefinition(specifiedwindowframe" in plan)
