import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martwright import fixed
from martwright.functions import (
    clip,
    contains_flag,
    extract_code,
    flag_label,
    has_text,
    keyword_ladder,
    list_size,
    month_parts,
    month_spine,
    pct,
    set_ladder,
    split_shares,
    strip,
    threshold_ladder,
    time_literal,
    title_case,
    to_date_lenient,
    to_number,
)
from martwright.operators.lookup import map_lookup, map_value


def test_strip(one):
    assert one(strip("c"), " \n a \t", None, " x y\xa0", "") == ["a", None, "x y", ""]


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.text(alphabet=" \t\n\x0b\x1c\x85\xa0 　ab", max_size=8), min_size=1))
def test_strip_equals_python(one, texts):
    assert one(strip("c"), *texts) == [t.strip() for t in texts]


def test_title_case(one):
    given_, wanted = (
        ["Fisher's", "A.B. SMITH", "7x", "Corazón", "DR. mcx'S"],
        ["Fisher'S", "A.B. Smith", "7X", "Corazón", "Dr. Mcx'S"],
    )
    assert one(title_case("c"), *given_) == wanted == [g.title() for g in given_]


def test_clip_and_presence(one):
    assert one(clip("c", 4), "ab  cd", None) == ["ab", None]
    assert one(has_text("c", 2), "abc", "ab", None) == [True, False, False]


def test_lookups(one, spark):
    expression = map_value(F.lower(strip("c")), fixed.CATEGORY_NAMES, fixed.DEFAULT_CATEGORY)
    assert one(expression, " Cognac ", "soda", None) == ["Brandy", "Uncategorized", "Uncategorized"]
    keep = map_value(F.lower("c"), fixed.SITE_TYPES, F.col("c"))
    assert one(keep, "OFFICE", "Lab") == ["Office", "Lab"]
    assert one(map_value("c", fixed.COUNTRY_REGION, "Other"), "Chile", "UAE") == ["Other", "EMEA"]

    lookup = spark.createDataFrame([("a", "1"), ("a", "0"), ("b", "2")], "k string, v string")
    df = spark.createDataFrame([("a",), ("x",), (None,)], "c string")
    got = {r["c"]: r["out"] for r in map_lookup(df, "c", lookup, "k", "v", "out", "-").collect()}
    assert got == {"a": "0", "x": "-", None: "-"}


def test_long_literal_tables_are_no_error(one):
    table = {str(i): "x" for i in range(300)}
    assert one(map_value("c", table, None), "299", "300") == ["x", None]


def test_numbers(one):
    values = ["x", "", " 12 ", "1.5e2", "1d", "NaN", "-7.9", None]
    assert one(to_number("c"), *values) == [None, None, 12.0, 150.0, None, None, -7.9, None]
    assert one(to_number("c", fill=0, as_int=True), *values) == [0, 0, 12, 150, 0, 0, -7, 0]
    assert one(pct(F.lit(1), F.col("c").cast("int")), "3", "0") == [33.3, None]


def test_split_shares(spark):
    parts = split_shares("n", {"on": 0.22, "off": 0.78})
    row = spark.createDataFrame([(101,)], "n bigint").select(*(c.alias(k) for k, c in parts.items()))
    assert tuple(row.first()) == (22, 78)


def test_dates(one, spark):
    as_of = dt.date(2026, 1, 1)
    assert one(to_date_lenient("c", as_of), "2025-02-03", "bad", None) == [
        dt.date(2025, 2, 3), as_of, as_of,
    ]
    assert one(month_parts(F.col("c").cast("date"))["month_label"], "2026-03-15") == ["Mar 2026"]
    last = spark.createDataFrame([(dt.date(2026, 3, 15),)], "as_of date")
    labels = [r["month_label"] for r in month_spine(last, "as_of").orderBy("month_start").collect()]
    assert (labels[0], labels[-1], len(labels)) == ("Apr 2025", "Mar 2026", 12)


def test_time_literal_does_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    at = dt.datetime(2026, 1, 1, 12, tzinfo=dt.timezone(dt.timedelta(hours=2)))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = spark.range(1).select(time_literal(at), time_literal(None)).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert tuple(row) == (dt.datetime(2026, 1, 1, 10), None)


def test_codes_and_flags(one):
    assert one(
        extract_code("c", fixed.STATE_PATTERN), "Louisville, KY (Hybrid)", "Remote", None
    ) == ["KY", None, None]
    assert one(contains_flag("c", "remote"), None, "REMOTE", "on site") == [False, True, False]
    assert one(list_size("c"), "a|b|c", "", "  ", None) == [3, 0, 0, 0]
    assert one(flag_label(F.col("c").cast("int"), "y", "n"), "1", "0", None) == ["y", "n", "n"]


def test_ladders(one):
    titles = ["Senior Director", "Senior Manager", "Team Leader", "Brand Manager", "Analyst"]
    ladder = keyword_ladder("c", fixed.SENIORITY_RULES, fixed.DEFAULT_SENIORITY)
    assert one(ladder, *titles) == ["Senior Leadership", "Senior", "Senior", "Manager", "Mid-Level"]
    tiers = threshold_ladder(F.col("c").cast("double"), fixed.DEMAND_TIERS, fixed.TIER_4)
    assert one(tiers, "70", "69.9", "40", "20", "19.9", None) == [
        fixed.TIER_1, fixed.TIER_2, fixed.TIER_2, fixed.TIER_3, fixed.TIER_4, fixed.TIER_4,
    ]
    sets = set_ladder("c", fixed.SKILL_CATEGORIES, fixed.DEFAULT_SKILL_CATEGORY)
    assert one(sets, "SQL", "GDPR", "Agile") == [
        "Language / Query", "Governance", "Analytics / Modeling",
    ]
