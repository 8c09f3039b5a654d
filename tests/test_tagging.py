import re
import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martwright import fixed
from martwright.operators.tagging import (
    count_with_all,
    skill_taxonomy,
    tag_terms,
    term_frequency,
    term_pairs,
    word_taxonomy,
)


def tags(spark, texts, taxonomy=None):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    tagged = tag_terms(df, "text", taxonomy or skill_taxonomy()).orderBy("id")
    return [r["terms"] for r in tagged.collect()]


def test_quirks(spark):
    texts = ["JavaScript", "dashboards", "R for stats", "sql", None, "Java and Qlik Sense", "éSQL"]
    assert tags(spark, texts) == [
        ["JavaScript"], [], ["R"], ["SQL"], [], ["Java", "Qlik"], [],
    ]


def test_order_and_overlap(spark):
    text = "GDPR; SQL Server, data\nwarehouse, data modeler & PySpark. KPIs, BI reports (ML)"
    assert tags(spark, [text]) == [[
        "SQL", "Spark", "SQL Server", "Data Modeling", "Data Warehouse", "Machine Learning",
        "GDPR", "KPIs", "Reporting", "Business Intelligence",
    ]]


WORDS = (
    "sql SQL python r R for skills programming language java javascript power bi BI aws amazon web "
    "services google cloud data Data model modeling modeler warehouse lake lakehouse star schema "
    "dimensional machine learning ml statistics statistical analysis quality key performance "
    "indicators KPI report reporting business intelligence airflow apache pyspark qlikview ſql "
    "Kafka dımensional catalogé stakeholder"
).split()


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.lists(
            st.tuples(st.sampled_from(WORDS), st.sampled_from([" ", "  ", "\n", "-", "_", "", "\xa0", "."])),
            max_size=14,
        ).map(lambda pieces: "".join(w + gap for w, gap in pieces)),
        min_size=1, max_size=30,
    )
)
def test_equals_python_search(spark, texts):
    wanted = [
        [name for name, p in fixed.SKILL_PATTERNS.items() if re.search(p, text, re.IGNORECASE)]
        for text in texts
    ]
    assert tags(spark, texts) == wanted


def test_word_taxonomy(spark):
    taxonomy = word_taxonomy(["the", "to be", "été", "für"])
    texts = ["The other", "breathe", "to  be", "not to be", "ÉTÉ FÜR", "xété", "to bee; into be"]
    assert all(unicodedata.is_normalized("NFC", t) for t in texts)
    assert tags(spark, texts, taxonomy) == [["the"], [], [], ["to be"], ["été", "für"], [], []]


def test_counts(spark):
    df = spark.createDataFrame([(1, "SQL sql"), (2, "SQL, Python"), (3, None)], "id int, text string")
    tagged = tag_terms(df, "text", skill_taxonomy())
    got = {r["term"]: (r["frequency"], r["pct_of_posts"]) for r in term_frequency(tagged).collect()}
    assert got == {"SQL": (2, 66.7), "Python": (1, 33.3)}
    pairs = [tuple(r) for r in term_pairs(tagged, ["id"]).orderBy("id", "term").collect()]
    assert pairs == [(1, "SQL"), (2, "Python"), (2, "SQL")]
    assert count_with_all(df, "text", ["sql", "PYTHON"]).first()[0] == 1


def test_tags_are_evaluated_once(spark):
    df = spark.createDataFrame([(1, "SQL")], "id int, text string")
    counted = term_frequency(tag_terms(df, "text", skill_taxonomy()).select("terms"))
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_intersect") == 1
    assert "PythonUDF" not in plan


def test_terms_of_a_taxonomy_without_first_test(spark):
    from martwright.operators.tagging import Term

    taxonomy = [Term("digits", r"\d{3}"), Term("word", r"\bab\b")]
    assert tags(spark, ["x123", "ab 12", None], taxonomy) == [["digits"], ["word"], []]
    df = spark.createDataFrame([("a",)], "text string")
    assert tag_terms(df, "text", taxonomy).filter(F.size("terms") == 0).count() == 1
