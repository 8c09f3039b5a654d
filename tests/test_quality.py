import datetime as dt

from conftest import rows

from martwright.operators.quality import (
    append_dq_log,
    constraint_check,
    dq_checks,
    dq_summary,
    table_counts,
    validate,
)
from martwright.sources.specs import DQ_LOG, Col, TableSpec

AT = dt.datetime(2026, 1, 1)


def test_checks(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", None), ("a", float("nan")), ("", 2.0), (None, 3.0)], "k string, n double"
    )
    report = dq_checks(df, "t", ["k", "n", "gone"], ["k"], AT)
    assert [(r["passed"], r["message"]) for r in report.orderBy("check_no").collect()] == [
        (True, "Row count OK (5 rows)"),
        (False, "Missing required columns: ['gone']"),
        (False, "Column 'k' has 2 nulls/blanks (40.0%)"),
        (False, "Column 'n' has 2 nulls/blanks (40.0%)"),
        (False, "Found 2 duplicate rows on ['k']"),
    ]
    summary = dq_summary(report).first()
    assert (summary["total_rows"], summary["checks_passed"], summary["checks_failed"]) == (5, 1, 4)
    assert summary["issues"][0].startswith("Missing")


def test_null_keys_equal_each_other(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",)], "k string")
    last = dq_checks(df, "t", ["k"], ["k"], AT).orderBy("check_no").collect()[-1]
    assert last["message"] == "Found 1 duplicate rows on ['k']"


def test_empty_table_is_one_failed_check(spark):
    report = dq_checks(spark.createDataFrame([], "k string"), "t", ["k"], ["k"], AT)
    assert [r["passed"] for r in report.orderBy("check_no").collect()] == [False, True, True, True]


def test_log_is_appended(spark, tmp_path):
    report = dq_checks(spark.createDataFrame([("a",)], "k string"), "t", ["k"], [], AT)
    for _ in range(2):
        append_dq_log(dq_summary(report), str(tmp_path / "log"))
    log = spark.read.schema(DQ_LOG.schema()).parquet(str(tmp_path / "log"))
    assert rows(log) == [("t", AT, 1, 3, 0, [])] * 2


def test_constraints(spark):
    spec = TableSpec(
        "t", (Col("k", "int", not_null=True), Col("f", "int", domain=(0, 1))), unique=(("k",),)
    )
    df = spark.createDataFrame([(1, 0), (1, 2), (None, None)], "k int, f int")
    assert rows(constraint_check(df, spec), "rule") == [
        ("t", "CHECK f IN (0,1)", 1), ("t", "NOT NULL k", 1), ("t", "UNIQUE k", 1),
    ]


def test_counts_and_validation(spark):
    df = spark.range(3)
    assert rows(table_counts({"a": df, "b": df.limit(0)}), "table_name") == [("a", 3), ("b", 0)]
    df.createOrReplaceTempView("three")
    got = validate(spark, {"ok": "SELECT count(*) FROM three", "bad": "SELECT * FROM nowhere"})
    assert rows(got["ok"]) == [(3,)] and "nowhere" in got["bad"]
    long = validate(spark, {"all": "SELECT * FROM range(250)"})
    assert long["all"].count() == 250
