import datetime as dt

from conftest import rows
from pyspark.sql import DataFrameWriter

from martwright.operators.quality import read_log
from martwright.plans import cleaning, silver

AT = dt.datetime(2026, 1, 1)


def scans(spark, action):
    """Scans of files that an action adds to the plans Spark runs."""
    seen = []
    plain = DataFrameWriter.parquet

    def counted(self, path, *args, **kwargs):
        seen.append(self._df._jdf.queryExecution().optimizedPlan().toString().count("Relation ["))
        return plain(self, path, *args, **kwargs)

    DataFrameWriter.parquet = counted
    try:
        result = action()
    finally:
        DataFrameWriter.parquet = plain
    return result, seen


def stored(spark, df, path):
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_posts_are_checked_while_they_are_written(spark, tmp_path):
    raw = spark.createDataFrame(
        [
            (1, " Engineer ", None, "Remote, KY", "2025-01-02", "SQL|R"), (2, "Engineer", "", "x", "no date", ""),
            (3, "Engineer", "Data", "y", " ", None), (4, None, "Data", "z", "2025-13-01", ""), (5, "", "Data", "z", None, ""),
        ],
        "post_id long, title string, department string, location string, posted_date string, terms string",
    ).selectExpr("*", "string(null) AS employment_type")
    raw = stored(spark, raw, str(tmp_path / "raw"))
    job = cleaning.post_job(AT)
    result, seen = scans(
        spark, lambda: cleaning.run_job(raw, job, str(tmp_path / "out"), AT, str(tmp_path / "log"), "r")
    )
    # One scan of the raw table for rows and checks together; the log has no scan.
    assert seen == [1, 0]
    assert (result.rows_in, result.rows_out, result.counts) == (5, 5, {"no date": 2})
    want = silver.clean_posts(raw, AT)
    out = spark.read.parquet(result.path)
    assert rows(out.select(sorted(out.columns)), "post_id") == rows(want.select(sorted(out.columns)), "post_id")
    assert rows(result.log.select("table_name", "total_rows", "checks_passed", "checks_failed", "issues")) == [
        ("fact_posts", 5, 4, 3, [
            "Column 'title' has 2 nulls/blanks (40.0%)", "Column 'department' has 1 nulls/blanks (20.0%)",
            "no date: 2 rows",
        ]),
    ]


def test_repeated_sites_and_missing_coordinates(spark, tmp_path):
    raw = spark.createDataFrame(
        [(1, "A", "France", "Office", "1.5", "2"), (2, "A ", "France", "Office", None, "2"), (3, "B", None, "x", "n/a", "")],
        "site_id long, site_name string, country string, site_type string, latitude string, longitude string",
    ).selectExpr("*", "'7' AS headcount")
    raw = stored(spark, raw, str(tmp_path / "raw"))
    result, seen = scans(
        spark,
        lambda: cleaning.run_job(raw, cleaning.site_job(), str(tmp_path / "out"), AT, str(tmp_path / "log"), "r"),
    )
    assert seen == [1, 0]
    assert (result.rows_in, result.rows_out, result.counts) == (3, 2, {"no coordinates": 2})
    want = silver.clean_sites(raw, AT)
    assert rows(spark.read.parquet(result.path).select(want.columns), "site_id") == rows(want, "site_id")
    log = read_log(spark, str(tmp_path / "log"))
    assert log.first()["issues"] == [
        "Column 'country' has 1 nulls/blanks (50.0%)", "Found 1 duplicate rows on ['site_name']",
        "no coordinates: 2 rows",
    ]


def test_items_and_terms(spark, tmp_path):
    items = spark.createDataFrame(
        [(1, "old one", "Bourbon", "d" * 400), (2, "Old One", "gin", "")],
        "item_id long, item_name string, category string, description string",
    )
    log = str(tmp_path / "log")
    result = cleaning.run_job(items, cleaning.item_job("test"), str(tmp_path / "i"), AT, log)
    assert (result.rows_in, result.rows_out) == (2, 1)
    want = silver.clean_items(items, AT, "test")
    assert rows(spark.read.parquet(result.path).select(want.columns)) == rows(want)
    terms = spark.createDataFrame([("SQL", "2", "50"), ("", "x", None)], "term string, frequency string, pct_of_posts string")
    result = cleaning.run_job(terms, cleaning.term_job(), str(tmp_path / "t"), AT, log)
    want = silver.clean_terms(terms, AT)
    assert rows(spark.read.parquet(result.path).select(want.columns), "term") == rows(want, "term")
    assert rows(read_log(spark, log).select("table_name", "checks_failed", "run"), "table_name") == [
        ("dim_item", 1, AT.isoformat()), ("fact_terms", 1, AT.isoformat()),
    ]


def test_an_empty_table(spark, tmp_path):
    terms = spark.createDataFrame([], "term string, frequency string, pct_of_posts string")
    result = cleaning.run_job(terms, cleaning.term_job(), str(tmp_path / "t"), AT, str(tmp_path / "log"))
    assert (result.rows_in, result.rows_out) == (0, 0)
    assert result.log.first()["issues"] == ["Table is empty (0 rows)"]
