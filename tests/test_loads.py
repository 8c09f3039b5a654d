"""Loads that neither lose nor double data."""

import datetime as dt
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from martwright.operators import quality, volumes
from martwright.operators.dedupe import upsert_latest
from martwright.plans import gold
from martwright.sources import specs
from martwright.sources.buckets import read_buckets, upsert_buckets
from martwright.sources.specs import Col, TableSpec
from martwright.sources.versions import Load, live_tables, live_version, read_live, refresh

AT = dt.datetime(2026, 1, 1)


def broken(df):
    """The rows, the last of which cannot be made."""
    last = df.agg(F.max("id")).first()[0]
    return df.withColumn("id", F.when(F.col("id") == last, F.raise_error(F.lit("half way")).cast("long")).otherwise(F.col("id")))


def test_a_load_that_fails_leaves_the_old_tables(spark, tmp_path):
    root = str(tmp_path / "house")
    assert live_version(spark, root) == 0 and live_tables(spark, root) == {}
    a, b = spark.range(5), spark.range(7)
    assert refresh(spark, root, {"a": a, "b": b}) == 1
    with pytest.raises(Exception, match="half way"):
        refresh(spark, root, {"a": spark.range(100), "b": broken(spark.range(100))})
    assert live_version(spark, root) == 1
    assert [read_live(spark, root, n, a.schema).count() for n in "ab"] == [5, 7]
    assert all(len(os.listdir(f"{root}/{n}")) == 1 for n in "ab")
    assert refresh(spark, root, {"a": spark.range(2)}) == 2
    assert [read_live(spark, root, n, a.schema).count() for n in "ab"] == [2, 7]


def test_old_folders_go_after_a_stated_number(spark, tmp_path):
    root = str(tmp_path / "house")
    paths = []
    for n in range(1, 6):
        assert refresh(spark, root, {"a": spark.range(n), **({"b": spark.range(9)} if n == 1 else {})}, keep=3) == n
        paths.append(live_tables(spark, root)["a"])
        assert [os.path.exists(p) for p in paths] == [i >= n - 3 for i in range(n)]
    assert read_live(spark, root, "b", spark.range(1).schema).count() == 9


def test_nothing_is_seen_before_the_manifest(spark, tmp_path):
    root = str(tmp_path / "house")
    refresh(spark, root, {"a": spark.range(3)})
    load = Load(spark, root)
    assert load.stage("a", spark.range(8)).count() == 8
    assert read_live(spark, root, "a", spark.range(1).schema).count() == 3
    load.abandon()
    assert len(os.listdir(f"{root}/a")) == 1


def test_warehouse_build_is_all_or_nothing(spark, tmp_path):
    house = gold.Warehouse(spark, str(tmp_path / "house"))
    items = spark.range(3).select(
        F.col("id").alias("item_id"), F.lit("n").alias("item_name"), F.lit("c").alias("category"), F.col("id")
    )
    house.load(specs.DIM_ITEM, items, "item_id")
    shares = spark.range(4).select(F.col("id"), F.lit("x").alias("item"))
    worse = broken(shares).withColumn("item", F.col("id").cast("string"))
    with pytest.raises(Exception, match="half way"):
        house.build({specs.DIM_ITEM: items.limit(1), specs.FACT_SHARES: worse}, AT, {"dim_item": "item_id"})
    assert house.table(specs.DIM_ITEM).count() == 3
    with pytest.raises(KeyError):
        house.table(specs.FACT_SHARES)


SCHEMA = "k int, part string, v int, note string"


def stored(path):
    """Bucket folder -> its files."""
    return {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if d.startswith("bucket")}


def test_a_batch_rewrites_only_its_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(i, "p", i, "old") for i in range(2_000)], SCHEMA)
    assert upsert_buckets(first, path, ["k", "part"], "v", 32) == list(range(32))
    before = stored(path)
    batch = spark.createDataFrame([(i, "p", j, "new") for i in range(500, 520) for j in (1, 9, 4)], SCHEMA)
    hit = upsert_buckets(batch, path, ["k", "part"], "v", 32)
    after = stored(path)
    assert 0 < len(hit) <= 20 and set(before) == set(after)
    assert {d for d in after if after[d] != before[d]} == {f"bucket_of_32={b}" for b in hit}
    want = upsert_latest(first, batch, ["k", "part"], "v")
    got = read_buckets(spark, path, first.schema, 32).select(first.columns)
    assert rows(got, "k") == rows(want, "k")
    assert upsert_buckets(batch.limit(0), path, ["k", "part"], "v", 32) == []


def test_null_keys_are_one_key(spark, tmp_path):
    path = str(tmp_path / "t")
    for v in (3, 1):
        upsert_buckets(spark.createDataFrame([(None, None, v, "x")], SCHEMA), path, ["k", "part"], "v", 4)
    assert rows(read_buckets(spark, path, spark.createDataFrame([], SCHEMA).schema, 4).select("v")) == [(1,)]


SPEC = TableSpec(
    "t", (Col("k", "int", not_null=True), Col("f", "int", domain=(0, 1)), Col("a", "string")),
    unique=(("k",), ("a", "f")),
)


def test_rows_that_break_a_constraint_are_held_back(spark, tmp_path):
    df = spark.createDataFrame(
        [
            (1, 0, "a", 1), (1, 1, "b", 2), (1, 7, "c", 0), (None, 2, "d", 3), (2, 0, "a", 4), (3, None, "a", 5),
            (4, None, "a", 6), (5, 1, "e", 7), (5, 1, "e", 7), (6, 0, None, 8), (7, 0, None, 9),
        ],
        "k int, f int, a string, at int",
    )
    split = quality.load_with_quarantine(
        df, SPEC, [F.col("at")], str(tmp_path / "good"), str(tmp_path / "bad")
    )
    assert split["table"].schema == df.schema
    assert rows(split["table"], "at") == [
        (1, 0, "a", 1), (3, None, "a", 5), (4, None, "a", 6), (5, 1, "e", 7), (6, 0, None, 8), (7, 0, None, 9),
    ]
    assert rows(split["quarantine"].select("at", "broken_rules"), "at") == [
        (0, ["CHECK f IN (0,1)"]), (2, ["UNIQUE k"]), (3, ["NOT NULL k", "CHECK f IN (0,1)"]), (4, ["UNIQUE a, f"]),
        (7, ["UNIQUE k"]),
    ]
    kept = quality.constraint_check(split["table"], TableSpec("t", SPEC.columns, unique=(("k",),)))
    assert kept.filter("violations > 0").count() == 0


def test_a_hot_key_is_held_back_whole(spark, tmp_path):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("int").alias("k"),
        F.lit(1).alias("f"), F.col("id").cast("string").alias("a"), "id",
    )
    split = quality.load_with_quarantine(df, SPEC, [F.col("id")], str(tmp_path / "good"), str(tmp_path / "bad"))
    assert (split["table"].count(), split["quarantine"].count()) == (13_334, 6_666)


KEYS, SUMS = ["item", "year", "month"], ["cases"]
TREND = "item string, cases long, year int, month int"


def test_a_batch_is_merged_once(spark, tmp_path):
    path = str(tmp_path / "trend")
    one = spark.createDataFrame([("a", 1, 2026, 1), ("b", 2, 2026, 1), ("a", 3, 2026, 2)], TREND)
    late = spark.createDataFrame([("a", 10, 2026, 1), (None, 5, 2025, 12)], TREND)
    for batch, df in (("1", one), ("1", one), ("2", late), ("1", one), ("2", late)):
        trend = volumes.merge_batch(df, batch, path, KEYS, SUMS)
    want = volumes.merge_months(one, late.select(one.columns), KEYS, SUMS)
    assert sorted(rows(trend.select(*KEYS, *SUMS)), key=str) == sorted(rows(want.select(*KEYS, *SUMS)), key=str)
    assert rows(trend.select("year", "month", "batches").distinct(), "year", "month") == [
        (2025, 12, ["2"]), (2026, 1, ["1", "2"]), (2026, 2, ["1"]),
    ]


def test_a_late_batch_touches_only_its_months(spark, tmp_path):
    path = str(tmp_path / "trend")
    whole = spark.createDataFrame([("a", m, 2026, m) for m in range(1, 13)], TREND)
    volumes.merge_batch(whole, "1", path, KEYS, SUMS)
    files = lambda: {
        m: sorted(os.listdir(f"{path}/year=2026/month={m}")) for m in range(1, 13)
    }
    before = files()
    trend = volumes.merge_batch(spark.createDataFrame([("b", 7, 2026, 5)], TREND), "2", path, KEYS, SUMS)
    after = files()
    assert [m for m in before if before[m] != after[m]] == [5]
    assert trend.agg(F.sum("cases")).first()[0] == 78 + 7
    # A batch that failed after some of its months is finished by the next try.
    again = spark.createDataFrame([("b", 7, 2026, 5), ("b", 1, 2026, 6)], TREND)
    assert volumes.merge_batch(again, "2", path, KEYS, SUMS).agg(F.sum("cases")).first()[0] == 78 + 8


def test_a_repeated_run_leaves_one_row_per_table(spark, tmp_path):
    path = str(tmp_path / "log")
    report = quality.dq_checks(spark.createDataFrame([("a",)], "k string"), "t", ["k"], [], AT)
    other = quality.dq_checks(spark.createDataFrame([], "k string"), "u", ["k"], [], AT)
    for run in ("1", "2", "1"):
        own = quality.log_run(quality.dq_summary(report), path, run)
        assert rows(own.select("table_name", "total_rows", "run")) == [("t", 1, run)]
        quality.log_run(quality.dq_summary(other), path, run)
    assert rows(quality.read_log(spark, path).select("run", "table_name"), "run", "table_name") == [
        ("1", "t"), ("1", "u"), ("2", "t"), ("2", "u"),
    ]


def test_checks_that_fail_stop_no_other(spark, tmp_path):
    checks = {
        "rows": "SELECT id, nullif(id, 1) AS n FROM range(3) ORDER BY id",
        "no table": "SELECT * FROM nowhere",
        "fails when run": "SELECT CAST(concat('x', id) AS INT) AS n FROM range(3)",
        "syntax": "SELEC 1",
        "nothing": "SELECT id FROM range(3) WHERE id > 5",
        "raised": "SELECT if(id = 2, raise_error('stop'), id) FROM range(4)",
        "last": "SELECT count(*) AS n FROM range(250)",
    }
    report = quality.run_checks(spark, checks, str(tmp_path / "report"))
    got = report.orderBy("label", "nth").collect()
    assert {r["label"] for r in got} == set(checks)
    assert [r["record"] for r in got if r["label"] == "rows"] == [
        '{"id":0,"n":0}', '{"id":1,"n":null}', '{"id":2,"n":2}',
    ]
    assert [r["record"] for r in got if r["label"] == "last"] == ['{"n":250}']
    assert [(r["nth"], r["record"], r["error"]) for r in got if r["label"] == "nothing"] == [(None, None, None)]
    errors = {r["label"]: r["error"] for r in got if r["error"]}
    assert set(errors) == {"no table", "fails when run", "syntax", "raised"}
    assert "nowhere" in errors["no table"] and "stop" in errors["raised"]


def test_a_run_can_be_cleaned(spark):
    from martwright.session import clean_run, fresh_path, run_folder, written

    kept = written(spark.range(4), "some-step")
    assert kept.count() == 4 and fresh_path(spark, "x").startswith(run_folder(spark))
    folder = run_folder(spark).removeprefix("file:")
    assert os.path.isdir(folder)
    clean_run(spark)
    assert not os.path.exists(folder)
