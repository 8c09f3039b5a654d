import random

import pytest
from pyspark.sql import types as T

from martwright.sources import csv_records, read_csv, read_csv_splits

SCHEMA = (
    T.StructType().add("id", T.LongType()).add("text", T.StringType()).add("other", T.StringType())
)
HEADER = "id,text,other\n"


@pytest.fixture
def small_splits(spark):
    """Splits of some hundred bytes."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], "400")
    spark.conf.set(names[1], "0")
    yield
    for name, value in zip(names, before, strict=True):
        spark.conf.set(name, value)


def quoted(value):
    return '"' + value.replace('"', '""') + '"'


def some_file(seed, records, pieces):
    rng = random.Random(seed)
    out = [HEADER]
    for i in range(records):
        text = "".join(rng.choices(pieces, k=rng.randrange(12)))
        out.append(f"{i},{quoted(text)},{rng.choice(['plain', '', quoted('a,b'), quoted('')])}\n")
    return "".join(out)


def check(spark, path):
    got = read_csv_splits(spark, str(path), SCHEMA)
    want = read_csv(spark, str(path), SCHEMA, multiline=True)
    assert got.schema == want.schema
    key = lambda r: (r[0] is None, r[0], str(r))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
    return got


PIECES = ["a", "\n", '"', ",", "word ", "\r\n", '""', "é", "\n\n", "x" * 30]


def test_rows_are_those_of_one_task_a_file(spark, tmp_path, small_splits):
    for seed in range(6):
        path = tmp_path / f"{seed}.csv"
        path.write_bytes(some_file(seed, 250, PIECES).encode())
        check(spark, path)
    check(spark, tmp_path)


def test_every_split_is_a_task(spark, tmp_path, small_splits):
    path = tmp_path / "in.csv"
    path.write_bytes(some_file(7, 900, PIECES).encode())
    scan = spark.read.option("lineSep", "\n").text(str(path))
    assert scan.rdd.getNumPartitions() >= 64
    check(spark, path)


def test_records_over_many_splits(spark, tmp_path, small_splits):
    long = "line, \"quoted\"\n" * 400
    path = tmp_path / "in.csv"
    path.write_text(HEADER + f"1,{quoted(long)},x\n2,b,{quoted(long)}\n" + "3,c,d\n" * 200, "utf-8", newline="")
    got = check(spark, path)
    assert {r["id"]: len(r["text"]) for r in got.filter("id < 3").collect()} == {1: len(long), 2: 1}


@pytest.mark.parametrize(
    "content",
    [
        "id,text,other", HEADER, "﻿" + HEADER + "1,a,b\n", HEADER + "1,a,b", HEADER + "\n\n1,a,b\n\n2,c,d\n",
        HEADER.replace("\n", "\r\n") + '1,"a\nb",c\r\n2,,N/A\r\n', HEADER + '1,"open\nrest,x\n2,b,c',
        HEADER + "x,null,\n", '"id","text","other"\n1,"",""""\n',
    ],
)
def test_odd_files(spark, tmp_path, content):
    path = tmp_path / "in.csv"
    path.write_bytes(content.encode())
    check(spark, path)


def test_carriage_returns_stay_in_fields(spark, tmp_path):
    """Reading in one task makes line feeds of them where the lines of the file end so."""
    path = tmp_path / "in.csv"
    path.write_bytes(HEADER.replace("\n", "\r\n").encode() + b'1,"a\r\nb","\r"\r\n')
    assert read_csv_splits(spark, str(path), SCHEMA).collect() == [(1, "a\r\nb", "\r")]


def test_another_header_fails(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text(HEADER + "1,a,b\n" * 300, "utf-8")
    (tmp_path / "b.csv").write_text("id,words,other\n1,a,b\n", "utf-8")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_splits(spark, str(tmp_path), SCHEMA).collect()


def test_records_keep_their_text(spark, tmp_path, small_splits):
    records = [HEADER[:-1], *(f'{i},"{"a" * (i % 50)}\n""{i}""",z' for i in range(200))]
    path = tmp_path / "in.csv"
    path.write_text("\n".join(records) + "\n", "utf-8", newline="")
    got = csv_records(spark, str(path)).collect()
    assert sorted(r["record"] for r in got) == sorted(records)
    assert [r["record"] for r in got if r["first"]] == records[:1]
