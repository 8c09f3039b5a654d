import json

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.sources import (
    Col,
    TableSpec,
    append_rows,
    export_all,
    extract_cards,
    list_tables,
    literal_table,
    load_table,
    mine_title_lines,
    query,
    read_csv,
    read_optional,
    register_views,
    to_json_records,
    with_fallback,
    write_csv,
)

SCHEMA = (
    T.StructType()
    .add("id", T.LongType())
    .add("text", T.StringType())
    .add("ok", T.BooleanType())
    .add("n", T.DoubleType())
)


def test_csv_scan(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('id,text,ok,n\n1,"two\nlines, ""quoted""",True,1.5\nx,N/A,,null\n', "utf-8")
    assert rows(read_csv(spark, str(path), SCHEMA, multiline=True)) == [
        (1, 'two\nlines, "quoted"', True, 1.5), (None, None, None, None),
    ]


def test_csv_with_another_header_fails(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("id,words,ok,n\n1,a,true,1\n", "utf-8")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(path), SCHEMA, multiline=False).collect()


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b"\nc', True, 0.5)], SCHEMA)
    write_csv(df, str(tmp_path / "out"))
    assert rows(read_csv(spark, str(tmp_path / "out"), SCHEMA, multiline=True)) == rows(df)


def test_optional(spark, tmp_path):
    for fmt in ("parquet", "csv"):
        empty = read_optional(spark, str(tmp_path / "none"), SCHEMA, fmt)
        assert (empty.count(), empty.schema) == (0, SCHEMA)


def test_fallback(spark):
    few, other = spark.range(2), spark.range(10, 13)

    def broken():
        raise OSError("no network")

    assert with_fallback(lambda: few, other, 2).count() == 2
    assert with_fallback(lambda: few, other, 3).count() == 3
    assert with_fallback(broken, other, 1).count() == 3


def test_literal_query_catalog(spark):
    df = literal_table(spark, ["a", "b"], [(1, "x"), (2, "y")])
    failed = register_views(
        spark, {"zz_two": lambda: df, "zz_bad": lambda: spark.table("nowhere_at_all")}
    )
    assert list(failed) == ["zz_bad"]
    assert rows(query(spark, "SELECT b FROM zz_two WHERE a = 2")) == [("y",)]
    assert rows(query(spark, "SELECT max(a) FROM {t}", t=df)) == [(2,)]
    assert ("zz_two",) in rows(list_tables(spark, "view"))
    assert ("zz_two",) not in rows(list_tables(spark, "table"))


SPEC = TableSpec(
    "t", (Col("k", "bigint"), Col("f", "int", default=0), Col("note", "string")), unique=(("k",),)
)


def test_load_replaces_casts_and_fills(spark, tmp_path):
    path = str(tmp_path / "t")
    load_table(spark.createDataFrame([(9, True, 1)], "k int, f boolean, n int"), SPEC, path)
    df = spark.createDataFrame([(1, None, 1), (1, True, 2)], "k int, f boolean, n int")
    assert rows(load_table(df, SPEC, path, order="n")) == [(1, 1, None)]
    assert rows(load_table(df, SPEC, path), "f") == [(1, 0, None), (1, 1, None)]
    append_rows(df.limit(1), SPEC, path)
    assert spark.read.parquet(path).count() == 3


def test_export_counts_during_the_write(spark, tmp_path):
    spark.range(5).createOrReplaceTempView("five")
    assert export_all(spark, ["five"], str(tmp_path)) == {"five": 5}
    assert spark.read.option("header", True).csv(str(tmp_path / "five")).count() == 5


def test_json_records(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert json.loads(to_json_records(df).first()[0]) == {"a": 1, "b": None}


def test_cards(spark):
    html = (
        "<ul><li><h2>One <b>&amp; only</b></h2><p>First</p><a href='#' href=\"/x?a=1&amp;b=2\">go</a></li>"
        "<li><h3>  </h3><p>lost</p></li><li><h3>Two</h3><em class=\"tag\">T</em></li></ul>"
    )
    pages = spark.createDataFrame([("u", html), ("v", None)], "url string, html string")
    cards = extract_cards(
        pages, "html", ["url"], r"(?s)<li>(.*?)</li>",
        {"name": r"(?s)<h[23]>(.*?)</h[23]>", "tag": r'<em class="tag">(.*?)</em>',
         "text": r"<p>(.*?)</p>", "link": r'href="([^"]*)"'},
        {"tag": "Unknown", "text": "", "link": F.col("url")}, required=["name"],
    )
    assert rows(cards, "card_no") == [
        ("u", 1, "One& only", "Unknown", "First", "/x?a=1&b=2"), ("u", 3, "Two", "T", "", "u"),
    ]


def test_cards_decode_all_references(spark):
    html = "<li><h2>Caf&eacute; &ndash; d&#233;j&agrave; &#x27;vu&#x27; &hellip;</h2></li><li><h2>A &amp;eacute; B</h2></li>"
    pages = spark.createDataFrame([("u", html)], "url string, html string")
    cards = extract_cards(pages, "html", ["url"], r"<li>(.*?)</li>", {"name": r"<h2>(.*?)</h2>"}, {})
    assert rows(cards, "card_no") == [("u", 1, "Café – déjà 'vu' …"), ("u", 2, "A &eacute; B")]


def test_title_lines(spark):
    text = "Data Analyst One\nData Analyst Two\nData Engineer Three\nshort\nFinance Person Four"
    docs = spark.createDataFrame(
        [(2, "u2", text), (1, "u1", "x\nData Engineer Three\n")], "id int, url string, text string"
    )
    found = mine_title_lines(docs, "text", "id", "url")
    assert rows(found.select("title", "doc_id"), "title") == [
        ("Data Analyst One", 2), ("Data Engineer Three", 1),
    ]
