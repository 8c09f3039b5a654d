"""Data-quality checks. A failed check is a row in a report; nothing stops."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright import fixed
from martwright.functions.dates import time_literal
from martwright.operators.dedupe import duplicate_count, one_per_key
from martwright.session import written
from martwright.sources.specs import DQ_LOG, TableSpec


MORE = "%s: %s rows"


def _blank(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return c.isNull() | (c == "")
    if isinstance(kind, T.DoubleType | T.FloatType):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def _message(template: str, *values: Column) -> Column:
    pieces = template.split("%s")
    out = [F.lit(pieces[0].replace("%%", "%"))]
    for value, piece in zip(values, pieces[1:], strict=True):
        out += [value.cast("string"), F.lit(piece.replace("%%", "%"))]
    return F.concat(*out)


def dq_checks(
    df: DataFrame,
    table: str,
    required: Sequence[str],
    unique: Sequence[str] = (),
    checked_at: dt.datetime | None = None,
) -> DataFrame:
    """One row per check: not empty, columns present, no blanks, no repeated keys.

    A single aggregation over the table answers all of them.
    """
    keys = [c for c in unique if c in df.columns]
    counts = [F.count(F.lit(1)).alias("_rows"), *blank_counts(df, required).values()]
    if keys:
        counts.append(duplicate_count(keys).alias("_repeats"))
    return checks_of_counts(df.agg(*counts), df.columns, table, required, keys, checked_at)


def blank_counts(df: DataFrame, required: Sequence[str]) -> dict[str, Column]:
    """Column -> aggregate that counts its blanks, named as `checks_of_counts` expects it."""
    present = [c for c in required if c in df.columns]
    return {
        c: F.count_if(_blank(df, c)).alias(f"_blank_{i}") for i, c in enumerate(present)
    }


def checks_of_counts(
    found: DataFrame,
    columns: Sequence[str],
    table: str,
    required: Sequence[str],
    keys: Sequence[str],
    checked_at: dt.datetime | None,
    more: Sequence[tuple[str, str]] = (),
) -> DataFrame:
    """One row per check from one row of counts: `_rows`, `_blank_0` and on, `_repeats` if there are
    `keys`. Each of `more` is a count that should be 0, by column, and its name in the message."""
    present = [c for c in required if c in columns]
    missing = [c for c in required if c not in columns]
    rows = F.col("_rows")
    checks = [
        (rows > 0, F.when(rows > 0, _message(fixed.DQ_ROWS, rows)).otherwise(fixed.DQ_EMPTY)),
        (
            F.lit(not missing),
            _message(fixed.DQ_MISSING, F.lit(str(missing)))
            if missing
            else _message(fixed.DQ_PRESENT, F.lit(len(required))),
        ),
    ]
    for i, name in enumerate(present):
        blanks = F.col(f"_blank_{i}")
        share = F.round(blanks * F.lit(100.0) / F.nullif(rows, F.lit(0)), 1)
        bad = _message(fixed.DQ_NULLS, F.lit(name), blanks, share)
        good = _message(fixed.DQ_NO_NULLS, F.lit(name))
        checks.append((blanks == 0, F.when(blanks > 0, bad).otherwise(good)))
    if keys:
        repeats = F.col("_repeats")
        bad = _message(fixed.DQ_DUPLICATES, repeats, F.lit(str(list(keys))))
        good = _message(fixed.DQ_NO_DUPLICATES, F.lit(str(list(keys))))
        checks.append((repeats == 0, F.when(repeats > 0, bad).otherwise(good)))
    for column, name in more:
        message = _message(MORE, F.lit(name), F.col(column))
        checks.append((F.col(column) == 0, message))
    records = F.array(
        *(
            F.struct(
                F.lit(number).cast("int").alias("check_no"),
                passed.alias("passed"),
                message.alias("message"),
            )
            for number, (passed, message) in enumerate(checks, 1)
        )
    )
    return found.select(
        F.lit(table).alias("table_name"),
        time_literal(checked_at).alias("checked_at"),
        rows.alias("total_rows"),
        F.inline(records),
    )


def dq_summary(report: DataFrame) -> DataFrame:
    """Per table: rows, checks passed and failed, and the failure messages in check order.

    A table has as many report rows as checks, so the lists are short.
    """
    failed = F.array_sort(
        F.collect_list(F.when(~F.col("passed"), F.struct("check_no", "message")))
    )
    return report.groupBy("table_name", "checked_at").agg(
        F.max("total_rows").alias("total_rows"),
        F.count_if("passed").alias("checks_passed"),
        F.count_if(~F.col("passed")).alias("checks_failed"),
        F.transform(failed, lambda issue: issue["message"]).alias("issues"),
    )


def log_run(summary: DataFrame, path: str, run: str) -> DataFrame:
    """Put the summaries of a run into the log and return them as logged.

    The log is partitioned by run and table and only these partitions are overwritten, so a run
    that is repeated leaves one row per table.
    """
    logged = summary.withColumn("run", F.lit(run))
    write = logged.write.partitionBy("run", "table_name").mode("overwrite")
    write.option("partitionOverwriteMode", "dynamic").parquet(path)
    tables = [r[0] for r in summary.select("table_name").distinct().collect()]  # one per table
    whole = read_log(summary.sparkSession, path)
    return whole.filter((F.col("run") == run) & F.col("table_name").isin(tables))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the log, with their run."""
    schema = DQ_LOG.schema().add("run", "string")
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def append_dq_log(summary: DataFrame, path: str) -> None:
    """Add summaries to the log table, issues as an array of texts."""
    summary.write.mode("append").parquet(path)


def constraint_check(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per declared constraint of a table with the number of rows that break it.

    All NOT NULL and CHECK rules share one aggregation; each UNIQUE key is counted
    on its own key columns.
    """
    rules = []
    for c in spec.columns:
        if c.not_null:
            rules.append((f"NOT NULL {c.name}", F.count_if(F.col(c.name).isNull())))
        if c.domain:
            outside = F.col(c.name).isNotNull() & ~F.col(c.name).isin(list(c.domain))
            values = ",".join(str(v) for v in c.domain)
            rules.append((f"CHECK {c.name} IN ({values})", F.count_if(outside)))
    parts = []
    if rules:
        parts.append(_rule_rows(df, spec.name, rules))
    for keys in spec.unique:
        rule = [(f"UNIQUE {', '.join(keys)}", duplicate_count(list(keys)))]
        parts.append(_rule_rows(df, spec.name, rule))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def mark_broken(df: DataFrame, spec: TableSpec, order: Sequence[Column], name: str) -> DataFrame:
    """The rows with `broken_rules`, the declared constraints that each of them breaks.

    Of the rows of a unique key that break no rule before it, the first by `order` does not break it
    either; key columns that are null never repeat. The rows are written to the shared folder once (`name`), so
    that a row keeps its number; the first rows of a key are found by a group limit, which sends at
    most one row per key and task, however hot the key.
    """
    broken = []
    for c in spec.columns:
        if c.not_null:
            broken.append((f"NOT NULL {c.name}", F.col(c.name).isNull()))
        if c.domain:
            values = ",".join(str(v) for v in c.domain)
            outside = F.col(c.name).isNotNull() & ~F.col(c.name).isin(list(c.domain))
            broken.append((f"CHECK {c.name} IN ({values})", outside))
    rules = F.array(*(F.when(bad, F.lit(rule)) for rule, bad in broken)).cast("array<string>")
    marked = written(
        df.withColumn("broken_rules", F.array_compact(rules)).withColumn(
            "_row", F.monotonically_increasing_id()
        ),
        name,
    )
    for keys in spec.unique:
        held = F.lit(True)
        for key in keys:
            held = held & F.col(key).isNotNull()
        # Null keys and rows that are out already take no part.
        rival = held & (F.size("broken_rules") == 0)
        first = one_per_key(marked.filter(rival), list(keys), [*order, F.col("_row")])
        first = first.select("_row", F.lit(True).alias("_first"))
        repeats = F.array(F.lit(f"UNIQUE {', '.join(keys)}"))
        marked = marked.join(first, "_row", "left").withColumn(
            "broken_rules",
            F.when(rival & F.col("_first").isNull(), F.concat("broken_rules", repeats)).otherwise(
                F.col("broken_rules")
            ),
        ).drop("_first")
    return marked.drop("_row")


def load_with_quarantine(
    df: DataFrame, spec: TableSpec, order: Sequence[Column], table_path: str, quarantine_path: str
) -> dict[str, DataFrame]:
    """Split rows into a table, of those that break no declared constraint, and a quarantine, of
    the others with the rules they break. Each row is in one of the two."""
    marked = written(mark_broken(df, spec, order, "constraints"), "marked")
    sound = F.size("broken_rules") == 0
    marked.filter(sound).drop("broken_rules").write.mode("overwrite").parquet(table_path)
    marked.filter(~sound).write.mode("overwrite").parquet(quarantine_path)
    read = df.sparkSession.read
    return {
        "table": read.schema(df.schema).parquet(table_path),
        "quarantine": read.schema(marked.schema).parquet(quarantine_path),
    }


def _rule_rows(df: DataFrame, table: str, rules: list[tuple[str, Column]]) -> DataFrame:
    row = df.agg(*(count.alias(f"_{i}") for i, (_, count) in enumerate(rules)))
    records = F.array(
        *(
            F.struct(F.lit(rule).alias("rule"), F.col(f"_{i}").alias("violations"))
            for i, (rule, _) in enumerate(rules)
        )
    )
    return row.select(F.lit(table).alias("table_name"), F.inline(records))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table; a count reads no column."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


READ_OUT = "label string, nth long, record string, error string"


def run_checks(spark: SparkSession, checks: dict[str, str], path: str, at_once: int = 4) -> DataFrame:
    """Run named SQL checks and report all their rows, and what went wrong, in one table.

    (label, nth, record, error): each row of a result as JSON, with a number that keeps their order
    (from 0, consecutive within a partition); one row with the error for a check that cannot be
    planned or fails while it runs; one row of nulls for a result without rows. A check that fails stops no other; what it wrote is not kept. Up to
    `at_once` checks run beside each other. The table at `path` is replaced.
    """

    def run(item: tuple[int, tuple[str, str]]) -> DataFrame:
        number, (label, sql) = item
        where = f"{path.rstrip('/')}/check={number}"
        try:
            result = spark.sql(sql)
            rows = result.select(
                F.monotonically_increasing_id().alias("nth"),
                F.to_json(F.struct(*(F.col(f"`{c}`") for c in result.columns)), _NULLS).alias("record"),
            )
            rows.write.mode("overwrite").parquet(where)
            return _read_out(spark.read.schema("nth long, record string").parquet(where), label)
        except (PySparkException, Py4JError) as error:
            text = str(error).split("\n\nJVM stacktrace")[0][:_ERROR_CHARS]
            return spark.createDataFrame([(label, None, None, text)], READ_OUT)

    with ThreadPoolExecutor(at_once) as pool:
        parts = list(pool.map(run, enumerate(checks.items())))
    whole = spark.createDataFrame([], READ_OUT)
    for part in parts:
        whole = whole.unionByName(part)
    return whole


_NULLS = {"ignoreNullFields": "false"}
_ERROR_CHARS = 2_000  # of the message of a check that failed


def _read_out(rows: DataFrame, label: str) -> DataFrame:
    if rows.isEmpty():
        return rows.sparkSession.createDataFrame([(label, None, None, None)], READ_OUT)
    return rows.select(
        F.lit(label).alias("label"), "nth", "record", F.lit(None).cast("string").alias("error")
    )


def validate(spark: SparkSession, checks: dict[str, str]) -> dict[str, DataFrame | str]:
    """The result of each named SQL check as a DataFrame; the error text of one that is wrong.

    Nothing is run or cut here: a check that should give a few rows says so in its SQL.
    """
    results: dict[str, DataFrame | str] = {}
    for label, sql in checks.items():
        try:
            results[label] = spark.sql(sql)
        except AnalysisException as error:
            results[label] = str(error)
    return results
