"""Shares of a total, ranked picks and the lists that go with grouped rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.functions.numbers import pct

# Ids covered by one part of a joined list.
LIST_WIDTH = 100_000


def row_total(df: DataFrame) -> Column:
    """The row count of a table as a scalar subquery; reads no column."""
    return df.agg(F.count(F.lit(1))).scalar()


def share_of_total(df: DataFrame, keys: list[str], count: str, share: str) -> DataFrame:
    """Rows per group and their percentage of the whole table.

    The total is a scalar subquery, so no window gathers the groups in one task.
    """
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias(count))
        .withColumn(share, pct(count, row_total(df)))
    )


def flag_pct(df: DataFrame, flag: str, share: str, count: str) -> DataFrame:
    """The percentage of rows with a flag set, and the row count."""
    rows = F.count(F.lit(1))
    return df.agg(pct(F.sum(F.col(flag).cast("int")), rows).alias(share), rows.alias(count))


def top_k(df: DataFrame, measure: str, k: int, tiebreak: str) -> DataFrame:
    """The k rows with the highest measure; each task keeps k rows, nothing is sorted whole."""
    return df.orderBy(F.desc(measure), F.asc(tiebreak)).limit(k)


def joined_lists(
    df: DataFrame,
    keys: list[str],
    value: Column | str,
    order: str,
    sep: str,
    out: str,
    width: int = LIST_WIDTH,
) -> DataFrame:
    """The values of a group joined in `order` (a unique integer), nulls left out.

    A group may hold a third of all rows, so its list comes in parts: one row per
    group and range of `width` ids, numbered by `list_part`. Joining a group's
    parts in that order with `sep` gives its whole list; a group within one range
    has its whole list in one row. A part without values is null.
    """
    value = F.col(value) if isinstance(value, str) else value
    escaped = sep.replace("\\", "\\\\").replace("'", "\\'")
    return (
        df.select(*keys, value.alias("_value"), F.col(order).alias("_order"))
        .groupBy(*keys, F.expr(f"_order div {width}").alias("list_part"))
        .agg(F.expr(f"listagg(_value, '{escaped}') within group (order by _order)").alias(out))
    )

