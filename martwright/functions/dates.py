"""Dates, months and the month calendar."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.functions.text import column


def time_literal(at: dt.datetime | None) -> Column:
    """A point in time as `timestamp_ntz`, in UTC if it knows its zone.

    Made from text, since a timestamp literal would depend on the session's time zone.
    """
    if at is not None and at.tzinfo is not None:
        at = at.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(at.isoformat() if at is not None else None).cast("timestamp_ntz")


def to_date_lenient(c: Column | str, default: dt.date | Column | None = None) -> Column:
    """Text as a date, `default` when it is not one."""
    parsed = column(c).try_cast("date")
    if default is None:
        return parsed
    return F.coalesce(parsed, default if isinstance(default, Column) else F.lit(default))


def month_parts(ts: Column | str) -> dict[str, Column]:
    """Year, month and label (`Jan 2026`) of a date or timestamp."""
    ts = column(ts)
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "month_label": F.date_format(ts, "MMM yyyy"),
    }


def month_spine(as_of: DataFrame, col: str, months: int = 12) -> DataFrame:
    """The `months` months that end with the month of the one date in `as_of`.

    One row per month (`month_start`, `year`, `month`, `month_label`), whether or
    not anything happened in it.
    """
    last = F.trunc(F.col(col).cast("date"), "month")
    starts = F.sequence(F.add_months(last, 1 - months), last, F.expr("interval 1 month"))
    spine = as_of.select(F.explode(starts).alias("month_start"))
    return spine.withColumns(month_parts("month_start"))


def first_month(as_of: Column, months: int = 12) -> Column:
    """First day of the `months` months that end with the month of a date."""
    return F.add_months(F.trunc(as_of.cast("date"), "month"), 1 - months)
