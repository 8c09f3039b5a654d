"""Column expressions on numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martwright.functions.text import column, strip

# Plain decimal notation; keeps out the suffixes and words that a cast would let through.
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def to_number(c: Column | str, fill: float | None = None, as_int: bool = False) -> Column:
    """Text as a number, null (or `fill`) when it is not one; `as_int` drops the fraction."""
    text = strip(column(c).cast("string"))
    number = F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))
    if fill is not None:
        number = F.coalesce(number, F.lit(float(fill)))
    return number.try_cast("bigint") if as_int else number


def pct(part: Column | str, whole: Column | str, places: int = 1) -> Column:
    """`part` as a rounded percentage of `whole`, null when `whole` is 0."""
    hundredfold = column(part).cast("double") * F.lit(100.0)
    return F.round(hundredfold / F.nullif(column(whole).cast("double"), F.lit(0.0)), places)


def split_shares(c: Column | str, shares: dict[str, float]) -> dict[str, Column]:
    """A quantity cut into fixed shares, each truncated; the shares need not add up."""
    return {
        name: (column(c).cast("double") * F.lit(share)).cast("bigint")
        for name, share in shares.items()
    }
