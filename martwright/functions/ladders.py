"""Classification rules: the first rule that holds gives the label."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from martwright.functions.text import column


def _first_match(rules: Iterable[tuple[Column, str]], default: str | None) -> Column:
    case = F
    for condition, label in rules:
        case = case.when(condition, F.lit(label))
    return case.otherwise(F.lit(default))


def keyword_ladder(
    c: Column | str, rules: Sequence[tuple[str, Sequence[str]]], default: str
) -> Column:
    """The first rule with a keyword anywhere in the lower-cased text, even inside a word."""
    text = F.lower(column(c))
    return _first_match(
        ((text.rlike("|".join(rf"\Q{word}\E" for word in words)), label) for label, words in rules),
        default,
    )


def threshold_ladder(
    c: Column | str, cuts: Sequence[tuple[float, str]], default: str
) -> Column:
    """The first cut the value reaches, highest first; null falls through to the default."""
    return _first_match(((column(c) >= F.lit(cut), label) for cut, label in cuts), default)


def set_ladder(c: Column | str, sets: Mapping[str, Sequence[str]], default: str) -> Column:
    """The first named set that holds the value."""
    return _first_match(
        ((in_set(c, members), label) for label, members in sets.items()), default
    )


def in_set(c: Column | str, members: Sequence) -> Column:
    """True when the value is one of the members; null counts as no."""
    return F.coalesce(column(c).isin(list(members)), F.lit(False))


def flag_label(c: Column | str, yes: str, no: str) -> Column:
    """A label for a 0/1 or boolean flag; null counts as no."""
    return F.when(column(c).cast("int") == 1, F.lit(yes)).otherwise(F.lit(no))
