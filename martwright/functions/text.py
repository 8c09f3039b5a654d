"""Column expressions on text. All of them stay inside generated JVM code."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space at the ends of a text (Unicode, not only ASCII).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(code) for code in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)
# The same characters as a regex class.
WHITESPACE_CLASS = r"[\s\p{Z}\x1c-\x1f\x85]"


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without leading and trailing white space of any kind; linear in the text."""
    return F.trim(column(c), F.lit(WHITESPACE))


def title_case(c: Column | str) -> Column:
    """Each run of letters starts upper case and goes on lower case (`it's` -> `It'S`)."""
    runs = F.regexp_extract_all(F.lower(column(c)), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    capital = F.transform(
        runs, lambda run: F.concat(F.upper(F.left(run, F.lit(1))), F.substr(run, F.lit(2)))
    )
    return F.array_join(capital, "")


def clip(c: Column | str, chars: int) -> Column:
    """The first `chars` characters, then stripped."""
    return strip(F.substring(column(c), 1, chars))


def has_text(c: Column | str, min_chars: int) -> Column:
    """True when the text is present and longer than `min_chars`."""
    return F.coalesce(F.length(column(c)) > min_chars, F.lit(False))


def fill(c: Column | str, value) -> Column:
    """The value, or a constant (or column) where it is null."""
    return F.coalesce(column(c), value if isinstance(value, Column) else F.lit(value))


def extract_code(c: Column | str, pattern: str, group: int = 1) -> Column:
    """The first match of a regex group, null when there is none."""
    return F.nullif(F.regexp_extract(column(c), pattern, group), F.lit(""))


def contains_flag(c: Column | str, word: str) -> Column:
    """True when the text holds the word anywhere, in any case; null counts as false."""
    return F.coalesce(F.lower(column(c)).contains(word.lower()), F.lit(False))


def list_size(c: Column | str, sep: str = "|") -> Column:
    """Number of items in a delimited list; blank and null count as none."""
    items = F.size(F.split(column(c), re.escape(sep)))
    return F.when(F.coalesce(strip(c), F.lit("")) == "", 0).otherwise(items)


def join_list(c: Column | str, sep: str = "|") -> Column:
    """An array of texts as one delimited text."""
    return F.concat_ws(sep, column(c))
