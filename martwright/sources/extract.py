"""Records out of texts: cards of HTML pages and title lines of plain text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright import fixed
from martwright.functions.html import html_text
from martwright.functions.text import column, strip
from martwright.operators.dedupe import dedupe_first


def extract_cards(
    pages: DataFrame,
    html: str,
    keep: Sequence[str],
    card_pattern: str,
    field_patterns: Mapping[str, str],
    defaults: Mapping[str, str | Column],
    required: Sequence[str] = (),
) -> DataFrame:
    """One row per card of a page, with its number and one column per field.

    `card_pattern` and each field pattern name their content by group 1. A field
    that is missing takes its default (a text or a column of the page); cards
    without a `required` field are dropped. Narrow: no shuffle, no Python. (The outer
    explode, because for the plain one Spark adds a size filter below that runs the
    pattern a second time.)
    """
    cards = pages.select(
        *pages.columns,
        F.posexplode_outer(F.regexp_extract_all(F.col(html), F.lit(card_pattern), F.lit(1))).alias(
            "card_no", "_card"
        ),
    ).filter(F.col("card_no").isNotNull())
    fields = []
    for name, pattern in field_patterns.items():
        value = F.nullif(html_text(F.regexp_extract("_card", pattern, 1)), F.lit(""))
        default = defaults.get(name)
        if default is not None:
            default = default if isinstance(default, Column) else F.lit(default)
            value = F.coalesce(value, default)
        fields.append(value.alias(name))
    found = cards.select(*keep, (F.col("card_no") + 1).alias("card_no"), *fields)
    return found.dropna(how="any", subset=list(required)) if required else found


def mine_title_lines(
    docs: DataFrame,
    text: str,
    doc_id: str,
    source: Column | str,
    pattern: str = fixed.TITLE_LINE_PATTERN,
    keywords: Sequence[str] = tuple(fixed.TITLE_KEYWORDS),
    description_chars: int = fixed.TITLE_DESCRIPTION_CHARS,
) -> DataFrame:
    """Title-like lines that hold a keyword, the first occurrence over all documents.

    First means lowest `doc_id`, then the position in the text. The line break
    that ends a title is used up with it, so of two adjacent title lines only the
    first is found. Each task passes on at most one row per title.
    """
    lines = docs.select(
        F.col(doc_id).alias("doc_id"),
        column(source).alias("source_url"),
        strip(F.substring(F.col(text), 1, description_chars)).alias("description"),
        F.posexplode_outer(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(1))).alias(
            "_pos", "_line"
        ),
    ).withColumn("title", strip("_line"))
    wanted = F.lit(False)
    for word in keywords:
        wanted = wanted | F.lower("title").contains(word)
    first = dedupe_first(lines.filter(wanted), ["title"], ["doc_id", "_pos"])
    return first.select("title", "doc_id", "source_url", "description")
