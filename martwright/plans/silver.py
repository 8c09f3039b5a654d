"""Cleaning jobs: raw tables to typed, normalised, deduplicated ones.

Expected raw columns are those of the declared tables in `sources.specs`, as text
where they may be dirty. `as_of` stands for the run time and is always passed in.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright import fixed
from martwright.functions import (
    clip,
    contains_flag,
    extract_code,
    fill,
    has_text,
    in_set,
    keyword_ladder,
    list_size,
    set_ladder,
    strip,
    threshold_ladder,
    time_literal,
    title_case,
    to_date_lenient,
    to_number,
)
from martwright.operators.dedupe import dedupe_first
from martwright.operators.lookup import map_lookup, map_value


def with_audit(df: DataFrame, as_of: dt.datetime, source: str | None = None) -> DataFrame:
    """Run time and, if given, source as constant columns."""
    df = df.withColumn("processed_at", time_literal(as_of))
    return df.withColumn("data_source", F.lit(source)) if source is not None else df


def normalize_items(
    raw: DataFrame,
    categories: Mapping[str, str] = fixed.CATEGORY_NAMES,
    flagged: Sequence[str] = tuple(fixed.SPIRITS_CATEGORIES),
    default_category: str = fixed.DEFAULT_CATEGORY,
) -> DataFrame:
    """Items: title-cased name, canonical category, category flag, short text."""
    return (
        raw.withColumn("item_name", title_case(strip("item_name")))
        .withColumn("category_raw", strip("category"))
        .withColumn(
            "category", map_value(F.lower("category_raw"), categories, default_category)
        )
        .withColumn("is_spirits", in_set("category", flagged))
        .withColumn("description_short", clip("description", fixed.SHORT_TEXT_CHARS))
        .withColumn("has_description", has_text("description", fixed.MIN_TEXT_CHARS))
    )


def clean_items(raw: DataFrame, as_of: dt.datetime, source: str, *args, **kwargs) -> DataFrame:
    """`normalize_items`, then the first row per name."""
    first = dedupe_first(normalize_items(raw, *args, **kwargs), ["item_name"], ["item_id"])
    return with_audit(first, as_of, source)


def normalize_sites(
    raw: DataFrame,
    regions: Mapping[str, str] | DataFrame = fixed.COUNTRY_REGION,
    types: Mapping[str, str] = fixed.SITE_TYPES,
    default_region: str = fixed.DEFAULT_REGION,
) -> DataFrame:
    """Stripped texts, region from the country, canonical site type, numbers out of text.

    `regions` is a small fixed table or a DataFrame (country, region).
    """
    cleaned = (
        raw.withColumn("site_name", strip("site_name"))
        .withColumn("country", strip("country"))
        .withColumn("site_type_raw", strip("site_type"))
    )
    if isinstance(regions, DataFrame):
        cleaned = map_lookup(
            cleaned, "country", regions, "country", "region", "region", default_region
        )
    else:
        cleaned = cleaned.withColumn("region", map_value("country", regions, default_region))
    return cleaned.withColumns(
        {
            "site_type": map_value(F.lower("site_type_raw"), types, F.col("site_type_raw")),
            "latitude": to_number("latitude"),
            "longitude": to_number("longitude"),
            "headcount": to_number("headcount", fill=0, as_int=True),
        }
    )


def clean_sites(raw: DataFrame, as_of: dt.datetime, **kwargs) -> DataFrame:
    """`normalize_sites`, then the first row per name."""
    first = dedupe_first(normalize_sites(raw, **kwargs), ["site_name"], ["site_id"])
    return with_audit(first, as_of)


def invalid_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows that lack at least one of the columns."""
    lacking = F.lit(False)
    for c in cols:
        lacking = lacking | F.col(c).isNull()
    return df.filter(lacking)


def normalize_posts(
    raw: DataFrame,
    as_of: dt.datetime,
    ladder: Sequence[tuple[str, Sequence[str]]] = tuple(fixed.SENIORITY_RULES),
    default_level: str = fixed.DEFAULT_SENIORITY,
    remote_word: str = "remote",
    hybrid_word: str = "hybrid",
    state_pattern: str = fixed.STATE_PATTERN,
) -> DataFrame:
    """Posts: blanks filled, lenient date, state and work mode from the location, size of the term
    list, seniority from the title. `terms` is the delimited list the tagging step leaves."""
    return (
        raw.withColumns(
            {
                "title": strip("title"),
                "department": fill(strip("department"), fixed.DEFAULT_DEPARTMENT),
                "location": fill(strip("location"), fixed.DEFAULT_POST_LOCATION),
                "employment_type": fill(strip("employment_type"), fixed.DEFAULT_EMPLOYMENT_TYPE),
                "posted_date": to_date_lenient("posted_date", as_of.date()),
                "terms": fill("terms", ""),
            }
        )
        .withColumns(
            {
                "state": extract_code("location", state_pattern),
                "is_remote": contains_flag("location", remote_word),
                "is_hybrid": contains_flag("location", hybrid_word),
                "term_count": list_size("terms"),
                "seniority": keyword_ladder("title", ladder, default_level),
            }
        )
    )


def clean_posts(raw: DataFrame, as_of: dt.datetime, *args, **kwargs) -> DataFrame:
    """`normalize_posts`, then the first row per title and department.

    The posts to keep are found on their keys alone and met first: Spark moves that below the
    tagging, so only they are tagged.
    """
    named = raw.select(
        F.col("post_id"),
        strip("title").alias("title"),
        fill(strip("department"), fixed.DEFAULT_DEPARTMENT).alias("department"),
    )
    first = dedupe_first(named, ["title", "department"], ["post_id"]).select("post_id")
    cleaned = normalize_posts(raw.join(first, "post_id", "left_semi"), as_of, *args, **kwargs)
    return with_audit(dedupe_first(cleaned, ["title", "department"], ["post_id"]), as_of)


def normalize_terms(
    raw: DataFrame,
    tiers: Sequence[tuple[float, str]] = tuple(fixed.DEMAND_TIERS),
    last_tier: str = fixed.TIER_4,
    categories: Mapping[str, Sequence[str]] = fixed.SKILL_CATEGORIES,
    default_category: str = fixed.DEFAULT_SKILL_CATEGORY,
) -> DataFrame:
    """Terms: stripped name, numbers out of text (0 where they are none), tier and category."""
    return (
        raw.withColumns(
            {
                "term": strip("term"),
                "frequency": to_number("frequency", fill=0, as_int=True),
                "pct_of_posts": to_number("pct_of_posts", fill=0),
            }
        )
        .withColumn("demand_tier", threshold_ladder("pct_of_posts", tiers, last_tier))
        .withColumn("term_category", set_ladder("term", categories, default_category))
    )


def clean_terms(raw: DataFrame, as_of: dt.datetime, *args, **kwargs) -> DataFrame:
    """`normalize_terms` with the run time."""
    return with_audit(normalize_terms(raw, *args, **kwargs), as_of)
