"""Reporting marts over items, sites and posts.

Each mart is one pre-combined aggregation; the sort is left to the caller.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright import fixed
from martwright.functions.ladders import flag_label
from martwright.functions.numbers import pct
from martwright.operators.shares import (
    LIST_WIDTH,
    joined_lists,
    row_total,
    share_of_total,
)


def _rows() -> Column:
    return F.count(F.lit(1))


def _flags(col: str) -> Column:
    return F.sum(F.col(col).cast("int"))


# ---- items -------------------------------------------------------------------


def category_mart(df: DataFrame, cat: str, flag: str, kind: str) -> DataFrame:
    """Per category: items, flagged items, share of all items and kind flag.

    The names of its items are a table of their own, see `category_names`.
    """
    return (
        df.groupBy(cat)
        .agg(
            _rows().alias("item_count"),
            _flags(flag).alias("flagged_count"),
            F.max(F.col(kind).cast("int")).alias("kind_flag"),
        )
        .withColumn("pct_of_items", pct("item_count", row_total(df)))
    )


def category_names(
    df: DataFrame, cat: str, name: str, order: str, width: int = LIST_WIDTH
) -> DataFrame:
    """The names of each category's items, joined in parts (see `joined_lists`)."""
    return joined_lists(df, [cat], name, order, ", ", "item_names", width)


def category_mart_ext(df: DataFrame, cat: str, flag: str, kind: str) -> DataFrame:
    """As `category_mart`, with unflagged items and a kind label."""
    return (
        df.groupBy(cat)
        .agg(
            _rows().alias("item_count"),
            _flags(flag).alias("flagged_count"),
            (_rows() - _flags(flag)).alias("unflagged_count"),
            flag_label(
                F.max(F.col(kind).cast("int")), fixed.SPIRITS_LABEL, fixed.NON_SPIRITS_LABEL
            ).alias("kind_label"),
        )
        .withColumn("pct_of_items", pct("item_count", row_total(df)))
    )


def category_flagged_names(
    df: DataFrame, cat: str, flag: str, name: str, order: str, width: int = LIST_WIDTH
) -> DataFrame:
    """The names of each category's flagged items, joined in parts; null in a part without any."""
    flagged = F.when(F.col(flag).cast("boolean"), F.col(name))
    return joined_lists(df, [cat], flagged, order, ", ", "flagged_names", width)


def category_mart_first(
    df: DataFrame, cat: str, flag: str, kind: str, name: str, order: str
) -> DataFrame:
    """Per category: named items, flagged items, the first item's kind flag, share of all named."""
    named = df.agg(F.count(name)).scalar()
    return (
        df.groupBy(cat)
        .agg(
            F.count(name).alias("item_count"),
            _flags(flag).alias("flagged_count"),
            F.min_by(kind, order).alias("kind_flag"),
        )
        .withColumn("pct_of_items", pct("item_count", named))
    )


def distribution(df: DataFrame, cat: str, name: str) -> DataFrame:
    """Named items and share per category under display names."""
    named = df.agg(F.count(name)).scalar()
    return df.groupBy(F.col(cat).alias("Category")).agg(F.count(name).alias("Item Count")).withColumn(
        "% of Items", pct("Item Count", named)
    )


def singleton_groups(df: DataFrame, key: str) -> DataFrame:
    """Groups with exactly one row."""
    return df.groupBy(key).agg(_rows().alias("item_count")).filter("item_count = 1")


def segment_split(df: DataFrame, flag: str, yes: str, no: str) -> DataFrame:
    """Rows and share of the table on both sides of a flag."""
    labelled = df.select(flag_label(flag, yes, no).alias("segment"))
    return share_of_total(labelled, ["segment"], "item_count", "pct")


# ---- sites -------------------------------------------------------------------


def _by_country(df: DataFrame, region: str, kind: str, headcount: str, country: str, order: str,
                *more: Column) -> DataFrame:
    # First step of the region marts: once per country, so that the second step
    # never sees more rows per group than there are countries.
    return df.groupBy(region, kind, country).agg(
        _rows().alias("_rows"),
        F.sum(headcount).alias("_heads"),
        F.count(headcount).alias("_counted"),
        F.min(order).alias("_first"),
        *more,
    )


def _country_list(country: str) -> Column:
    """Distinct countries, comma-joined in the order they first appear."""
    seen = F.array_sort(
        F.collect_list(F.when(F.col(country).isNotNull(), F.struct("_first", country)))
    )
    return F.array_join(F.transform(seen, lambda pair: pair[country]), ",")


def region_type_mart(
    df: DataFrame, region: str, kind: str, headcount: str, country: str, order: str
) -> DataFrame:
    """Per region and type: sites, headcount, number and list of countries."""
    per_country = _by_country(df, region, kind, headcount, country, order)
    return per_country.groupBy(region, kind).agg(
        F.sum("_rows").alias("site_count"),
        F.sum("_heads").alias("total_headcount"),
        F.count(country).alias("country_count"),
        _country_list(country).alias("countries"),
    )


def region_type_mart_ext(
    df: DataFrame, region: str, kind: str, headcount: str, country: str, order: str, year: str
) -> DataFrame:
    """As `region_type_mart`, with mean headcount and the oldest and newest year."""
    per_country = _by_country(
        df, region, kind, headcount, country, order,
        F.min(year).alias("_oldest"), F.max(year).alias("_newest"),
    )
    mean = F.sum("_heads").cast("double") / F.nullif(F.sum("_counted"), F.lit(0))
    return per_country.groupBy(region, kind).agg(
        F.sum("_rows").alias("site_count"),
        F.sum("_heads").alias("total_headcount"),
        F.round(mean, 0).alias("avg_headcount"),
        F.count(country).alias("country_count"),
        F.min("_oldest").alias("oldest_year"),
        F.max("_newest").alias("newest_year"),
        _country_list(country).alias("countries"),
    )


def region_type_mart_basic(
    df: DataFrame, region: str, kind: str, name: str, headcount: str, country: str
) -> DataFrame:
    """Per region and type: named sites, headcount, distinct countries."""
    return df.groupBy(region, kind).agg(
        F.count(name).alias("site_count"),
        F.sum(headcount).alias("total_headcount"),
        F.count_distinct(country).alias("country_count"),
    )


def region_summary(
    df: DataFrame, region: str, name: str, headcount: str, country: str
) -> DataFrame:
    """Per region, under display names: named sites, headcount, distinct countries."""
    return df.groupBy(F.col(region).alias("Region")).agg(
        F.count(name).alias("Sites"),
        F.sum(headcount).alias("Headcount"),
        F.count_distinct(country).alias("Countries"),
    )


def region_rollup(region_type: DataFrame, region: str) -> DataFrame:
    """`region_type_mart` added up by region; a country in two types counts twice."""
    return region_type.groupBy(region).agg(
        F.sum("site_count").alias("total_sites"),
        F.sum("total_headcount").alias("total_headcount"),
        F.sum("country_count").alias("total_countries"),
    )


def sum_by(df: DataFrame, key: str, measure: str, out: str) -> DataFrame:
    return df.groupBy(key).agg(F.sum(measure).alias(out))


def count_sum_by(df: DataFrame, key: str, measure: str, count: str, out: str) -> DataFrame:
    return df.groupBy(key).agg(_rows().alias(count), F.sum(measure).alias(out))


# ---- posts -------------------------------------------------------------------


def department_mart(
    df: DataFrame, dept: str, remote: str, hybrid: str, size: str
) -> DataFrame:
    """Per department: posts, remote and hybrid posts, mean list size and share.

    The levels of its posts are a table of their own, see `department_levels`.
    """
    return (
        df.groupBy(dept)
        .agg(
            _rows().alias("post_count"),
            _flags(remote).alias("remote_count"),
            _flags(hybrid).alias("hybrid_count"),
            F.round(F.avg(size), 1).alias("avg_terms"),
        )
        .withColumn("pct_of_posts", pct("post_count", row_total(df)))
    )


def department_levels(
    df: DataFrame, dept: str, level: str, order: str, width: int = LIST_WIDTH
) -> DataFrame:
    """The level of each post of a department, joined in parts (see `joined_lists`)."""
    return joined_lists(df, [dept], level, order, " | ", "seniority_mix", width)


def department_mart_ext(
    df: DataFrame, dept: str, remote: str, hybrid: str, size: str
) -> DataFrame:
    """Per department: posts by work mode, mean list size and share."""
    return (
        df.groupBy(dept)
        .agg(
            _rows().alias("post_count"),
            _flags(remote).alias("remote_count"),
            _flags(hybrid).alias("hybrid_count"),
            (_rows() - _flags(remote) - _flags(hybrid)).alias("on_site_count"),
            F.round(F.avg(size), 1).alias("avg_terms"),
        )
        .withColumn("pct_of_posts", pct("post_count", row_total(df)))
    )


def cross_counts(df: DataFrame, a: str, b: str, out: str = "Count") -> DataFrame:
    return df.groupBy(a, b).agg(_rows().alias(out))


def work_mode(df: DataFrame, remote: str, hybrid: str) -> DataFrame:
    """One row: remote, hybrid, on-site and all posts."""
    return df.agg(
        _flags(remote).alias("remote"),
        _flags(hybrid).alias("hybrid"),
        (_rows() - _flags(remote) - _flags(hybrid)).alias("on_site"),
        _rows().alias("total"),
    )


def size_stats(df: DataFrame, dept: str, size: str) -> DataFrame:
    """Mean, largest and smallest list size per department."""
    return df.groupBy(dept).agg(
        F.round(F.avg(size), 1).alias("avg_terms"),
        F.max(size).alias("max_terms"),
        F.min(size).alias("min_terms"),
    )


def terms_by_category(terms: DataFrame) -> DataFrame:
    """Per term category: terms, mentions and mean percentage."""
    return terms.groupBy("term_category").agg(
        _rows().alias("unique_terms"),
        F.sum("frequency").alias("total_mentions"),
        F.round(F.avg("pct_of_posts"), 1).alias("avg_pct_of_posts"),
    )
