"""KPI tables: one aggregate per source table, turned into one row per KPI."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright import fixed


def _kpi_rows(source: DataFrame, kpis: list[tuple[str, Column, str, str]], kind: str) -> DataFrame:
    """One scan of `source`; each KPI is (name, aggregate, category, display format)."""
    row = source.agg(*(agg.cast(kind).alias(f"_{i}") for i, (_, agg, _, _) in enumerate(kpis)))
    records = F.array(
        *(
            F.struct(
                F.lit(name).alias("kpi"),
                F.col(f"_{i}").alias("value"),
                F.lit(category).alias("category"),
                F.lit(display).alias("display_format"),
            )
            for i, (name, _, category, display) in enumerate(kpis)
        )
    )
    return row.select(F.inline(records))


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _rows() -> Column:
    return F.count(F.lit(1))


def _flags(flag: str) -> Column:
    return F.sum(F.col(flag).cast("int"))


def _mean_pct(flag: Column) -> Column:
    return F.round(F.avg(flag.cast("double")) * F.lit(100.0), 1)


def kpi_table(items: DataFrame, sites: DataFrame, posts: DataFrame, terms: DataFrame) -> DataFrame:
    """Nine whole-number KPIs."""
    p, g, t, number = "Portfolio", "Global", "Talent", "number"
    parts = [
        (items, [
            ("Total Brands", _rows(), p, number),
            ("Flagship Brands", _flags("is_flagship"), p, number),
            ("Brand Categories", F.count_distinct("category"), p, number),
        ]),
        (sites, [
            ("Total Locations", _rows(), g, number),
            ("Countries Served", F.count_distinct("country"), g, number),
            ("Total Employees (Est.)", F.sum("headcount"), g, number),
        ]),
        (posts, [
            ("Open Job Postings", _rows(), t, number),
            ("Remote Positions", _flags("is_remote"), t, number),
        ]),
        (terms, [("Unique Skills Tracked", _rows(), t, number)]),
    ]
    rows = _union([_kpi_rows(source, kpis, "bigint") for source, kpis in parts])
    return rows.select("kpi", "value", "category")


def kpi_text(
    items: DataFrame, sites: DataFrame, posts: DataFrame, terms: DataFrame,
    home: str = fixed.HOME_COUNTRY, first_tier: str = fixed.TIER_1,
) -> DataFrame:
    """Thirteen KPIs as text, with sites split into home and abroad."""
    p, g, t, number = "Portfolio", "Global Presence", "Talent", "number"
    at_home = F.col("country") == home
    parts = [
        (items, [
            ("Total Brands", _rows(), p, number),
            ("Flagship Brands", _flags("is_flagship"), p, number),
            ("Brand Categories", F.count_distinct("category"), p, number),
            ("Spirits Brands", _flags("is_spirits"), p, number),
        ]),
        (sites, [
            ("Total Locations", _rows(), g, number),
            ("Countries Served", F.count_distinct("country"), g, number),
            ("Global Employees (Est.)", F.sum("headcount"), g, number),
            ("US Locations", F.count_if(at_home), g, number),
            ("International Locations", F.count_if(~at_home), g, number),
        ]),
        (posts, [
            ("Open Job Postings", _rows(), t, number),
            ("Remote Positions", _flags("is_remote"), t, number),
        ]),
        (terms, [
            ("Unique Skills Tracked", _rows(), t, number),
            ("Tier-1 Must-Have Skills", F.count_if(F.col("demand_tier") == first_tier), t, number),
        ]),
    ]
    rows = _union([_kpi_rows(source, kpis, "string") for source, kpis in parts])
    return rows.select("kpi", "value", "category")


def kpi_exec(
    items: DataFrame, sites: DataFrame, posts: DataFrame, terms: DataFrame, as_of: dt.date,
    home: str = fixed.HOME_COUNTRY, data_pattern: str = fixed.DATA_DEPARTMENT_PATTERN,
) -> DataFrame:
    """Sixteen KPIs as text with a display format and the as-of date."""
    p, g, t, number = "Portfolio", "Global Presence", "Talent", "number"
    # A site without a country is not at home, so it counts as abroad.
    at_home = F.coalesce(F.col("country") == home, F.lit(False))
    # Highest frequency first, then the first name.
    top = F.coalesce(
        F.min_by("term", F.struct(-F.col("frequency"), F.col("term"))), F.lit("N/A")
    )
    parts = [
        (items, [
            ("Total Brands", _rows(), p, number),
            ("Flagship Brands", _flags("is_flagship"), p, number),
            ("Brand Categories", F.count_distinct("category"), p, number),
            ("Spirits Brands (%)", _mean_pct(F.col("is_spirits")), p, "pct"),
        ]),
        (sites, [
            ("Total Locations", _rows(), g, number),
            ("Countries Served", F.count_distinct("country"), g, number),
            ("Total Employees (Est.)", F.sum("headcount"), g, number),
            ("US Locations", F.count_if(at_home), g, number),
            ("International Locations", F.count_if(~at_home), g, number),
        ]),
        (posts, [
            ("Open Job Postings", _rows(), t, number),
            ("Remote Positions", _flags("is_remote"), t, number),
            ("Hybrid Positions", _flags("is_hybrid"), t, number),
            ("Avg Skills/Posting", F.round(F.avg("term_count"), 1), t, number),
            ("Data Roles (%)", _mean_pct(F.lower("department").rlike(data_pattern)), t, "pct"),
        ]),
        (terms, [
            ("Unique Skills Required", _rows(), t, number),
            ("Top Required Skill", top, t, "text"),
        ]),
    ]
    rows = _union([_kpi_rows(source, kpis, "string") for source, kpis in parts])
    return rows.withColumn("as_of_date", F.lit(as_of))
