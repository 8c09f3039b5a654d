"""Declared tables: types, NOT NULL, DEFAULT, UNIQUE and allowed values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Col:
    name: str
    type: str
    not_null: bool = False
    default: object = None
    domain: tuple = ()


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[Col, ...]
    unique: tuple[tuple[str, ...], ...] = ()

    def schema(self) -> T.StructType:
        ddl = ", ".join(f"`{c.name}` {c.type}" for c in self.columns)
        return T.StructType.fromDDL(ddl)


_FLAG = {"type": "int", "domain": (0, 1)}

DIM_ITEM = TableSpec(
    "dim_item",
    (
        Col("item_id", "bigint", not_null=True),
        Col("item_name", "string", not_null=True),
        Col("category", "string", not_null=True),
        Col("category_raw", "string"),
        Col("description", "string"),
        Col("description_short", "string"),
        Col("url", "string"),
        Col("is_flagship", default=0, **_FLAG),
        Col("is_spirits", default=1, **_FLAG),
        Col("has_description", default=0, **_FLAG),
        Col("data_source", "string"),
        Col("processed_at", "timestamp_ntz"),
        Col("scraped_at", "timestamp_ntz"),
    ),
    unique=(("item_id",),),
)

DIM_SITE = TableSpec(
    "dim_site",
    (
        Col("site_id", "bigint", not_null=True),
        Col("site_name", "string", not_null=True),
        Col("city", "string"),
        Col("state_province", "string"),
        Col("country", "string", not_null=True),
        Col("region", "string", not_null=True),
        Col("site_type", "string", not_null=True),
        Col("latitude", "double"),
        Col("longitude", "double"),
        Col("year_established", "int"),
        Col("headcount", "bigint", default=0),
        Col("processed_at", "timestamp_ntz"),
        Col("scraped_at", "timestamp_ntz"),
    ),
    unique=(("site_id",),),
)

FACT_POSTS = TableSpec(
    "fact_posts",
    (
        Col("post_id", "bigint", not_null=True),
        Col("title", "string", not_null=True),
        Col("department", "string"),
        Col("location", "string"),
        Col("state", "string", default=""),
        Col("is_remote", default=0, **_FLAG),
        Col("is_hybrid", default=0, **_FLAG),
        Col("employment_type", "string", default="Full-Time"),
        Col("posted_date", "date"),
        Col("seniority", "string"),
        Col("term_count", "int", default=0),
        Col("terms", "string"),
        Col("description", "string"),
        Col("processed_at", "timestamp_ntz"),
        Col("scraped_at", "timestamp_ntz"),
    ),
    unique=(("post_id",),),
)

FACT_TERMS = TableSpec(
    "fact_terms",
    (
        Col("term", "string", not_null=True),
        Col("frequency", "bigint", not_null=True, default=0),
        Col("pct_of_posts", "double", default=0.0),
        Col("demand_tier", "string"),
        Col("term_category", "string"),
        Col("processed_at", "timestamp_ntz"),
    ),
    unique=(("term",),),
)

FACT_VOLUMES = TableSpec(
    "fact_volumes",
    (
        Col("year", "int", not_null=True),
        Col("month", "int", not_null=True),
        Col("month_label", "string", not_null=True),
        Col("item", "string", not_null=True),
        Col("category", "string"),
        Col("price_tier", "string"),
        Col("state_code", "string", not_null=True),
        Col("state_name", "string", not_null=True),
        Col("is_control_state", "int", default=0),
        Col("on_premise", "bigint", default=0),
        Col("off_premise", "bigint", default=0),
        Col("total_cases", "bigint", default=0),
    ),
)

FACT_SHARES = TableSpec(
    "fact_shares",
    (
        Col("item", "string", not_null=True),
        Col("category", "string"),
        Col("volume_share_pct", "double", default=0.0),
        Col("numeric_distribution", "double", default=0.0),
        Col("velocity_per_point", "double", default=0.0),
        Col("price_tier", "string"),
    ),
)

DQ_LOG = TableSpec(
    "dq_log",
    (
        Col("table_name", "string", not_null=True),
        Col("checked_at", "timestamp_ntz", not_null=True),
        Col("total_rows", "bigint"),
        Col("checks_passed", "bigint"),
        Col("checks_failed", "bigint"),
        Col("issues", "array<string>"),
    ),
)
