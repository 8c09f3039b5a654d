"""The given tables in the roles the jobs work on: items, sites, posts, volumes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright import fixed
from martwright.functions import (
    contains_flag,
    in_set,
    keyword_ladder,
    month_parts,
    strip,
    threshold_ladder,
    title_case,
    to_date_lenient,
)
from martwright.operators.lookup import map_value
from martwright.operators.tagging import spread, tag_terms, term_table, word_taxonomy

AS_OF = dt.datetime(2026, 1, 1)
SOURCE = "given tables"

# `PROMO` is left out on purpose: it takes the default category.
ITEM_CATEGORIES = {
    "economy": "Economy",
    "standard": "Standard",
    "large": "Large",
    "medium": "Medium",
    "small": "Small",
}
CORE_CATEGORIES = ["Economy", "Standard", "Large"]
FLAGSHIP_SIZE = 40
PRICE_TIERS = [(1500.0, "Ultra-Premium"), (1000.0, "Premium")]
DEFAULT_PRICE_TIER = "Value"

# `AUTOMOBILE` and `HOUSEHOLD` are left out on purpose: they stay as they are.
SITE_TYPES = {
    "building": "Building",
    "furniture": "Furniture",
    "machinery": "Machinery",
}
UNMAPPED_REGION = "MIDDLE EAST"
HOME_COUNTRY = "NATION_1"

CONTROL_STATES = ["NATION_3", "NATION_6", "NATION_9", "NATION_12"]
ON_PREMISE_FLAGS = ["A", "R"]

WORDS = {
    "English words": [
        "a", "the", "of", "and", "in", "for", "with", "that", "this", "from", "only", "to be",
    ],
    "French words": ["les", "une", "pour", "dans", "avec", "été"],
    "German words": ["der", "die", "und", "nicht", "für"],
    "Spanish words": ["los", "una", "para", "con", "como"],
}
OTHER_WORDS = ["license", "worthless", "pathetic"]
DEFAULT_WORD_CATEGORY = "Other words"
TAXONOMY = word_taxonomy([word for words in WORDS.values() for word in words] + OTHER_WORDS)
WORD_TIERS = [(50, fixed.TIER_1), (25, fixed.TIER_2), (10, fixed.TIER_3)]
WORD_URGENCY = [(60, "🔴 Critical"), (50, "🟠 High Demand"), (40, "🟡 In Demand")]

LEVEL_RULES = [
    ("Senior Leadership", ["license", "pathetic", "worthless"]),
    ("Senior", ["that", "nicht", "para"]),
    ("Junior", ["this", "pour", "como"]),
    ("Manager", ["with", "und", "avec"]),
]
DATA_DEPARTMENTS = "src1|src5"
TITLE_PATTERN = r"(?:^|\n)([A-Z][A-Za-z &/\-,()]{10,80})\.?\s*(?:\n|$)"
TITLE_WORDS = ["the", "of ", "ing"]


# Declared, so that reading a table starts no job to look at file footers.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
}


#: Phrases put before the texts, one per document in turn, to give the skill patterns work.
SKILL_PHRASES = [
    "SQL and Python", "R skills", "R for all", "R language", "R2D2", "Java", "JavaScript",
    "java/scala", "Power BI", "power  bi", "QlikView", "qliksensing", "AWS", "Google Cloud",
    "Apache Airflow", "PySpark", "sparkling", "Microsoft SQL", "MSSQL Server", "Postgres",
    "data modeler", "data models", "data warehouse", "data lakehouse", "star schema",
    "dimensional modeling", "machine learnings", "ML", "HTML", "statistical analysis",
    "data governance", "data-quality", "data catalog", "data lineage", "Scrum", "stakeholders",
    "KPIs", "key performance indicator", "data pipeline", "dashboard", "reports", "BI", "BIG",
    "business intelligence", "excel at Excel", "étl", "ETL ELT dbt", "Kafka_Kafka", "GDPR.",
]

#: Setting with the number of partitions texts are dealt over before they are tagged; unset: none.
SPREAD = "spark.martwright.spread"
#: First day of the months merged into a trend.
MERGE_FROM = "1996-01-01"
#: Ids per part of a joined list.
LIST_IDS = 250


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder.rstrip('/')}/{name}.parquet")


def raw_items(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("item_name"),
        F.col("p_type").alias("category"),
        F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("description"),
        (F.col("p_size") >= FLAGSHIP_SIZE).alias("is_flagship"),
    )


def items(spark: SparkSession, folder: str) -> DataFrame:
    """Items as loaded: canonical category and flags, every row kept."""
    category = map_value(F.lower(strip("category")), ITEM_CATEGORIES, fixed.DEFAULT_CATEGORY)
    return (
        raw_items(spark, folder)
        .withColumns(
            {
                "item_name": title_case(strip("item_name")),
                "category_raw": F.col("category"),
                "category": category,
            }
        )
        .withColumn("is_spirits", in_set("category", CORE_CATEGORIES))
    )


def sized_items(spark: SparkSession, folder: str) -> DataFrame:
    """Id, canonical category and size of the items."""
    category = map_value(F.lower(strip("p_type")), ITEM_CATEGORIES, fixed.DEFAULT_CATEGORY)
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("item_id"), category.alias("category"), F.col("p_size").alias("size")
    )


def regions(spark: SparkSession, folder: str) -> DataFrame:
    """Country -> region, one region left out."""
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region").filter(F.col("r_name") != UNMAPPED_REGION)
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_name").alias("country"), F.col("r_name").alias("region")
    )


def raw_sites(spark: SparkSession, folder: str) -> DataFrame:
    """Sites before cleaning: numbers as text, coordinates missing here and there."""
    customer = table(spark, folder, "customer")
    nation = table(spark, folder, "nation")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("site_id"),
        F.col("c_name").alias("site_name"),
        F.col("n_name").alias("country"),
        F.col("c_mktsegment").alias("site_type"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal").cast("string")).alias("latitude"),
        F.when(F.col("c_nationkey") != 7, F.col("c_nationkey").cast("string"))
        .otherwise("n/a")
        .alias("longitude"),
        F.col("c_acctbal").cast("string").alias("headcount"),
    )


def sites(spark: SparkSession, folder: str) -> DataFrame:
    """Sites as loaded, with country and region."""
    customer = table(spark, folder, "customer")
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            F.col("c_custkey").alias("site_id"),
            F.col("c_name").alias("site_name"),
            F.col("n_name").alias("country"),
            F.col("r_name").alias("region"),
            map_value(F.lower("c_mktsegment"), SITE_TYPES, F.col("c_mktsegment")).alias(
                "site_type"
            ),
            F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("latitude"),
            F.when(F.col("c_nationkey") != 7, F.col("c_nationkey").cast("double")).alias(
                "longitude"
            ),
            F.col("c_acctbal").cast("bigint").alias("headcount"),
        )
    )


def sites_with_year(spark: SparkSession, folder: str) -> DataFrame:
    """Sites with the year of their first order, null for sites without one."""
    first = (
        table(spark, folder, "orders")
        .groupBy("o_custkey")
        .agg(F.year(F.min("o_orderdate")).alias("year_established"))
    )
    loaded = sites(spark, folder)
    return loaded.join(first, loaded.site_id == first.o_custkey, "left").drop("o_custkey")


def _spread_over(spark: SparkSession) -> int | None:
    """Partitions for tables of long texts, where the caller names a number."""
    named = spark.conf.get(SPREAD, None)
    return int(named) if named else None


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """The documents, for heavy work on their texts."""
    return spread(table(spark, folder, "documents"), "doc_id", _spread_over(spark))


def pages(spark: SparkSession, folder: str) -> DataFrame:
    """The pages, for heavy work on their texts."""
    return spread(table(spark, folder, "pages"), "page_id", _spread_over(spark))


def raw_posts(spark: SparkSession, folder: str, docs: DataFrame | None = None) -> DataFrame:
    """Posts before cleaning. The date text is made from the numbers of a document and is
    not a date for every one of them."""
    docs = table(spark, folder, "documents") if docs is None else docs
    month = F.lpad((F.col("n_chars") % 14).cast("string"), 2, "0")
    day = F.lpad((F.col("doc_id") % 31).cast("string"), 2, "0")
    return docs.select(
        F.col("doc_id").alias("post_id"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("source").alias("department"),
        F.col("lang").alias("location"),
        F.lit(None).cast("string").alias("employment_type"),
        F.concat_ws("-", F.lit("2025"), month, day).alias("posted_date"),
        F.col("text").alias("description"),
    )


def untagged_posts(
    spark: SparkSession, folder: str, docs: DataFrame | None = None
) -> DataFrame:
    """Posts as loaded, every row kept, without their terms."""
    return raw_posts(spark, folder, docs).withColumns(
        {
            "title": strip("title"),
            "posted_date": to_date_lenient("posted_date", AS_OF.date()),
            "is_remote": contains_flag("location", "en"),
            "is_hybrid": contains_flag("location", "fr"),
            "seniority": keyword_ladder("title", LEVEL_RULES, fixed.DEFAULT_SENIORITY),
        }
    )


def posts(spark: SparkSession, folder: str) -> DataFrame:
    """Posts as loaded, with the array of terms found in the text."""
    untagged = untagged_posts(spark, folder, documents(spark, folder))
    tagged = tag_terms(untagged, "description", TAXONOMY)
    return tagged.withColumn("term_count", F.size("terms"))


def tagged_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Posts with nothing but their id, title and terms worked out."""
    raw = raw_posts(spark, folder, documents(spark, folder)).select(
        "post_id", strip("title").alias("title"), "description"
    )
    return tag_terms(raw, "description", TAXONOMY)


def skill_texts(spark: SparkSession, folder: str) -> DataFrame:
    """The documents with one of SKILL_PHRASES in front of the text."""
    phrases = F.array(*[F.lit(p) for p in SKILL_PHRASES])
    phrase = F.get(phrases, (F.col("doc_id") % len(SKILL_PHRASES)).cast("int"))
    docs = documents(spark, folder)
    return docs.select("doc_id", F.concat(phrase, F.lit(". "), "text").alias("text"))


def terms(spark: SparkSession, folder: str) -> DataFrame:
    """The term table of the posts."""
    return term_table_of(tagged_texts(spark, folder))


def term_table_of(tagged: DataFrame) -> DataFrame:
    """The term table of posts whose terms are known."""
    return term_table(tagged, "terms", WORD_TIERS, fixed.TIER_4, WORDS, DEFAULT_WORD_CATEGORY)


def _fact(line: DataFrame, part: DataFrame) -> DataFrame:
    # What a line takes from its part is worked out per part, before the join.
    sold = part.select(
        "p_partkey",
        F.col("p_brand").alias("item"),
        map_value(F.lower("p_type"), ITEM_CATEGORIES, fixed.DEFAULT_CATEGORY).alias("category"),
        threshold_ladder("p_retailprice", PRICE_TIERS, DEFAULT_PRICE_TIER).alias("price_tier"),
    )
    on_premise = F.col("l_returnflag").isin(ON_PREMISE_FLAGS)
    cases = F.col("l_quantity").cast("bigint")
    return line.join(sold, line.l_partkey == sold.p_partkey).withColumns(
        {
            **month_parts("l_shipdate"),
            "total_cases": cases,
            "on_premise": F.when(on_premise, cases).otherwise(0),
            "off_premise": F.when(on_premise, 0).otherwise(cases),
        }
    )


def volumes(spark: SparkSession, folder: str) -> DataFrame:
    """Volume facts without the place they went to: one join less."""
    return _fact(table(spark, folder, "lineitem"), table(spark, folder, "part"))


def state_volumes(spark: SparkSession, folder: str) -> DataFrame:
    """Volume facts with the state (nation of the customer) and its control flag.

    The order side is narrowed to (order, state) before it meets the lines, the
    only join of two large tables.
    """
    orders = table(spark, folder, "orders")
    customer = table(spark, folder, "customer")
    nation = table(spark, folder, "nation")
    placed = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .select("o_orderkey", F.col("n_name").alias("state_code"))
    )
    line = table(spark, folder, "lineitem")
    return _fact(
        line.join(placed, line.l_orderkey == placed.o_orderkey), table(spark, folder, "part")
    ).withColumn("is_control_state", in_set("state_code", CONTROL_STATES))
