"""Every registered query: (session, folder of the given tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright import fixed
from martwright.functions import (
    clip,
    contains_flag,
    extract_code,
    fill,
    first_month,
    has_text,
    in_set,
    join_list,
    keyword_ladder,
    list_size,
    month_parts,
    month_spine,
    set_ladder,
    split_shares,
    strip,
    threshold_ladder,
    title_case,
    to_date_lenient,
    to_number,
)
from martwright.operators import kpis, marts, quality, volumes
from martwright.operators.dedupe import (
    dedupe_first,
    upsert_latest,
    with_ranks_large,
    with_row_id,
)
from martwright.operators.lookup import map_lookup, map_value
from martwright.operators.shares import flag_pct, share_of_total, top_k
from martwright.operators.phrases import phrase_hits, taxonomy_index
from martwright.operators.tagging import (
    count_with_all,
    skill_taxonomy,
    tag_terms,
    term_frequency,
    term_pairs,
)
from martwright.plans import cleaning, gold, roles, silver
from martwright.session import fresh_path, written
from martwright.sources import specs
from martwright.sources.buckets import read_buckets, upsert_buckets
from martwright.sources.csv_splits import read_csv_splits
from martwright.sources.extract import extract_cards, mine_title_lines
from martwright.sources.markup import extract_elements
from martwright.sources.readers import query, read_optional, register_views, with_fallback
from martwright.sources.versions import live_version, read_live, refresh
from martwright.sources.writers import load_table, to_json_records, write_csv

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(run: Query) -> Query:
    """Register under the function's name; `q_` marks a name that is taken by an import."""
    QUERIES[run.__name__.removeprefix("q_")] = run
    return run


# ---- sources and sinks -------------------------------------------------------


@register
def optional_scan(spark, folder):
    """One table that is there, one that is not, as one result."""
    schema = roles.table(spark, folder, "supplier").schema
    there = read_optional(spark, f"{folder}/supplier.parquet", schema)
    absent = read_optional(spark, f"{folder}/supplier_of_next_year.parquet", schema)
    return there.unionByName(absent).select("s_suppkey", "s_name", "s_nationkey")


@register
def csv_split_scan(spark, folder):
    """The documents written as CSV, line breaks in their fields, and read back by splits."""
    docs = roles.documents(spark, folder)
    path = fresh_path(spark, "documents-csv")
    write_csv(docs, path)
    back = read_csv_splits(spark, path, docs.schema)
    return back.select("doc_id", "lang", "source", "n_chars", F.md5("text").alias("text_md5"))


@register
def sql_scan(spark, folder):
    """SQL over named views, made into one statement by Catalyst."""
    register_views(
        spark,
        {
            "mw_items": lambda: roles.items(spark, folder),
            "mw_items_by_category": lambda: marts.category_mart(
                spark.table("mw_items"), *gold.ITEM_MART
            ),
        },
    )
    return query(
        spark,
        f"""SELECT category, item_count, flagged_count, pct_of_items,
                   CASE WHEN kind_flag = 1 THEN '{fixed.SPIRITS_LABEL}'
                        ELSE '{fixed.NON_SPIRITS_LABEL}' END AS type
            FROM mw_items_by_category
            ORDER BY item_count DESC, category""",
    )


@register
def source_fallback(spark, folder):
    """A source with too few rows gives way to its fallback, a sufficient one does not."""
    supplier = roles.table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")
    )
    customer = roles.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name")
    )
    few = with_fallback(
        lambda: supplier.filter("id < 0"), customer, min_rows=fixed.MIN_SOURCE_ITEMS
    )
    enough = with_fallback(lambda: supplier, customer, min_rows=fixed.MIN_SOURCE_POSTS)
    return few.withColumn("case", F.lit("few")).unionByName(
        enough.withColumn("case", F.lit("enough"))
    )


@register
def page_cards(spark, folder):
    """The article of each page as a record."""
    return extract_cards(
        roles.pages(spark, folder),
        "html",
        ["page_id"],
        r"(?s)<article>(.*?)</article>",
        {
            "name": r"(?s)<h[1-6][^>]*>(.*?)</h[1-6]>",
            "category": r'(?s)<span class="category">(.*?)</span>',
            "description": r"(?s)<p>(.*?)</p>",
            "link": r'<a [^>]*href="([^"]*)"',
        },
        {"category": "Unknown", "description": "", "link": F.col("url")},
        required=["name"],
    )


@register
def page_links(spark, folder):
    """The navigation entries of each page as records; entries without a name are dropped."""
    return extract_cards(
        roles.pages(spark, folder),
        "html",
        ["page_id"],
        r"(?s)<li>(.*?)</li>",
        {"name": r"(?s)<a [^>]*>(.*?)</a>", "link": r'<a href="([^"]*)"'},
        {"link": F.col("url")},
        required=["name"],
    )


@register
def page_elements(spark, folder):
    """Navigation entries, adverts and articles of each page, found by tag and class."""
    return extract_elements(
        roles.pages(spark, folder),
        "html",
        ["page_id"],
        "article, li, .ad",
        {"name": "h1, a", "description": "p", "link": ("a[href]", "href")},
        {"link": F.col("url")},
    )


@register
def title_lines(spark, folder):
    return mine_title_lines(
        roles.documents(spark, folder), "text", "doc_id", "source",
        roles.TITLE_PATTERN, roles.TITLE_WORDS,
    )


@register
def load_refresh(spark, folder):
    """Load the items into their table, then read it back."""
    rows = roles.items(spark, folder).withColumn("url", F.lit(None).cast("string"))
    return load_table(rows, specs.DIM_ITEM, fresh_path(spark, "dim_item")).select(
        "item_id", "item_name", "category", "category_raw", "is_flagship", "is_spirits",
        "has_description",
    )


@register
def table_versions(spark, folder):
    """Items loaded, replaced by the flagship ones, then by a load that fails half way: the live
    rows with the number of their load."""
    root = fresh_path(spark, "versions")
    names = ["item_id", "item_name", "category"]
    rows = roles.items(spark, folder)
    refresh(spark, root, {"items": rows.select(names)})
    refresh(spark, root, {"items": rows.filter("is_flagship").select(names)})
    last = rows.agg(F.max("item_id")).scalar()
    stop = F.raise_error(F.lit("a row that cannot be made")).cast("string")
    broken = rows.withColumn("category", F.when(F.col("item_id") == last, stop).otherwise("-"))
    try:
        refresh(spark, root, {"items": broken.select(names)})
    except (PySparkException, Py4JJavaError) as error:
        if "cannot be made" not in str(error):
            raise
    live = read_live(spark, root, "items", rows.select(names).schema)
    return live.withColumn("version", F.lit(live_version(spark, root)).cast("bigint"))


@register
def q_upsert_buckets(spark, folder):
    """Latest order per customer, in a table of buckets: open orders replace finished ones."""
    orders = roles.table(spark, folder, "orders").select(
        "o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice"
    )
    path = fresh_path(spark, "latest-orders")
    upsert_buckets(orders.filter("o_orderstatus = 'F'"), path, ["o_custkey"], "o_orderkey")
    upsert_buckets(orders.filter("o_orderstatus <> 'F'"), path, ["o_custkey"], "o_orderkey")
    return read_buckets(spark, path, orders.schema).select(*orders.columns)


@register
def load_quarantine(spark, folder):
    """Items split by the constraints of their table, the broken ones with the rules they break."""
    rows = _breaking_items(spark, folder)
    split = quality.load_with_quarantine(
        rows, _items_spec(), [F.col("item_id")],
        fresh_path(spark, "items-table"), fresh_path(spark, "items-quarantine"),
    )
    none = F.lit("")
    return split["table"].select("item_id", "item_name", none.alias("broken_rules")).unionByName(
        split["quarantine"].select(
            "item_id", "item_name", F.array_join("broken_rules", "; ").alias("broken_rules")
        )
    )


@register
def q_upsert_latest(spark, folder):
    """Latest order per customer: any other order replaces finished ones."""
    orders = roles.table(spark, folder, "orders").select(
        "o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice"
    )
    return upsert_latest(
        orders.filter("o_orderstatus = 'F'"),
        orders.filter("o_orderstatus <> 'F'"),
        ["o_custkey"],
        "o_orderkey",
    )


@register
def constraint_check(spark, folder):
    """Constraints of the items table, counted on rows that break some of them."""
    return quality.constraint_check(_breaking_items(spark, folder), _items_spec())


def _breaking_items(spark, folder):
    """Items of which some break a constraint of their table."""
    return (
        roles.items(spark, folder)
        .withColumn("item_id", F.col("item_id").try_cast("bigint"))
        .withColumn("category", F.nullif("category", F.lit("Uncategorized")))
        .withColumn("is_flagship", F.length("item_name") % 3)
        .withColumn("is_spirits", F.col("is_spirits").cast("int"))
        .withColumn("has_description", F.lit(1))
    )


def _items_spec():
    return specs.TableSpec(
        specs.DIM_ITEM.name,
        specs.DIM_ITEM.columns,
        unique=(("item_id",), ("item_name", "category")),
    )


@register
def json_records(spark, folder):
    mart = marts.category_mart_first(roles.items(spark, folder), *gold.ITEM)
    cols = ["category", "item_count", "flagged_count", "kind_flag", "pct_of_items"]
    return to_json_records(mart, cols)


# ---- projections and filters -------------------------------------------------


@register
def geo_map(spark, folder):
    names = {
        "site_name": "Site",
        "country": "Country",
        "region": "Region",
        "site_type": "Type",
        "latitude": "Latitude",
        "longitude": "Longitude",
        "headcount": "Headcount",
    }
    return roles.sites(spark, folder).select(*(F.col(c).alias(n) for c, n in names.items()))


@register
def flagship_list(spark, folder):
    return (
        roles.items(spark, folder)
        .filter("is_flagship")
        .select("item_id", "item_name", "category")
        .orderBy("category", "item_name", "item_id")
    )


@register
def top_terms(spark, folder):
    wanted = gold.wanted_terms(roles.terms(spark, folder))
    return wanted.orderBy(F.desc("frequency"), "term")


@register
def invalid_coords(spark, folder):
    """Sites that lack a coordinate."""
    rows = silver.normalize_sites(
        roles.raw_sites(spark, folder),
        regions=roles.regions(spark, folder),
        types=roles.SITE_TYPES,
    )
    return silver.invalid_rows(rows, ["latitude", "longitude"]).select(
        "site_id", "site_name", "latitude", "longitude"
    )


@register
def both_terms(spark, folder):
    docs = roles.table(spark, folder, "documents")
    return count_with_all(docs, "text", ["that", "With"])


@register
def singleton_groups(spark, folder):
    """Titles that occur once."""
    return marts.singleton_groups(
        roles.raw_posts(spark, folder).select(strip("title").alias("title")), "title"
    )


@register
def terms_in_category(spark, folder):
    return (
        roles.terms(spark, folder)
        .filter(F.col("term_category") == "French words")
        .select("term", "frequency", "pct_of_posts")
        .orderBy(F.desc("frequency"), "term")
    )


# ---- scalar functions --------------------------------------------------------


@register
def clean_text(spark, folder):
    padded = F.concat(F.lit(" \n\t"), F.col("text"), F.lit("  \r\n"))
    return roles.table(spark, folder, "documents").select(
        "doc_id",
        strip(padded).alias("stripped"),
        clip("text", fixed.SHORT_TEXT_CHARS).alias("short_text"),
        has_text(F.nullif("lang", F.lit("de")), 1).alias("has_language"),
        fill(F.nullif("lang", F.lit("fr")), "unknown").alias("language"),
    )


@register
def q_title_case(spark, folder):
    part = roles.table(spark, folder, "part")
    odd = F.concat(F.col("p_name"), F.lit("'s "), F.col("p_brand"), F.lit(" 7x"))
    return part.select("p_partkey", title_case(odd).alias("display_name"))


@register
def normalize_lookup(spark, folder):
    """Category from a fixed table and region from a joined one, each with its default."""
    items = roles.raw_items(spark, folder).select(
        F.col("item_id").alias("id"),
        map_value(F.lower(strip("category")), roles.ITEM_CATEGORIES, "Uncategorized").alias(
            "label"
        ),
    )
    items = items.withColumn("is_member", in_set("label", roles.CORE_CATEGORIES))
    sites = map_lookup(
        roles.raw_sites(spark, folder).select(F.col("site_id").alias("id"), "country"),
        "country", roles.regions(spark, folder), "country", "region", "label",
        fixed.DEFAULT_REGION,
    ).select("id", "label")
    sites = sites.withColumn("is_member", in_set("label", ["ASIA", "EUROPE"]))
    return items.withColumn("role", F.lit("item")).unionByName(
        sites.withColumn("role", F.lit("site"))
    )


@register
def normalize_keep(spark, folder):
    """Site type from a fixed table, unknown ones kept."""
    return roles.raw_sites(spark, folder).select(
        "site_id",
        map_value(F.lower("site_type"), roles.SITE_TYPES, F.col("site_type")).alias("site_type"),
    )


@register
def lenient_cast(spark, folder):
    """The last piece of each page address as a number, where it is one."""
    piece = F.element_at(F.split("url", "/"), -1)
    return roles.table(spark, folder, "pages").select(
        "page_id",
        to_number(piece).alias("number"),
        to_number(piece, fill=0, as_int=True).alias("whole_or_zero"),
    )


@register
def lenient_date(spark, folder):
    """The date text of each post, the as-of date where it is none."""
    parsed = to_date_lenient("posted_date")
    return roles.raw_posts(spark, folder).select(
        "post_id",
        to_date_lenient("posted_date", roles.AS_OF.date()).alias("posted_date"),
        parsed.isNull().alias("was_bad"),
    )


@register
def q_extract_code(spark, folder):
    """The top-level domain of example hosts on a subdomain of their own."""
    return roles.table(spark, folder, "pages").select(
        "page_id", extract_code("url", r"//m\.[a-z]+\.example\.([a-z]+)/", 1).alias("code")
    )


@register
def contains_flags(spark, folder):
    return roles.table(spark, folder, "documents").select(
        "doc_id",
        contains_flag("text", "License").alias("mentions_license"),
        contains_flag(F.nullif("lang", F.lit("de")), "EN").alias("is_english"),
    )


@register
def term_tags(spark, folder):
    """The terms of each text as a delimited list, and their number."""
    return roles.tagged_texts(spark, folder).select(
        "post_id",
        join_list("terms").alias("terms"),
        list_size(join_list("terms")).alias("term_count"),
    )


@register
def term_index(spark, folder):
    """The terms of each text, found by joining its word n-grams with a table of phrases."""
    docs = roles.documents(spark, folder).select("doc_id", "text")
    hits = phrase_hits(docs, "doc_id", "text", taxonomy_index(spark, roles.TAXONOMY))
    return hits.select(F.col("doc_id").alias("post_id"), "term")


@register
def q_keyword_ladder(spark, folder):
    return roles.raw_posts(spark, folder).select(
        "post_id",
        keyword_ladder("title", roles.LEVEL_RULES, fixed.DEFAULT_SENIORITY).alias("seniority"),
    )


@register
def tier_ladder(spark, folder):
    """Order lines per discount tier."""
    cuts = [(0.07, "high"), (0.04, "middle"), (0.02, "low")]
    tier = threshold_ladder("l_discount", cuts, "none")
    return marts.count_sum_by(
        roles.table(spark, folder, "lineitem").select(
            tier.alias("tier"), F.col("l_quantity").cast("bigint").alias("cases")
        ),
        "tier", "cases", "line_count", "total_cases",
    )


@register
def urgency_terms(spark, folder):
    urgent = gold.urgent_terms(roles.terms(spark, folder), roles.WORD_URGENCY)
    return urgent.orderBy(F.desc("frequency"), "term")


@register
def term_category(spark, folder):
    """Each distinct term of the posts with its category."""
    return (
        term_frequency(roles.tagged_texts(spark, folder))
        .withColumn("term_category", set_ladder("term", roles.WORDS, roles.DEFAULT_WORD_CATEGORY))
        .select("term", "term_category")
    )


@register
def with_audit(spark, folder):
    rows = roles.table(spark, folder, "supplier").select("s_suppkey", "s_name")
    return silver.with_audit(rows, roles.AS_OF, roles.SOURCE)


@register
def surrogate_key(spark, folder):
    """Orders numbered by date, then key."""
    orders = roles.table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return with_row_id(orders, ["o_orderdate", "o_orderkey"], "order_sk")


@register
def q_month_spine(spark, folder):
    """Lines shipped in each of the twelve months up to the last one, empty months included."""
    line = roles.table(spark, folder, "lineitem")
    spine = month_spine(line.agg(F.max("l_shipdate").alias("as_of")), "as_of")
    month = F.trunc(F.col("l_shipdate").cast("date"), "month")
    recent = line.filter(F.col("l_shipdate") >= first_month(_last_ship(line)))
    shipped = recent.groupBy(month.alias("_month")).agg(F.count(F.lit(1)).alias("lines"))
    return (
        spine.join(shipped, F.col("month_start") == F.col("_month"), "left")
        .drop("_month")
        .fillna(0, ["lines"])
    )


def _last_ship(line: DataFrame):
    return line.agg(F.max("l_shipdate")).scalar()


@register
def channel_split(spark, folder):
    """The quantity of each line cut into its channel shares, added up per item."""
    shares = {
        "on_premise": fixed.ON_PREMISE_SHARE,
        "off_premise": fixed.OFF_PREMISE_SHARE,
    }
    fact = roles.volumes(spark, folder).select("item", "total_cases")
    monthly = fact.withColumns(split_shares("total_cases", shares))
    return monthly.groupBy("item").agg(
        *(F.sum(c).alias(c) for c in ["total_cases", "on_premise", "off_premise"])
    )


# ---- joins -------------------------------------------------------------------


@register
def segment_split(spark, folder):
    return marts.segment_split(
        roles.items(spark, folder), "is_spirits", fixed.SPIRITS_LABEL, fixed.NON_SPIRITS_LABEL
    ).orderBy(F.desc("item_count"), "segment")


@register
def dense_grid(spark, folder):
    """Volume per month of the last twelve for each item and state seen in them, 0 where there
    was none."""
    last = _last_ship(roles.table(spark, folder, "lineitem"))
    fact = roles.state_volumes(spark, folder)
    return volumes.dense_series(
        fact, ["item", "state_code"], "l_shipdate", "total_cases", first_month(last), last
    ).select("year", "month", "item", "state_code", "total_cases")


# ---- items -------------------------------------------------------------------


@register
def category_mart(spark, folder):
    mart = marts.category_mart(roles.items(spark, folder), *gold.ITEM_MART)
    return mart.orderBy(F.desc("item_count"), "category")


@register
def category_names(spark, folder):
    """The item names of each category, in parts of a range of ids."""
    return marts.category_names(
        roles.items(spark, folder), "category", "item_name", "item_id", roles.LIST_IDS
    )


@register
def category_flagged_names(spark, folder):
    return marts.category_flagged_names(
        roles.items(spark, folder), "category", "is_flagship", "item_name", "item_id",
        roles.LIST_IDS,
    )


@register
def category_mart_ext(spark, folder):
    mart = marts.category_mart_ext(roles.items(spark, folder), *gold.ITEM_MART)
    return mart.orderBy(F.desc("item_count"), "category")


@register
def category_mart_first(spark, folder):
    mart = marts.category_mart_first(roles.items(spark, folder), *gold.ITEM)
    return mart.orderBy(F.desc("item_count"), "category")


@register
def category_distribution(spark, folder):
    return marts.distribution(roles.items(spark, folder), "category", "item_name").orderBy(
        F.desc("Item Count"), "Category"
    )


@register
def q_flag_pct(spark, folder):
    return flag_pct(roles.items(spark, folder), "is_flagship", "flagship_pct", "item_count")


@register
def item_rank(spark, folder):
    """Items ranked by size, overall and within their category, however many there are."""
    part = roles.sized_items(spark, folder)
    return with_ranks_large(part, "size", ["category"], "size_rank", "rank_in_category")


# ---- sites -------------------------------------------------------------------


@register
def region_type_mart(spark, folder):
    mart = marts.region_type_mart(roles.sites(spark, folder), *gold.SITE)
    return mart.orderBy("region", F.desc("site_count"), "site_type")


@register
def region_type_mart_ext(spark, folder):
    sites = roles.sites_with_year(spark, folder)
    mart = marts.region_type_mart_ext(sites, *gold.SITE, "year_established")
    return mart.orderBy("region", F.desc("site_count"), "site_type")


@register
def region_type_mart_basic(spark, folder):
    mart = marts.region_type_mart_basic(
        roles.sites(spark, folder), "region", "site_type", "site_name", "headcount", "country"
    )
    return mart.orderBy("region", F.desc("site_count"), "site_type")


@register
def region_summary(spark, folder):
    sites = roles.sites(spark, folder)
    return marts.region_summary(sites, "region", "site_name", "headcount", "country")


@register
def region_rollup(spark, folder):
    mart = marts.region_type_mart(roles.sites(spark, folder), *gold.SITE)
    return marts.region_rollup(mart, "region").orderBy(F.desc("total_headcount"), "region")


@register
def region_headcount(spark, folder):
    sums = marts.sum_by(roles.sites(spark, folder), "region", "headcount", "total_headcount")
    return sums.orderBy(F.desc("total_headcount"), "region")


@register
def type_breakdown(spark, folder):
    sites = roles.sites(spark, folder)
    return marts.count_sum_by(sites, "site_type", "headcount", "site_count", "headcount").orderBy(
        F.desc("site_count"), "site_type"
    )


@register
def top_sites(spark, folder):
    sites = roles.sites(spark, folder).select(
        "site_id", "site_name", "country", "site_type", "headcount"
    )
    return top_k(sites, "headcount", 8, "site_id")


# ---- posts and terms ---------------------------------------------------------

POST = ("department", "is_remote", "is_hybrid", "term_count")


@register
def department_mart(spark, folder):
    mart = marts.department_mart(roles.posts(spark, folder), *POST)
    return mart.orderBy(F.desc("post_count"), "department")


@register
def department_levels(spark, folder):
    """The level of each post of a department, in parts of a range of ids."""
    return marts.department_levels(
        roles.untagged_posts(spark, folder), "department", "seniority", "post_id", roles.LIST_IDS
    )


@register
def department_mart_ext(spark, folder):
    mart = marts.department_mart_ext(roles.posts(spark, folder), *POST)
    return mart.orderBy(F.desc("post_count"), "department")


@register
def dept_seniority(spark, folder):
    posts = roles.untagged_posts(spark, folder)
    return marts.cross_counts(posts, "department", "seniority").orderBy(
        F.desc("Count"), "department", "seniority"
    )


@register
def seniority_split(spark, folder):
    posts = roles.untagged_posts(spark, folder)
    return share_of_total(posts, ["seniority"], "post_count", "pct").orderBy(
        F.desc("post_count"), "seniority"
    )


@register
def work_mode(spark, folder):
    return marts.work_mode(roles.untagged_posts(spark, folder), "is_remote", "is_hybrid")


@register
def list_size_stats(spark, folder):
    stats = marts.size_stats(roles.posts(spark, folder), "department", "term_count")
    return stats.orderBy(F.desc("avg_terms"), "department")


@register
def q_term_frequency(spark, folder):
    return term_frequency(roles.tagged_texts(spark, folder))


@register
def skill_tags(spark, folder):
    """The fixed skill patterns over every document."""
    tagged = tag_terms(roles.skill_texts(spark, folder), "text", skill_taxonomy(), "skills")
    return tagged.select("doc_id", join_list("skills").alias("skills"))


@register
def q_term_pairs(spark, folder):
    return term_pairs(roles.tagged_texts(spark, folder), ["post_id", "title"])


@register
def terms_by_category(spark, folder):
    by_category = marts.terms_by_category(roles.terms(spark, folder))
    return by_category.orderBy(F.desc("total_mentions"), "term_category")


@register
def term_rank(spark, folder):
    ranked = gold.ranked_terms(roles.terms(spark, folder))
    return ranked.orderBy(F.desc("frequency"), "term")


@register
def term_rank_ext(spark, folder):
    ranked = gold.ranked_terms_ext(roles.terms(spark, folder))
    return ranked.orderBy(F.desc("frequency"), "term")


@register
def top_k_terms(spark, folder):
    return top_k(roles.terms(spark, folder), "frequency", 30, "term")


@register
def top_chart_terms(spark, folder):
    names = {
        "term": "Term",
        "frequency": "Frequency",
        "pct_of_posts": "% of Posts",
        "term_category": "Category",
        "demand_tier": "Demand Tier",
    }
    top = top_k(roles.terms(spark, folder), "frequency", 20, "term")
    return top.select(*(F.col(c).alias(n) for c, n in names.items()))


@register
def top_term(spark, folder):
    terms = term_frequency(roles.tagged_texts(spark, folder))
    best = F.min_by(F.struct("term", "frequency", "pct_of_posts"), F.struct(-F.col("frequency"), "term"))
    return terms.agg(best.alias("_best")).select("_best.*")


@register
def tier1_terms(spark, folder):
    return (
        gold.wanted_terms(roles.terms(spark, folder))
        .filter(F.col("demand_tier") == fixed.TIER_1)
        .select("term", "frequency", "pct_of_posts")
        .orderBy(F.desc("pct_of_posts"), "term")
    )


# ---- volumes -----------------------------------------------------------------


@register
def volume_trend(spark, folder):
    """Monthly totals per item and price tier; the label is made from the grouped months."""
    keys = [key for key in gold.TREND_KEYS if key != "month_label"]
    trend = volumes.volume_trend(roles.volumes(spark, folder), keys, gold.TREND_MEASURES)
    label = month_parts(F.make_date("year", "month", F.lit(1)))["month_label"]
    return trend.withColumn("month_label", label).orderBy("item", "year", "month", "price_tier")


@register
def volume_merge(spark, folder):
    """A trend of the lines up to a date, with the months after it merged in."""
    keys = ["item", "year", "month", "price_tier"]
    facts = roles.volumes(spark, folder)
    until = F.col("l_shipdate") < F.lit(roles.MERGE_FROM)
    old = volumes.volume_trend(facts.filter(until), keys, gold.TREND_MEASURES)
    new = volumes.volume_trend(facts.filter(~until), keys, gold.TREND_MEASURES)
    return volumes.merge_months(old, new, keys, list(gold.TREND_MEASURES.values()))


@register
def volume_ledger(spark, folder):
    """A trend kept by batches of months, one of which is delivered twice."""
    keys = ["item", "year", "month", "price_tier"]
    sums = list(gold.TREND_MEASURES.values())
    facts = roles.volumes(spark, folder)
    path = fresh_path(spark, "trend")
    until = F.col("l_shipdate") < F.lit(roles.MERGE_FROM)
    for batch, rows in (("early", until), ("late", ~until), ("late", ~until)):
        new = volumes.volume_trend(facts.filter(rows), keys, gold.TREND_MEASURES)
        trend = volumes.merge_batch(new, batch, path, keys, sums)
    return trend.select(*keys, *sums)


@register
def flag_summary(spark, folder):
    facts = roles.state_volumes(spark, folder)
    summary = volumes.flag_summary(facts, "item", "is_control_state", "state_code", "total_cases")
    return summary.orderBy("item", F.desc("state_type"))


@register
def share_metrics(spark, folder):
    return volumes.share_metrics(
        roles.state_volumes(spark, folder), ["item", "category"], "category", "state_code",
        "total_cases", roles.table(spark, folder, "nation"),
    )


# ---- KPIs --------------------------------------------------------------------


def _sources(spark, folder) -> list[DataFrame]:
    """Items, sites, posts and terms. The texts are tagged once: posts without their text are
    written, and the term table comes from the written terms."""
    posts = written(roles.posts(spark, folder).drop("description"), "tagged-posts")
    return [
        roles.items(spark, folder),
        roles.sites(spark, folder),
        posts,
        roles.term_table_of(posts),
    ]


@register
def kpi_core(spark, folder):
    return kpis.kpi_table(*_sources(spark, folder))


@register
def kpi_text(spark, folder):
    return kpis.kpi_text(*_sources(spark, folder), home=roles.HOME_COUNTRY)


@register
def kpi_exec(spark, folder):
    return kpis.kpi_exec(
        *_sources(spark, folder),
        as_of=roles.AS_OF.date(),
        home=roles.HOME_COUNTRY,
        data_pattern=roles.DATA_DEPARTMENTS,
    )


# ---- dedupe and quality ------------------------------------------------------


@register
def q_dedupe_first(spark, folder):
    """The first post of each title and department."""
    posts = roles.raw_posts(spark, folder).select(
        "post_id", strip("title").alias("title"), "department"
    )
    return dedupe_first(posts, ["title", "department"], ["post_id"])


def _dq_reports(spark, folder) -> list[DataFrame]:
    items = roles.items(spark, folder).withColumn(
        "category", F.nullif("category", F.lit("Uncategorized"))
    )
    sites = roles.raw_sites(spark, folder)
    return [
        quality.dq_checks(
            items, "items", ["item_name", "category", "supplier"], ["item_name"], roles.AS_OF
        ),
        quality.dq_checks(
            sites, "sites", ["site_name", "latitude"], ["site_id"], roles.AS_OF
        ),
        quality.dq_checks(sites.filter("site_id < 0"), "none", ["site_name"], [], roles.AS_OF),
    ]


@register
def dq_report(spark, folder):
    first, *others = _dq_reports(spark, folder)
    for other in others:
        first = first.unionByName(other)
    return first


@register
def dq_summary(spark, folder):
    summary = quality.dq_summary(dq_report(spark, folder))
    return summary.withColumn("issues", F.to_json("issues"))


#: Checks of which two cannot give a result.
READ_OUTS = {
    "sites": "SELECT count(*) AS n FROM mw_customer",
    "segments": "SELECT c_mktsegment AS segment, count(*) AS n FROM mw_customer "
    "GROUP BY c_mktsegment ORDER BY n DESC, segment LIMIT 3",
    "no such table": "SELECT count(*) AS n FROM mw_customer_of_next_year",
    "fails when run": "SELECT sum(CAST(c_name AS INT)) AS n FROM mw_customer",
    "none": "SELECT c_custkey FROM mw_customer WHERE c_custkey < 0",
}


@register
def read_outs(spark, folder):
    """Named checks run together; what fails is a row of the report."""
    roles.table(spark, folder, "customer").createOrReplaceTempView("mw_customer")
    report = quality.run_checks(spark, READ_OUTS, fresh_path(spark, "read-outs"))
    return report.select("label", "nth", "record", F.col("error").isNotNull().alias("failed"))


@register
def table_counts(spark, folder):
    names = ["part", "customer", "documents", "lineitem", "orders", "pages"]
    return quality.table_counts({name: roles.table(spark, folder, name) for name in names})


# ---- cleaning jobs -----------------------------------------------------------


@register
def clean_items(spark, folder):
    return silver.clean_items(
        roles.raw_items(spark, folder), roles.AS_OF, roles.SOURCE,
        roles.ITEM_CATEGORIES, roles.CORE_CATEGORIES,
    )


@register
def clean_sites(spark, folder):
    return silver.clean_sites(
        roles.raw_sites(spark, folder), roles.AS_OF,
        regions=roles.regions(spark, folder), types=roles.SITE_TYPES,
    )


@register
def clean_posts(spark, folder):
    """Tag the raw texts, then clean."""
    raw = roles.raw_posts(spark, folder, roles.documents(spark, folder))
    raw = tag_terms(raw, "description", roles.TAXONOMY)
    return silver.clean_posts(
        raw.withColumn("terms", join_list("terms")), roles.AS_OF, roles.LEVEL_RULES,
        remote_word="en", hybrid_word="fr", state_pattern=r"^([a-z])",
    )


@register
def clean_terms(spark, folder):
    frequency = term_frequency(roles.tagged_texts(spark, folder)).select(
        "term", F.col("frequency").cast("string"), F.col("pct_of_posts").cast("string")
    )
    return silver.clean_terms(
        frequency, roles.AS_OF, roles.WORD_TIERS, fixed.TIER_4, roles.WORDS,
        roles.DEFAULT_WORD_CATEGORY,
    )


@register
def clean_jobs(spark, folder):
    """The four cleaning jobs with their checks: their rows of the log."""
    log = fresh_path(spark, "cleaning-log")
    none = F.lit(None).cast("string")
    raw = {
        cleaning.item_job(
            roles.SOURCE, categories=roles.ITEM_CATEGORIES, flagged=roles.CORE_CATEGORIES
        ): roles.raw_items(spark, folder),
        cleaning.site_job(
            regions=roles.regions(spark, folder), types=roles.SITE_TYPES
        ): roles.raw_sites(spark, folder),
        cleaning.post_job(
            roles.AS_OF, ladder=roles.LEVEL_RULES
        ): roles.raw_posts(spark, folder).withColumn("terms", none),
        cleaning.term_job(): roles.terms(spark, folder).select("term", "frequency", "pct_of_posts"),
    }
    for job, rows in raw.items():
        cleaning.run_job(rows, job, fresh_path(spark, job.name), roles.AS_OF, log, "first run")
    return quality.read_log(spark, log).withColumn("issues", F.array_join("issues", "; "))


@register
def warehouse_build(spark, folder):
    """The whole warehouse loaded twice, the second time with the flagship items only: rows of each
    exported view after the second load, its number, and how many tables the log has for it."""
    house = gold.Warehouse(spark, fresh_path(spark, "warehouse"))
    items, volumes_ = roles.items(spark, folder), roles.state_volumes(spark, folder)
    shares = share_metrics(spark, folder)
    tables = {
        specs.DIM_ITEM: items,
        specs.DIM_SITE: roles.sites(spark, folder),
        specs.FACT_POSTS: roles.posts(spark, folder).withColumn("terms", join_list("terms")),
        specs.FACT_TERMS: roles.terms(spark, folder),
        specs.FACT_VOLUMES: volumes_.withColumn("state_name", F.col("state_code")),
        specs.FACT_SHARES: shares,
    }
    latest = {
        "dim_item": "item_id", "dim_site": "site_id", "fact_posts": "post_id",
        "fact_terms": "frequency",
    }
    house.build(tables, roles.AS_OF, latest, run="first")
    again = {specs.DIM_ITEM: items.filter("is_flagship")}
    result = house.build(
        again, roles.AS_OF, latest, export_to=fresh_path(spark, "marts"), run="second"
    )
    log = quality.read_log(spark, house.path(specs.DQ_LOG.name)).groupBy("run").count().collect()
    logged = {r["run"]: r["count"] for r in log}
    version = live_version(spark, house.root)
    rows = [
        (name, count, version, logged["first"], logged["second"])
        for name, count in result["exported"].items()
    ]
    schema = "view string, row_count bigint, version bigint, logged_first bigint, logged_second bigint"
    return spark.createDataFrame(rows, schema)
