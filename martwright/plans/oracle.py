"""For each registered query the SQL (DuckDB) that must give the same rows."""

from __future__ import annotations

from martwright import fixed
from martwright.functions.text import WHITESPACE
from martwright.operators.shares import LIST_WIDTH
from martwright.plans import roles


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "(" + ", ".join(_text(v) for v in values) + ")"


def _lookup(key: str, table: dict[str, str], default: str) -> str:
    cases = " ".join(f"WHEN {_text(k)} THEN {_text(v)}" for k, v in table.items())
    return f"CASE {key} {cases} ELSE {default} END"


def _cuts(value: str, cuts, default: str) -> str:
    cases = " ".join(f"WHEN {value} >= {cut} THEN {_text(label)}" for cut, label in cuts)
    return f"CASE {cases} ELSE {_text(default)} END"


def _sets(value: str, sets, default: str) -> str:
    cases = " ".join(f"WHEN {value} IN {_list(v)} THEN {_text(k)}" for k, v in sets.items())
    return f"CASE {cases} ELSE {_text(default)} END"


def _keywords(value: str, rules, default: str) -> str:
    cases = " ".join(
        "WHEN "
        + " OR ".join(f"contains(lower({value}), {_text(word)})" for word in words)
        + f" THEN {_text(label)}"
        for label, words in rules
    )
    return f"CASE {cases} ELSE {_text(default)} END"


# Patterns of the references that the given pages hold, the ampersand last.
ENTITIES = [
    ("&lt;?", "<"),
    ("&gt;?", ">"),
    ("&quot;?", '"'),
    ("&#39;?", "'"),
    ("&apos;", "'"),
    ("&nbsp;?", "\xa0"),
    ("&copy;?", "©"),
    ("&middot;?", "·"),
    ("&amp;?", "&"),
]


_SPACE = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)


def _strip(value: str) -> str:
    return f"trim({value}, {_SPACE})"


def _title(value: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all(lower({value}), "
        r"'\p{L}+|[^\p{L}]+'), lambda run: upper(substr(run, 1, 1)) || substr(run, 2)), '')"
    )


def _html(value: str) -> str:
    text = _strip(rf"regexp_replace({value}, '\s*(?:<[^>]*>\s*)+', '', 'g')")
    for entity, char in ENTITIES:
        text = f"regexp_replace({text}, {_text(entity)}, {_text(char)}, 'g')"
    return text


def _pieces(value: str) -> str:
    piece = _strip("piece")
    for entity, char in ENTITIES:
        piece = f"regexp_replace({piece}, {_text(entity)}, {_text(char)}, 'g')"
    pieces = f"regexp_split_to_array({value}, '<[^>]*>')"
    return f"array_to_string(list_transform({pieces}, lambda piece: {piece}), '')"


def _pct(part: str, whole: str) -> str:
    return f"round(CAST({part} AS DOUBLE) * 100.0 / nullif(CAST({whole} AS DOUBLE), 0), 1)"


def _number(value: str) -> str:
    plain = r"'^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$'"
    return (
        f"CASE WHEN regexp_matches({_strip(value)}, {plain}) "
        f"THEN TRY_CAST({_strip(value)} AS DOUBLE) END"
    )


def _isum(value: str) -> str:
    return f"CAST(sum({value}) AS BIGINT)"


# A whole word with its neighbours spelled out: \b in DuckDB knows ASCII letters only.
def _word(text: str, word: str) -> str:
    pattern = rf"(?i)(^|[^\p{{L}}\p{{N}}_]){word}($|[^\p{{L}}\p{{N}}_])"
    return f"CASE WHEN regexp_matches({text}, {_text(pattern)}) THEN {_text(word)} END"


_AS_OF = f"TIMESTAMP '{roles.AS_OF:%Y-%m-%d %H:%M:%S}'"
_AS_OF_DATE = f"DATE '{roles.AS_OF:%Y-%m-%d}'"
_CATEGORY = _lookup(
    f"lower({_strip('p_type')})", roles.ITEM_CATEGORIES, _text(fixed.DEFAULT_CATEGORY)
)

ITEMS = f"""items AS (
  SELECT item_id, item_name, category, category_raw, is_flagship, size,
         category IN {_list(roles.CORE_CATEGORIES)} AS is_spirits
  FROM (SELECT p_partkey AS item_id, {_title(_strip("p_name"))} AS item_name,
               {_CATEGORY} AS category, p_type AS category_raw, p_size AS size,
               p_size >= {roles.FLAGSHIP_SIZE} AS is_flagship FROM part))"""

SITES = f"""sites AS (
  SELECT c_custkey AS site_id, c_name AS site_name, n_name AS country, r_name AS region,
         {_lookup("lower(c_mktsegment)", roles.SITE_TYPES, "c_mktsegment")} AS site_type,
         CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS latitude,
         CASE WHEN c_nationkey <> 7 THEN CAST(c_nationkey AS DOUBLE) END AS longitude,
         CAST(trunc(c_acctbal) AS BIGINT) AS headcount
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

REGIONS = f"""regions AS (
  SELECT n_name AS country, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey
  WHERE r_name <> '{roles.UNMAPPED_REGION}')"""

RAW_SITES = f"""raw_sites AS (
  SELECT c_custkey AS site_id, c_name AS site_name, n_name AS country, c_mktsegment AS site_type_raw,
         CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS latitude,
         CASE WHEN c_nationkey <> 7 THEN CAST(c_nationkey AS DOUBLE) END AS longitude,
         CAST(trunc(c_acctbal) AS BIGINT) AS headcount
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

_TAGS = ",\n         ".join(_word("text", term.name) for term in roles.TAXONOMY)
_POSTED = (
    "'2025-' || lpad(CAST(n_chars % 14 AS VARCHAR), 2, '0') || '-' || "
    "lpad(CAST(doc_id % 31 AS VARCHAR), 2, '0')"
)

RAW_POSTS = f"""raw_posts AS (
  SELECT doc_id AS post_id, {_strip("split_part(text, chr(10), 1)")} AS title,
         source AS department, lang AS location, {_POSTED} AS posted_date, text AS description,
         contains(lower(lang), 'en') AS is_remote, contains(lower(lang), 'fr') AS is_hybrid,
         {_keywords("split_part(text, chr(10), 1)", roles.LEVEL_RULES, fixed.DEFAULT_SENIORITY)}
           AS seniority
  FROM documents)"""

POSTS = f"""{RAW_POSTS},
posts AS (
  SELECT r.*, terms, len(terms) AS term_count FROM raw_posts r JOIN (
    SELECT doc_id, list_filter([
         {_TAGS}], lambda t: t IS NOT NULL) AS terms FROM documents) ON doc_id = post_id)"""

FREQUENCY = f"""{POSTS},
frequency AS (
  SELECT term, count(*) AS frequency,
         {_pct("count(*)", "(SELECT count(*) FROM documents)")} AS pct_of_posts
  FROM (SELECT unnest(terms) AS term FROM posts) GROUP BY term)"""

TERMS = f"""{FREQUENCY},
terms AS (
  SELECT term, frequency, pct_of_posts,
         {_cuts("pct_of_posts", roles.WORD_TIERS, fixed.TIER_4)} AS demand_tier,
         {_sets("term", roles.WORDS, roles.DEFAULT_WORD_CATEGORY)} AS term_category
  FROM frequency)"""
_WANTED = f"demand_tier IN {_list([fixed.TIER_1, fixed.TIER_2])}"

_ON = f"l_returnflag IN {_list(roles.ON_PREMISE_FLAGS)}"
_FACT = f"""SELECT year(l_shipdate) AS year, month(l_shipdate) AS month,
         strftime(l_shipdate, '%b %Y') AS month_label, l_shipdate, p_brand AS item,
         {_CATEGORY} AS category,
         {_cuts("p_retailprice", roles.PRICE_TIERS, roles.DEFAULT_PRICE_TIER)} AS price_tier,
         CAST(l_quantity AS BIGINT) AS total_cases,
         CASE WHEN {_ON} THEN CAST(l_quantity AS BIGINT) ELSE 0 END AS on_premise,
         CASE WHEN {_ON} THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS off_premise"""
VOLUMES = f"""volumes AS ({_FACT} FROM lineitem JOIN part ON l_partkey = p_partkey)"""
STATE_VOLUMES = f"""volumes AS ({_FACT}, n_name AS state_code,
         n_name IN {_list(roles.CONTROL_STATES)} AS is_control_state
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

SPINE = """spine AS (
  SELECT CAST(unnest(generate_series(
           date_trunc('month', (SELECT max(l_shipdate) FROM lineitem)) - INTERVAL 11 MONTH,
           date_trunc('month', (SELECT max(l_shipdate) FROM lineitem)),
           INTERVAL 1 MONTH)) AS DATE) AS month_start)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _kpis(rows: list[tuple[str, str, str, str]], value) -> str:
    return " UNION ALL ".join(
        f"SELECT {_text(name)} AS kpi, {value(agg)} AS value, {_text(category)} AS category "
        f"FROM {source}"
        for name, agg, category, source in rows
    )


def _text_value(agg: str) -> str:
    return f"CAST({agg} AS VARCHAR)"


ORACLE_SQL: dict[str, str] = {}

# ---- sources and sinks

ORACLE_SQL["optional_scan"] = "SELECT s_suppkey, s_name, s_nationkey FROM supplier"
ORACLE_SQL["sql_scan"] = _with(ITEMS) + f"""
SELECT category, count(*) AS item_count, {_isum("CAST(is_flagship AS INT)")} AS flagged_count,
       {_pct("count(*)", "(SELECT count(*) FROM items)")} AS pct_of_items,
       CASE WHEN bool_or(is_spirits) THEN '{fixed.SPIRITS_LABEL}'
            ELSE '{fixed.NON_SPIRITS_LABEL}' END AS type
FROM items GROUP BY category"""
ORACLE_SQL["source_fallback"] = """
SELECT c_custkey AS id, c_name AS name, 'few' AS "case" FROM customer
UNION ALL SELECT s_suppkey, s_name, 'enough' FROM supplier"""
# Blank texts and the words for a missing value are read as null.
ORACLE_SQL["csv_split_scan"] = f"""
SELECT doc_id, nullif(lang, '') AS lang, nullif(source, '') AS source, n_chars,
       md5(CASE WHEN text NOT IN {_list(['', *fixed.NULL_TOKENS])} THEN text END) AS text_md5
FROM documents"""
ORACLE_SQL["page_cards"] = rf"""
WITH cards AS (
  SELECT page_id, url, unnest(regexp_extract_all(html, '(?s)<article>(.*?)</article>', 1)) AS card,
         generate_subscripts(regexp_extract_all(html, '(?s)<article>(.*?)</article>', 1), 1)
           AS card_no
  FROM pages)
SELECT page_id, CAST(card_no AS INTEGER) AS card_no,
       nullif({_html("regexp_extract(card, '(?s)<h[1-6][^>]*>(.*?)</h[1-6]>', 1)")}, '') AS name,
       coalesce(nullif({_html(
           "regexp_extract(card, '(?s)<span class=" + '"category"' + ">(.*?)</span>', 1)"
       )}, ''), 'Unknown') AS category,
       coalesce(nullif({_html("regexp_extract(card, '(?s)<p>(.*?)</p>', 1)")}, ''), '')
         AS description,
       coalesce(nullif({_html(
           "regexp_extract(card, '<a [^>]*href=" + '"([^"]*)"' + "', 1)"
       )}, ''), url) AS link
FROM cards
WHERE nullif({_html("regexp_extract(card, '(?s)<h[1-6][^>]*>(.*?)</h[1-6]>', 1)")}, '')
      IS NOT NULL"""
ORACLE_SQL["page_links"] = rf"""
WITH cards AS (
  SELECT page_id, url, unnest(regexp_extract_all(html, '(?s)<li>(.*?)</li>', 1)) AS card,
         generate_subscripts(regexp_extract_all(html, '(?s)<li>(.*?)</li>', 1), 1) AS card_no
  FROM pages),
found AS (
  SELECT page_id, CAST(card_no AS INTEGER) AS card_no,
         nullif({_html("regexp_extract(card, '(?s)<a [^>]*>(.*?)</a>', 1)")}, '') AS name,
         coalesce(nullif({_html(
             "regexp_extract(card, '<a href=" + '"([^"]*)"' + "', 1)"
         )}, ''), url) AS link
  FROM cards)
SELECT * FROM found WHERE name IS NOT NULL"""
# A paragraph that another one follows before its close is never closed in these pages, so it
# goes to the end of the article.
ORACLE_SQL["page_elements"] = rf"""
WITH parts AS (
  SELECT page_id, url, list_concat(
    regexp_extract_all(html, '(?s)<li>(.*?)</li>', 1),
    regexp_extract_all(html, '(?s)<div class="ad">(.*?)</div>', 1),
    regexp_extract_all(html, '(?s)<article>(.*?)</article>', 1)) AS parts FROM pages),
cards AS (
  SELECT page_id, url, unnest(parts) AS card, generate_subscripts(parts, 1) AS card_no FROM parts),
found AS (
  SELECT *, regexp_extract(card, '(?s)<p>(.*)$', 1) AS behind FROM cards)
SELECT page_id, CAST(card_no AS INTEGER) AS card_no,
       CASE WHEN regexp_matches(card, '<(h1|a)[ >]')
         THEN {_html("regexp_extract(card, '(?s)<(?:h1|a)[^>]*>(.*?)</(?:h1|a)>', 1)")} END AS name,
       CASE WHEN contains(card, '<p>') THEN {_pieces("""
         CASE WHEN regexp_matches(behind, '(?s)^[^<]*(<b>[^<]*)?</p>') OR NOT contains(behind, '<p>')
           THEN regexp_extract(behind, '(?s)^(.*?)(</p>|$)', 1) ELSE behind END""")}
         END AS description,
       CASE WHEN contains(card, '<a href') THEN regexp_extract(card, '<a href="([^"]*)"', 1)
         ELSE url END AS link
FROM found"""
ORACLE_SQL["title_lines"] = f"""
WITH lines AS (
  SELECT doc_id, source AS source_url,
         {_strip(f"substring(text, 1, {fixed.TITLE_DESCRIPTION_CHARS})")} AS description,
         unnest(regexp_extract_all(text, {_text(roles.TITLE_PATTERN)}, 1)) AS line,
         generate_subscripts(regexp_extract_all(text, {_text(roles.TITLE_PATTERN)}, 1), 1) AS pos
  FROM documents),
titles AS (SELECT *, {_strip("line")} AS title FROM lines)
SELECT title, doc_id, source_url, description FROM titles
WHERE {" OR ".join(f"contains(lower(title), {_text(w)})" for w in roles.TITLE_WORDS)}
QUALIFY row_number() OVER (PARTITION BY title ORDER BY doc_id, pos) = 1"""
ORACLE_SQL["load_refresh"] = _with(ITEMS) + """
SELECT item_id, item_name, category, category_raw, CAST(is_flagship AS INT) AS is_flagship,
       CAST(is_spirits AS INT) AS is_spirits, CAST(0 AS INT) AS has_description FROM items"""
ORACLE_SQL["upsert_latest"] = """
SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey
                           ORDER BY o_orderstatus <> 'F' DESC, o_orderkey DESC) = 1"""
ORACLE_SQL["constraint_check"] = _with(ITEMS) + """,
bad AS (SELECT item_id, item_name, nullif(category, 'Uncategorized') AS category,
               length(item_name) % 3 AS is_flagship FROM items)
SELECT 'dim_item' AS table_name, unnest(['NOT NULL item_id', 'NOT NULL item_name',
         'NOT NULL category', 'CHECK is_flagship IN (0,1)', 'CHECK is_spirits IN (0,1)',
         'CHECK has_description IN (0,1)', 'UNIQUE item_id', 'UNIQUE item_name, category']) AS rule,
       unnest([count(*) FILTER (item_id IS NULL), count(*) FILTER (item_name IS NULL),
         count(*) FILTER (category IS NULL), count(*) FILTER (is_flagship NOT IN (0, 1)), 0, 0,
         count(*) - count(DISTINCT item_id),
         count(*) - count(DISTINCT row(item_name, category))]) AS violations
FROM bad""".replace("\n,\nbad", ",\nbad")
ORACLE_SQL["json_records"] = _with(ITEMS) + f"""
SELECT CAST(json_object('category', category, 'item_count', item_count,
         'flagged_count', flagged_count, 'kind_flag', kind_flag, 'pct_of_items', pct_of_items)
         AS VARCHAR) AS record
FROM (SELECT category, count(item_name) AS item_count,
             {_isum("CAST(is_flagship AS INT)")} AS flagged_count,
             arg_min(is_spirits, item_id) AS kind_flag,
             {_pct("count(item_name)", "(SELECT count(item_name) FROM items)")} AS pct_of_items
      FROM items GROUP BY category)"""

# ---- projections and filters

ORACLE_SQL["geo_map"] = _with(SITES) + """
SELECT site_name AS "Site", country AS "Country", region AS "Region", site_type AS "Type",
       latitude AS "Latitude", longitude AS "Longitude", headcount AS "Headcount" FROM sites"""
ORACLE_SQL["flagship_list"] = (
    _with(ITEMS) + "SELECT item_id, item_name, category FROM items WHERE is_flagship"
)
ORACLE_SQL["top_terms"] = _with(TERMS) + f"SELECT * FROM terms WHERE {_WANTED}"
ORACLE_SQL["invalid_coords"] = _with(RAW_SITES) + """
SELECT site_id, site_name, latitude, longitude FROM raw_sites
WHERE latitude IS NULL OR longitude IS NULL"""
ORACLE_SQL["both_terms"] = """
SELECT count(*) AS rows_with_all FROM documents
WHERE text ILIKE '%that%' AND text ILIKE '%with%'"""
ORACLE_SQL["singleton_groups"] = _with(RAW_POSTS) + """
SELECT title, count(*) AS item_count FROM raw_posts GROUP BY title HAVING count(*) = 1"""
ORACLE_SQL["terms_in_category"] = _with(TERMS) + """
SELECT term, frequency, pct_of_posts FROM terms WHERE term_category = 'French words'"""

# ---- scalar functions

ORACLE_SQL["clean_text"] = f"""
SELECT doc_id,
       {_strip("' ' || chr(10) || chr(9) || text || '  ' || chr(13) || chr(10)")} AS stripped,
       {_strip(f"substring(text, 1, {fixed.SHORT_TEXT_CHARS})")} AS short_text,
       coalesce(length(nullif(lang, 'de')) > 1, false) AS has_language,
       coalesce(nullif(lang, 'fr'), 'unknown') AS language
FROM documents"""
ORACLE_SQL["title_case"] = (
    f"SELECT p_partkey, {_title("p_name || '''s ' || p_brand || ' 7x'")} AS display_name FROM part"
)
ORACLE_SQL["normalize_lookup"] = _with(ITEMS, RAW_SITES, REGIONS) + f"""
SELECT item_id AS id, category AS label, is_spirits AS is_member, 'item' AS role FROM items
UNION ALL
SELECT site_id, coalesce(region, '{fixed.DEFAULT_REGION}'),
       coalesce(region IN ('ASIA', 'EUROPE'), false), 'site'
FROM raw_sites LEFT JOIN regions USING (country)"""
ORACLE_SQL["normalize_keep"] = _with(SITES) + "SELECT site_id, site_type FROM sites"
ORACLE_SQL["lenient_cast"] = f"""
SELECT page_id, {_number("split_part(url, '/', -1)")} AS number,
       CAST(trunc(coalesce({_number("split_part(url, '/', -1)")}, 0)) AS BIGINT) AS whole_or_zero
FROM pages"""
ORACLE_SQL["lenient_date"] = f"""
SELECT doc_id AS post_id, coalesce(TRY_CAST({_POSTED} AS DATE), {_AS_OF_DATE}) AS posted_date,
       TRY_CAST({_POSTED} AS DATE) IS NULL AS was_bad FROM documents"""
ORACLE_SQL["extract_code"] = r"""
SELECT page_id, nullif(regexp_extract(url, '//m\.[a-z]+\.example\.([a-z]+)/', 1), '') AS code
FROM pages"""
ORACLE_SQL["contains_flags"] = """
SELECT doc_id, text ILIKE '%license%' AS mentions_license,
       coalesce(nullif(lang, 'de') ILIKE '%en%', false) AS is_english FROM documents"""
ORACLE_SQL["term_tags"] = _with(POSTS) + """
SELECT post_id, array_to_string(terms, '|') AS terms, CAST(term_count AS INTEGER) AS term_count
FROM posts"""
ORACLE_SQL["keyword_ladder"] = _with(RAW_POSTS) + "SELECT post_id, seniority FROM raw_posts"
ORACLE_SQL["tier_ladder"] = f"""
SELECT {_cuts("l_discount", [(0.07, "high"), (0.04, "middle"), (0.02, "low")], "none")} AS tier,
       count(*) AS line_count, {_isum("CAST(l_quantity AS BIGINT)")} AS total_cases
FROM lineitem GROUP BY 1"""
ORACLE_SQL["urgency_terms"] = _with(TERMS) + f"""
SELECT *, {_cuts("pct_of_posts", roles.WORD_URGENCY, fixed.DEFAULT_URGENCY)} AS urgency_label
FROM terms WHERE {_WANTED}"""
ORACLE_SQL["term_category"] = _with(TERMS) + "SELECT term, term_category FROM terms"
ORACLE_SQL["with_audit"] = f"""
SELECT s_suppkey, s_name, {_AS_OF} AS processed_at, '{roles.SOURCE}' AS data_source FROM supplier"""
ORACLE_SQL["surrogate_key"] = """
SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS order_sk
FROM orders"""
ORACLE_SQL["month_spine"] = _with(SPINE) + """
SELECT month_start, CAST(year(month_start) AS INTEGER) AS year,
       CAST(month(month_start) AS INTEGER) AS month,
       strftime(month_start, '%b %Y') AS month_label,
       (SELECT count(*) FROM lineitem WHERE date_trunc('month', l_shipdate) = month_start) AS lines
FROM spine"""
ORACLE_SQL["channel_split"] = _with(VOLUMES) + f"""
SELECT item, {_isum("total_cases")} AS total_cases,
       {_isum(f"CAST(trunc(total_cases * CAST({fixed.ON_PREMISE_SHARE} AS DOUBLE)) AS BIGINT)")}
         AS on_premise,
       {_isum(f"CAST(trunc(total_cases * CAST({fixed.OFF_PREMISE_SHARE} AS DOUBLE)) AS BIGINT)")}
         AS off_premise
FROM volumes GROUP BY item"""

# ---- joins

ORACLE_SQL["segment_split"] = _with(ITEMS) + f"""
SELECT CASE WHEN is_spirits THEN '{fixed.SPIRITS_LABEL}' ELSE '{fixed.NON_SPIRITS_LABEL}' END
         AS segment,
       count(*) AS item_count, {_pct("count(*)", "(SELECT count(*) FROM items)")} AS pct
FROM items GROUP BY 1"""
ORACLE_SQL["dense_grid"] = _with(STATE_VOLUMES, SPINE) + f"""
SELECT CAST(year(month_start) AS INTEGER) AS year, CAST(month(month_start) AS INTEGER) AS month,
       b.item, b.state_code, CAST(coalesce(sum(total_cases), 0) AS BIGINT) AS total_cases
FROM spine CROSS JOIN (SELECT DISTINCT item, state_code FROM volumes
                       WHERE l_shipdate >= (SELECT min(month_start) FROM spine)) b
LEFT JOIN volumes v ON v.year = year(month_start) AND v.month = month(month_start)
                   AND v.item = b.item AND v.state_code = b.state_code
GROUP BY ALL"""

# ---- items

_MART = f"""count(*) AS item_count, {_isum("CAST(is_flagship AS INT)")} AS flagged_count,
       {_pct("count(*)", "(SELECT count(*) FROM items)")} AS pct_of_items"""
ORACLE_SQL["category_mart"] = _with(ITEMS) + f"""
SELECT category, {_MART}, max(CAST(is_spirits AS INT)) AS kind_flag
FROM items GROUP BY category"""
ORACLE_SQL["category_names"] = _with(ITEMS) + f"""
SELECT category, item_id // {roles.LIST_IDS} AS list_part,
       string_agg(item_name, ', ' ORDER BY item_id) AS item_names
FROM items GROUP BY ALL"""
ORACLE_SQL["category_flagged_names"] = _with(ITEMS) + f"""
SELECT category, item_id // {roles.LIST_IDS} AS list_part,
       string_agg(CASE WHEN is_flagship THEN item_name END, ', ' ORDER BY item_id) AS flagged_names
FROM items GROUP BY ALL"""
ORACLE_SQL["category_mart_ext"] = _with(ITEMS) + f"""
SELECT category, {_MART},
       count(*) - {_isum("CAST(is_flagship AS INT)")} AS unflagged_count,
       CASE WHEN bool_or(is_spirits) THEN '{fixed.SPIRITS_LABEL}'
            ELSE '{fixed.NON_SPIRITS_LABEL}' END AS kind_label
FROM items GROUP BY category"""
ORACLE_SQL["category_mart_first"] = _with(ITEMS) + f"""
SELECT category, {_MART}, arg_min(is_spirits, item_id) AS kind_flag FROM items GROUP BY category"""
ORACLE_SQL["category_distribution"] = _with(ITEMS) + f"""
SELECT category AS "Category", count(item_name) AS "Item Count",
       {_pct("count(item_name)", "(SELECT count(item_name) FROM items)")} AS "% of Items"
FROM items GROUP BY category"""
ORACLE_SQL["flag_pct"] = _with(ITEMS) + f"""
SELECT {_pct("sum(CAST(is_flagship AS INT))", "count(*)")} AS flagship_pct,
       count(*) AS item_count FROM items"""
ORACLE_SQL["item_rank"] = _with(ITEMS) + """
SELECT item_id, category, size, rank() OVER (ORDER BY size DESC) AS size_rank,
       rank() OVER (PARTITION BY category ORDER BY size DESC) AS rank_in_category FROM items"""

# ---- sites

_COUNTRIES = """(SELECT string_agg(country, ',' ORDER BY first_id) FROM (
         SELECT country, min(site_id) AS first_id FROM sites i
         WHERE i.region = s.region AND i.site_type = s.site_type GROUP BY country))"""
ORACLE_SQL["region_type_mart"] = _with(SITES) + f"""
SELECT region, site_type, count(*) AS site_count, {_isum("headcount")} AS total_headcount,
       count(DISTINCT country) AS country_count, {_COUNTRIES} AS countries
FROM sites s GROUP BY region, site_type"""
ORACLE_SQL["region_type_mart_ext"] = _with(SITES) + f""",
first AS (SELECT o_custkey, CAST(year(min(o_orderdate)) AS INTEGER) AS year_established
          FROM orders GROUP BY o_custkey)
SELECT region, site_type, count(*) AS site_count, {_isum("headcount")} AS total_headcount,
       round(avg(headcount), 0) AS avg_headcount, count(DISTINCT country) AS country_count,
       min(year_established) AS oldest_year, max(year_established) AS newest_year,
       {_COUNTRIES} AS countries
FROM sites s LEFT JOIN first ON site_id = o_custkey GROUP BY region, site_type"""
ORACLE_SQL["region_type_mart_basic"] = _with(SITES) + f"""
SELECT region, site_type, count(site_name) AS site_count, {_isum("headcount")} AS total_headcount,
       count(DISTINCT country) AS country_count
FROM sites GROUP BY region, site_type"""
ORACLE_SQL["region_summary"] = _with(SITES) + f"""
SELECT region AS "Region", count(site_name) AS "Sites", {_isum("headcount")} AS "Headcount",
       count(DISTINCT country) AS "Countries" FROM sites GROUP BY region"""
ORACLE_SQL["region_rollup"] = _with(SITES) + f"""
SELECT region, {_isum("site_count")} AS total_sites, {_isum("heads")} AS total_headcount,
       {_isum("countries")} AS total_countries
FROM (SELECT region, site_type, count(*) AS site_count, sum(headcount) AS heads,
             count(DISTINCT country) AS countries FROM sites GROUP BY region, site_type)
GROUP BY region"""
ORACLE_SQL["region_headcount"] = _with(SITES) + f"""
SELECT region, {_isum("headcount")} AS total_headcount FROM sites GROUP BY region"""
ORACLE_SQL["type_breakdown"] = _with(SITES) + f"""
SELECT site_type, count(*) AS site_count, {_isum("headcount")} AS headcount
FROM sites GROUP BY site_type"""
ORACLE_SQL["top_sites"] = _with(SITES) + """
SELECT site_id, site_name, country, site_type, headcount FROM sites
ORDER BY headcount DESC, site_id LIMIT 8"""

# ---- posts and terms

_WORK = f"""count(*) AS post_count, {_isum("CAST(is_remote AS INT)")} AS remote_count,
       {_isum("CAST(is_hybrid AS INT)")} AS hybrid_count, round(avg(term_count), 1) AS avg_terms,
       {_pct("count(*)", "(SELECT count(*) FROM posts)")} AS pct_of_posts"""
ORACLE_SQL["department_mart"] = _with(POSTS) + f"""
SELECT department, {_WORK} FROM posts GROUP BY department"""
ORACLE_SQL["department_levels"] = _with(RAW_POSTS) + f"""
SELECT department, post_id // {roles.LIST_IDS} AS list_part,
       string_agg(seniority, ' | ' ORDER BY post_id) AS seniority_mix
FROM raw_posts GROUP BY ALL"""
ORACLE_SQL["department_mart_ext"] = _with(POSTS) + f"""
SELECT department, {_WORK},
       count(*) - {_isum("CAST(is_remote AS INT) + CAST(is_hybrid AS INT)")} AS on_site_count
FROM posts GROUP BY department"""
ORACLE_SQL["dept_seniority"] = _with(RAW_POSTS) + """
SELECT department, seniority, count(*) AS "Count" FROM raw_posts GROUP BY department, seniority"""
ORACLE_SQL["seniority_split"] = _with(RAW_POSTS) + f"""
SELECT seniority, count(*) AS post_count,
       {_pct("count(*)", "(SELECT count(*) FROM raw_posts)")} AS pct
FROM raw_posts GROUP BY seniority"""
ORACLE_SQL["work_mode"] = _with(RAW_POSTS) + f"""
SELECT {_isum("CAST(is_remote AS INT)")} AS remote, {_isum("CAST(is_hybrid AS INT)")} AS hybrid,
       count(*) - {_isum("CAST(is_remote AS INT) + CAST(is_hybrid AS INT)")} AS on_site,
       count(*) AS total
FROM raw_posts"""
ORACLE_SQL["list_size_stats"] = _with(POSTS) + """
SELECT department, round(avg(term_count), 1) AS avg_terms,
       CAST(max(term_count) AS INTEGER) AS max_terms, CAST(min(term_count) AS INTEGER) AS min_terms
FROM posts GROUP BY department"""
ORACLE_SQL["term_frequency"] = _with(FREQUENCY) + "SELECT * FROM frequency"


def _skill(name: str, pattern: str) -> str:
    """The pattern with its boundaries spelled out as the character beside them."""
    pattern = pattern.replace(r"\bR\b(?= skills| for)", "R( skills| for)").replace("(?!Script)", "")
    before, after = r"(^|[^\p{L}\p{N}_])", r"($|[^\p{L}\p{N}_])"
    spelled = before + pattern.removeprefix(r"\b").replace(r"\b", after)
    return f"CASE WHEN regexp_matches(text, {_text('(?i)' + spelled)}) THEN {_text(name)} END"


_SKILLS = ",\n         ".join(_skill(n, p) for n, p in fixed.SKILL_PATTERNS.items())
_PHRASES = "[" + ", ".join(_text(p) for p in roles.SKILL_PHRASES) + "]"
ORACLE_SQL["skill_tags"] = f"""
SELECT doc_id, array_to_string(list_filter([
         {_SKILLS}], lambda t: t IS NOT NULL), '|') AS skills
FROM (SELECT doc_id, {_PHRASES}[doc_id % {len(roles.SKILL_PHRASES)} + 1] || '. ' || text AS text
      FROM documents)"""
ORACLE_SQL["term_pairs"] = _with(POSTS) + "SELECT post_id, title, unnest(terms) AS term FROM posts"
ORACLE_SQL["terms_by_category"] = _with(TERMS) + f"""
SELECT term_category, count(*) AS unique_terms, {_isum("frequency")} AS total_mentions,
       round(avg(pct_of_posts), 1) AS avg_pct_of_posts
FROM terms GROUP BY term_category"""
ORACLE_SQL["term_rank"] = _with(TERMS) + """
SELECT *, rank() OVER (ORDER BY frequency DESC) AS term_rank FROM terms"""
ORACLE_SQL["term_rank_ext"] = _with(TERMS) + """
SELECT *, rank() OVER (ORDER BY frequency DESC) AS term_rank,
       rank() OVER (PARTITION BY term_category ORDER BY frequency DESC) AS rank_within_category
FROM terms"""
ORACLE_SQL["top_k_terms"] = _with(TERMS) + """
SELECT * FROM terms ORDER BY frequency DESC, term LIMIT 30"""
ORACLE_SQL["top_chart_terms"] = _with(TERMS) + """
SELECT term AS "Term", frequency AS "Frequency", pct_of_posts AS "% of Posts",
       term_category AS "Category", demand_tier AS "Demand Tier"
FROM terms ORDER BY frequency DESC, term LIMIT 20"""
ORACLE_SQL["top_term"] = _with(FREQUENCY) + """
SELECT * FROM frequency ORDER BY frequency DESC, term LIMIT 1"""
ORACLE_SQL["tier1_terms"] = _with(TERMS) + f"""
SELECT term, frequency, pct_of_posts FROM terms WHERE demand_tier = {_text(fixed.TIER_1)}"""

# ---- volumes

ORACLE_SQL["volume_trend"] = _with(VOLUMES) + f"""
SELECT item, CAST(year AS INTEGER) AS year, CAST(month AS INTEGER) AS month, month_label,
       price_tier, {_isum("total_cases")} AS total_cases,
       {_isum("on_premise")} AS on_premise_cases, {_isum("off_premise")} AS off_premise_cases
FROM volumes GROUP BY ALL"""
ORACLE_SQL["volume_merge"] = _with(VOLUMES) + f"""
SELECT item, CAST(year AS INTEGER) AS year, CAST(month AS INTEGER) AS month, price_tier,
       {_isum("total_cases")} AS total_cases,
       {_isum("on_premise")} AS on_premise_cases, {_isum("off_premise")} AS off_premise_cases
FROM volumes GROUP BY item, year, month, price_tier"""
ORACLE_SQL["flag_summary"] = _with(STATE_VOLUMES) + f"""
SELECT item,
       CASE WHEN is_control_state THEN '{fixed.CONTROL_LABEL}' ELSE '{fixed.OPEN_LABEL}' END
         AS state_type,
       {_isum("total_cases")} AS total_cases, count(DISTINCT state_code) AS state_count,
       round(avg(total_cases), 0) AS avg_cases_per_state
FROM volumes GROUP BY item, is_control_state"""
ORACLE_SQL["share_metrics"] = _with(STATE_VOLUMES) + f""",
per_item AS (SELECT item, category, sum(total_cases) AS cases, count(DISTINCT state_code) AS states
             FROM volumes GROUP BY item, category),
shares AS (SELECT item, category, cases,
         {_pct("cases", "sum(cases) OVER (PARTITION BY category)")} AS volume_share_pct,
         {_pct("states", "(SELECT count(*) FROM nation)")} AS numeric_distribution FROM per_item)
SELECT item, category, volume_share_pct, numeric_distribution,
       round(CAST(cases AS DOUBLE) / nullif(numeric_distribution, 0), 1) AS velocity_per_point
FROM shares"""

# ---- KPIs

_FLAGGED = _isum("CAST(is_flagship AS INT)")
_REMOTE = _isum("CAST(is_remote AS INT)")
ORACLE_SQL["kpi_core"] = _with(ITEMS, SITES, TERMS) + _kpis(
    [
        ("Total Brands", "count(*)", "Portfolio", "items"),
        ("Flagship Brands", _FLAGGED, "Portfolio", "items"),
        ("Brand Categories", "count(DISTINCT category)", "Portfolio", "items"),
        ("Total Locations", "count(*)", "Global", "sites"),
        ("Countries Served", "count(DISTINCT country)", "Global", "sites"),
        ("Total Employees (Est.)", _isum("headcount"), "Global", "sites"),
        ("Open Job Postings", "count(*)", "Talent", "raw_posts"),
        ("Remote Positions", _REMOTE, "Talent", "raw_posts"),
        ("Unique Skills Tracked", "count(*)", "Talent", "terms"),
    ],
    lambda agg: agg,
)
_HOME = f"count(*) FILTER (country = '{roles.HOME_COUNTRY}')"
_ABROAD = f"count(*) FILTER (country <> '{roles.HOME_COUNTRY}')"
ORACLE_SQL["kpi_text"] = _with(ITEMS, SITES, TERMS) + _kpis(
    [
        ("Total Brands", "count(*)", "Portfolio", "items"),
        ("Flagship Brands", _FLAGGED, "Portfolio", "items"),
        ("Brand Categories", "count(DISTINCT category)", "Portfolio", "items"),
        ("Spirits Brands", _isum("CAST(is_spirits AS INT)"), "Portfolio", "items"),
        ("Total Locations", "count(*)", "Global Presence", "sites"),
        ("Countries Served", "count(DISTINCT country)", "Global Presence", "sites"),
        ("Global Employees (Est.)", _isum("headcount"), "Global Presence", "sites"),
        ("US Locations", _HOME, "Global Presence", "sites"),
        ("International Locations", _ABROAD, "Global Presence", "sites"),
        ("Open Job Postings", "count(*)", "Talent", "raw_posts"),
        ("Remote Positions", _REMOTE, "Talent", "raw_posts"),
        ("Unique Skills Tracked", "count(*)", "Talent", "terms"),
        (
            "Tier-1 Must-Have Skills",
            f"count(*) FILTER (demand_tier = {_text(fixed.TIER_1)})",
            "Talent",
            "terms",
        ),
    ],
    _text_value,
)
_SPIRITS_PCT = "round(avg(CAST(is_spirits AS INT)) * 100, 1)"
_DATA_PCT = (
    "round(avg(CAST(regexp_matches(lower(department), "
    f"{_text(roles.DATA_DEPARTMENTS)}) AS INT)) * 100, 1)"
)
_DISPLAY = """CASE WHEN kpi LIKE '%(%\\%)' ESCAPE '\\' THEN 'pct'
       WHEN kpi = 'Top Required Skill' THEN 'text' ELSE 'number' END AS display_format"""
ORACLE_SQL["kpi_exec"] = _with(ITEMS, SITES, TERMS) + (
    f"SELECT *, {_DISPLAY}, {_AS_OF_DATE} AS as_of_date FROM ("
    + _kpis(
        [
            ("Total Brands", "count(*)", "Portfolio", "items"),
            ("Flagship Brands", _FLAGGED, "Portfolio", "items"),
            ("Brand Categories", "count(DISTINCT category)", "Portfolio", "items"),
            ("Spirits Brands (%)", _SPIRITS_PCT, "Portfolio", "items"),
            ("Total Locations", "count(*)", "Global Presence", "sites"),
            ("Countries Served", "count(DISTINCT country)", "Global Presence", "sites"),
            ("Total Employees (Est.)", _isum("headcount"), "Global Presence", "sites"),
            ("US Locations", _HOME, "Global Presence", "sites"),
            ("International Locations", _ABROAD, "Global Presence", "sites"),
            ("Open Job Postings", "count(*)", "Talent", "raw_posts"),
            ("Remote Positions", _REMOTE, "Talent", "raw_posts"),
            ("Hybrid Positions", _isum("CAST(is_hybrid AS INT)"), "Talent", "raw_posts"),
            ("Avg Skills/Posting", "round(avg(term_count), 1)", "Talent", "posts"),
            ("Data Roles (%)", _DATA_PCT, "Talent", "raw_posts"),
            ("Unique Skills Required", "count(*)", "Talent", "terms"),
            (
                "Top Required Skill",
                "first(term ORDER BY frequency DESC, term)",
                "Talent",
                "terms",
            ),
        ],
        _text_value,
    )
    + ")"
)

# ---- dedupe and quality

ORACLE_SQL["dedupe_first"] = _with(RAW_POSTS) + """
SELECT post_id, title, department FROM raw_posts
QUALIFY row_number() OVER (PARTITION BY title, department ORDER BY post_id) = 1"""
_DQ = _with(ITEMS, RAW_SITES) + f""",
item_counts AS (SELECT count(*) AS n, count(*) FILTER (item_name IS NULL OR item_name = '') AS a,
    count(*) FILTER (category = 'Uncategorized') AS b,
    count(*) - count(DISTINCT item_name) AS d FROM items),
site_counts AS (SELECT count(*) AS n, count(*) FILTER (site_name IS NULL OR site_name = '') AS a,
    count(*) FILTER (latitude IS NULL) AS b, count(*) - count(DISTINCT site_id) AS d
  FROM raw_sites),
checks AS (
  SELECT 'items' AS table_name, n AS total_rows, unnest([1, 2, 3, 4, 5]) AS check_no,
         unnest([n > 0, false, a = 0, b = 0, d = 0]) AS passed,
         unnest(['Row count OK (' || n || ' rows)', 'Missing required columns: [''supplier'']',
           CASE WHEN a > 0 THEN 'Column ''item_name'' has ' || a || ' nulls/blanks ('
             || round(a * 100.0 / n, 1) || '%)' ELSE 'No nulls in ''item_name''' END,
           CASE WHEN b > 0 THEN 'Column ''category'' has ' || b || ' nulls/blanks ('
             || round(CAST(b AS DOUBLE) * 100 / n, 1) || '%)' ELSE 'No nulls in ''category''' END,
           CASE WHEN d > 0 THEN 'Found ' || d || ' duplicate rows on [''item_name'']'
             ELSE 'No duplicates on [''item_name'']' END]) AS message FROM item_counts
  UNION ALL
  SELECT 'sites', n, unnest([1, 2, 3, 4, 5]), unnest([n > 0, true, a = 0, b = 0, d = 0]),
         unnest(['Row count OK (' || n || ' rows)', 'All 2 required columns present',
           CASE WHEN a > 0 THEN 'Column ''site_name'' has ' || a || ' nulls/blanks ('
             || round(a * 100.0 / n, 1) || '%)' ELSE 'No nulls in ''site_name''' END,
           CASE WHEN b > 0 THEN 'Column ''latitude'' has ' || b || ' nulls/blanks ('
             || round(CAST(b AS DOUBLE) * 100 / n, 1) || '%)' ELSE 'No nulls in ''latitude''' END,
           CASE WHEN d > 0 THEN 'Found ' || d || ' duplicate rows on [''site_id'']'
             ELSE 'No duplicates on [''site_id'']' END]) FROM site_counts
  UNION ALL
  SELECT 'none', 0, unnest([1, 2, 3]), unnest([false, true, true]),
         unnest(['Table is empty (0 rows)', 'All 1 required columns present',
           'No nulls in ''site_name'''])),
report AS (SELECT table_name, {_AS_OF} AS checked_at, total_rows,
                  CAST(check_no AS INTEGER) AS check_no, passed, message FROM checks)
"""
_DQ = _DQ.replace("\n,\nitem_counts", ",\nitem_counts")
ORACLE_SQL["dq_report"] = _DQ + "SELECT * FROM report"
ORACLE_SQL["dq_summary"] = _DQ + """
SELECT table_name, checked_at, max(total_rows) AS total_rows,
       count(*) FILTER (passed) AS checks_passed, count(*) FILTER (NOT passed) AS checks_failed,
       CAST(to_json(coalesce(list(message ORDER BY check_no) FILTER (NOT passed), [])) AS VARCHAR)
         AS issues
FROM report GROUP BY table_name, checked_at"""
ORACLE_SQL["table_counts"] = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}"
    for name in ["part", "customer", "documents", "lineitem", "orders", "pages"]
)

# ---- cleaning jobs

ORACLE_SQL["clean_items"] = _with(ITEMS) + f"""
SELECT item_id, item_name, category, description, is_flagship, category_raw, is_spirits,
       {_strip(f"substring(description, 1, {fixed.SHORT_TEXT_CHARS})")} AS description_short,
       length(description) > {fixed.MIN_TEXT_CHARS} AS has_description,
       {_AS_OF} AS processed_at, '{roles.SOURCE}' AS data_source
FROM items JOIN (SELECT p_partkey, p_name || ' ' || p_brand || ' ' || p_type AS description
                 FROM part) ON item_id = p_partkey
QUALIFY row_number() OVER (PARTITION BY item_name ORDER BY item_id) = 1"""
ORACLE_SQL["clean_sites"] = _with(RAW_SITES, REGIONS) + f"""
SELECT site_id, site_name, country, site_type_raw, coalesce(region, '{fixed.DEFAULT_REGION}') AS region,
       {_lookup("lower(site_type_raw)", roles.SITE_TYPES, "site_type_raw")} AS site_type,
       latitude, longitude, headcount, {_AS_OF} AS processed_at
FROM raw_sites LEFT JOIN regions USING (country)
QUALIFY row_number() OVER (PARTITION BY site_name ORDER BY site_id) = 1"""
ORACLE_SQL["clean_posts"] = _with(POSTS) + f"""
SELECT post_id, title, department, location, '{fixed.DEFAULT_EMPLOYMENT_TYPE}' AS employment_type,
       coalesce(TRY_CAST(posted_date AS DATE), {_AS_OF_DATE}) AS posted_date, description,
       array_to_string(terms, '|') AS terms, substr(location, 1, 1) AS state, is_remote, is_hybrid,
       CAST(term_count AS INTEGER) AS term_count, seniority, {_AS_OF} AS processed_at
FROM posts QUALIFY row_number() OVER (PARTITION BY title, department ORDER BY post_id) = 1"""
ORACLE_SQL["clean_terms"] = _with(TERMS) + f"SELECT *, {_AS_OF} AS processed_at FROM terms"


ORACLE_SQL["table_versions"] = _with(ITEMS) + """
SELECT item_id, item_name, category, CAST(2 AS BIGINT) AS version FROM items WHERE is_flagship"""
ORACLE_SQL["upsert_buckets"] = ORACLE_SQL["upsert_latest"]
ORACLE_SQL["load_quarantine"] = _with(ITEMS) + """,
bad AS (SELECT item_id, item_name, nullif(category, 'Uncategorized') AS category,
               length(item_name) % 3 AS is_flagship FROM items),
alone AS (SELECT *, list_filter([
    CASE WHEN category IS NULL THEN 'NOT NULL category' END,
    CASE WHEN is_flagship NOT IN (0, 1) THEN 'CHECK is_flagship IN (0,1)' END],
    lambda r: r IS NOT NULL) AS rules FROM bad),
ranked AS (SELECT *, row_number() OVER (PARTITION BY len(rules) = 0, item_name, category
                                        ORDER BY item_id) AS nth FROM alone)
SELECT item_id, item_name, array_to_string(CASE WHEN len(rules) = 0 AND nth > 1
         THEN ['UNIQUE item_name, category'] ELSE rules END, '; ') AS broken_rules
FROM ranked""".replace("\n,\nbad", ",\nbad")
ORACLE_SQL["term_index"] = _with(POSTS) + "SELECT post_id, unnest(terms) AS term FROM posts"
ORACLE_SQL["volume_ledger"] = ORACLE_SQL["volume_merge"]
ORACLE_SQL["read_outs"] = """
WITH counted AS (
  SELECT c_mktsegment AS segment, count(*) AS n FROM customer GROUP BY 1 ORDER BY n DESC, 1 LIMIT 3)
SELECT 'sites' AS label, CAST(0 AS BIGINT) AS nth, '{"n":' || count(*) || '}' AS record,
       false AS failed FROM customer
UNION ALL SELECT 'segments', row_number() OVER (ORDER BY n DESC, segment) - 1,
       '{"segment":"' || segment || '","n":' || n || '}', false FROM counted
UNION ALL SELECT 'no such table', NULL, NULL, true
UNION ALL SELECT 'fails when run', NULL, NULL, true
UNION ALL SELECT 'none', NULL, NULL, false"""


def _job(table: str, rows: str, keys: str, blanks: dict[str, str], more: tuple[str, str] | None) -> str:
    """The row of the log of one cleaning job: `rows` are the normalised ones, `n` the first of a key."""
    issues = [
        f"CASE WHEN {count} > 0 THEN 'Column ''{name}'' has ' || {count} || ' nulls/blanks (' || "
        f"round({count} * 100.0 / total, 1) || '%)' END"
        for name, count in ((n, f"blank_{n}") for n in blanks)
    ]
    if keys:
        issues.append(
            f"CASE WHEN came > total THEN 'Found ' || (came - total) || ' duplicate rows on ' || {_text(keys)} END"
        )
    if more:
        issues.append(f"CASE WHEN more > 0 THEN {_text(more[0] + ': ')} || more || ' rows' END")
    counts = ", ".join(f"count(*) FILTER (nth = 1 AND ({c})) AS blank_{n}" for n, c in blanks.items())
    return f"""
SELECT 'first run' AS run, '{table}' AS table_name, {_AS_OF} AS checked_at, total AS total_rows,
       {len(issues) + 2} - len(issues) AS checks_passed, len(issues) AS checks_failed,
       array_to_string(issues, '; ') AS issues
FROM (SELECT total, list_filter([{", ".join(issues)}], lambda i: i IS NOT NULL) AS issues
      FROM (SELECT count(*) AS came, count(*) FILTER (nth = 1) AS total, {counts},
                   count(*) FILTER ({more[1] if more else "false"}) AS more FROM ({rows})))"""


ORACLE_SQL["clean_jobs"] = _with(TERMS, ITEMS, RAW_SITES, REGIONS) + " UNION ALL ".join([
    _job(
        "dim_item",
        "SELECT *, row_number() OVER (PARTITION BY item_name ORDER BY item_id) AS nth FROM items",
        "['item_name']",
        {"item_id": "item_id IS NULL", "item_name": "item_name = ''", "category": "category = ''"},
        None,
    ),
    _job(
        "dim_site",
        "SELECT *, row_number() OVER (PARTITION BY site_name ORDER BY site_id) AS nth FROM raw_sites",
        "['site_name']",
        {n: f"{n} IS NULL" for n in ("site_id", "site_name", "country")} | {"region": "false"},
        ("no coordinates", "latitude IS NULL OR longitude IS NULL"),
    ),
    _job(
        "fact_posts",
        "SELECT *, row_number() OVER (PARTITION BY title, department ORDER BY post_id) AS nth FROM raw_posts",
        "['title', 'department']",
        {"post_id": "post_id IS NULL", "title": "coalesce(title, '') = ''",
         "department": "coalesce(department, '') = ''"},
        ("no date", "TRY_CAST(posted_date AS DATE) IS NULL"),
    ),
    _job("fact_terms", "SELECT *, 1 AS nth FROM terms", "", {"term": "term = ''", "frequency": "frequency IS NULL"}, None),
])

_FLAGSHIPS = ITEMS + ", flagships AS (SELECT * FROM items WHERE is_flagship)"
ORACLE_SQL["warehouse_build"] = " UNION ALL ".join(
    f"SELECT '{view}' AS view, count(*) AS row_count, CAST(2 AS BIGINT) AS version, "
    f"CAST(6 AS BIGINT) AS logged_first, CAST(1 AS BIGINT) AS logged_second FROM ({sql})"
    for view, sql in {
        "items_by_category": _with(_FLAGSHIPS) + "SELECT DISTINCT category FROM flagships",
        "category_names": _with(_FLAGSHIPS)
        + f"SELECT DISTINCT category, item_id // {LIST_WIDTH} FROM flagships",
        "sites_by_region": ORACLE_SQL["region_type_mart"],
        "term_ranking": _with(TERMS) + "SELECT * FROM terms",
        "top_terms": ORACLE_SQL["top_terms"],
        "posts_by_department": ORACLE_SQL["department_mart"],
        "department_levels": _with(RAW_POSTS)
        + f"SELECT DISTINCT department, post_id // {LIST_WIDTH} FROM raw_posts",
        "portfolio_summary": ORACLE_SQL["kpi_core"],
        "volume_trend": ORACLE_SQL["volume_trend"],
        "control_state_summary": ORACLE_SQL["flag_summary"],
        "market_share": ORACLE_SQL["share_metrics"],
    }.items()
)
