"""Lists, tables, patterns and formats that results depend on.

These are data, not logic. Change one and outputs change with it.
"""

# Category synonym (lower case) -> category. Anything else is DEFAULT_CATEGORY.
CATEGORY_NAMES = {
    "bourbon whiskey": "Bourbon Whiskey",
    "rye whiskey": "Rye Whiskey",
    "whiskey": "Whiskey",
    "whisky": "Whiskey",
    "flavored whisky": "Flavored Whiskey",
    "flavored whiskey": "Flavored Whiskey",
    "vodka": "Vodka",
    "rum": "Rum",
    "tequila": "Tequila",
    "mezcal": "Mezcal",
    "gin": "Gin",
    "brandy": "Brandy",
    "cognac": "Brandy",
    "liqueur": "Liqueur",
    "schnapps": "Schnapps/Liqueur",
    "mixer / non-alcoholic": "Mixer",
    "mixer": "Mixer",
    "beer": "Beer",
    "wine": "Wine",
    "unknown": "Uncategorized",
}
DEFAULT_CATEGORY = "Uncategorized"

SPIRITS_CATEGORIES = [
    "Bourbon Whiskey",
    "Rye Whiskey",
    "Whiskey",
    "Flavored Whiskey",
    "Vodka",
    "Rum",
    "Tequila",
    "Mezcal",
    "Gin",
    "Brandy",
]

# Country -> region used by cleaning. Anything else is DEFAULT_REGION.
COUNTRY_REGION = {
    "United States": "Americas",
    "Canada": "Americas",
    "Mexico": "Americas",
    "Brazil": "Americas",
    "Argentina": "Americas",
    "United Kingdom": "Europe",
    "Germany": "Europe",
    "France": "Europe",
    "Italy": "Europe",
    "Spain": "Europe",
    "Netherlands": "Europe",
    "Australia": "APAC",
    "Japan": "APAC",
    "China": "APAC",
    "Singapore": "APAC",
    "South Korea": "APAC",
    "India": "APAC",
    "South Africa": "EMEA",
    "UAE": "EMEA",
}
DEFAULT_REGION = "Other"
HOME_COUNTRY = "United States"

# Site type (lower case) -> site type. Anything else stays as it is.
SITE_TYPES = {
    "distillery": "Distillery",
    "headquarters": "Headquarters",
    "office": "Office",
    "international office": "International Office",
    "distribution center": "Distribution Center",
}

# Defaults for blank posting fields.
DEFAULT_DEPARTMENT = "Unknown"
DEFAULT_POST_LOCATION = "Louisville, KY"
DEFAULT_EMPLOYMENT_TYPE = "Full-Time"

STATE_PATTERN = r",\s*([A-Z]{2})\b"

# Seniority by title keyword; the first rule that matches wins.
SENIORITY_RULES = [
    ("Senior Leadership", ["director", "vp", "vice president", "chief", "head of"]),
    ("Senior", ["senior", "sr.", "lead", "principal"]),
    ("Junior", ["junior", "jr.", "associate", "entry"]),
    ("Manager", ["manager", "supervisor"]),
]
DEFAULT_SENIORITY = "Mid-Level"

# Demand tier by percent of postings, highest cut first.
TIER_1 = "Tier 1 — Must Have"
TIER_2 = "Tier 2 — Strongly Preferred"
TIER_3 = "Tier 3 — Nice to Have"
TIER_4 = "Tier 4 — Bonus"
DEMAND_TIERS = [(70, TIER_1), (40, TIER_2), (20, TIER_3)]

URGENCY_LABELS = [(80, "🔴 Critical"), (60, "🟠 High Demand"), (40, "🟡 In Demand")]
DEFAULT_URGENCY = "🟢 Preferred"

SKILL_CATEGORIES = {
    "Language / Query": ["SQL", "Python", "R", "Scala", "Java", "JavaScript", "DAX", "MDX"],
    "Cloud / Platform": ["Azure", "AWS", "GCP", "Snowflake", "Databricks", "Redshift", "BigQuery"],
    "BI / Visualization": ["Power BI", "Tableau", "Looker", "Qlik", "Excel", "SSRS"],
    "Data Engineering": ["ETL", "ELT", "dbt", "Airflow", "Spark", "Kafka", "Data Pipeline"],
    "Governance": ["Data Governance", "Data Quality", "Data Catalog", "Lineage", "GDPR"],
}
DEFAULT_SKILL_CATEGORY = "Analytics / Modeling"

# Skill -> pattern, searched without regard to case.
SKILL_PATTERNS = {
    "SQL": r"\bSQL\b",
    "Python": r"\bPython\b",
    "R": r"\b(R programming|R language|\bR\b(?= skills| for))",
    "Scala": r"\bScala\b",
    "Java": r"\bJava\b(?!Script)",
    "JavaScript": r"\bJavaScript\b",
    "DAX": r"\bDAX\b",
    "MDX": r"\bMDX\b",
    "Power BI": r"\bPower BI\b",
    "Tableau": r"\bTableau\b",
    "Looker": r"\bLooker\b",
    "Qlik": r"\bQlik(View|Sense)?\b",
    "Excel": r"\bExcel\b",
    "SSRS": r"\bSSRS\b",
    "Azure": r"\bAzure\b",
    "AWS": r"\b(AWS|Amazon Web Services)\b",
    "GCP": r"\b(GCP|Google Cloud)\b",
    "Snowflake": r"\bSnowflake\b",
    "Databricks": r"\bDatabricks\b",
    "Redshift": r"\bRedshift\b",
    "BigQuery": r"\bBigQuery\b",
    "ETL": r"\bETL\b",
    "ELT": r"\bELT\b",
    "dbt": r"\bdbt\b",
    "Airflow": r"\b(Airflow|Apache Airflow)\b",
    "Spark": r"\b(Spark|PySpark|Apache Spark)\b",
    "Kafka": r"\bKafka\b",
    "SQL Server": r"\b(SQL Server|MSSQL|Microsoft SQL)\b",
    "PostgreSQL": r"\b(PostgreSQL|Postgres)\b",
    "MySQL": r"\bMySQL\b",
    "Oracle": r"\bOracle\b",
    "DuckDB": r"\bDuckDB\b",
    "Teradata": r"\bTeradata\b",
    "Data Modeling": r"\bdata model(ing|er)?\b",
    "Data Warehouse": r"\bdata\s+warehouse\b",
    "Data Lake": r"\bdata\s+lake\b",
    "Data Lakehouse": r"\bdata\s+lakehouse\b",
    "Star Schema": r"\bstar\s+schema\b",
    "OLAP": r"\bOLAP\b",
    "Dimensional Modeling": r"\bdimensional\s+model(ing)?\b",
    "Machine Learning": r"\b(machine learning|ML\b)",
    "Statistics": r"\b(statistics|statistical analysis)\b",
    "Data Governance": r"\bdata\s+governance\b",
    "Data Quality": r"\bdata\s+quality\b",
    "Data Catalog": r"\bdata\s+catalog\b",
    "Lineage": r"\bdata\s+lineage\b",
    "GDPR": r"\bGDPR\b",
    "Agile": r"\b(Agile|Scrum|Kanban)\b",
    "Stakeholder": r"\bstakeholder\b",
    "KPIs": r"\b(KPI|KPIs|key performance indicators?)\b",
    "Data Pipeline": r"\bdata\s+pipeline\b",
    "Dashboards": r"\bdashboard\b",
    "Reporting": r"\b(reporting|reports?)\b",
    "Business Intelligence": r"\b(business intelligence|BI\b)",
}

# A capitalised line of 11 to 81 characters, and the words that make it a title.
TITLE_LINE_PATTERN = r"(?:^|\n)([A-Z][A-Za-z &/\-,()]{10,80})\s*(?:\n|$)"
TITLE_KEYWORDS = [
    "data",
    "analyst",
    "engineer",
    "analytics",
    "bi ",
    "science",
    "warehouse",
    "governance",
]
TITLE_DESCRIPTION_CHARS = 500

SHORT_TEXT_CHARS = 300
MIN_TEXT_CHARS = 10

ON_PREMISE_SHARE = 0.22
OFF_PREMISE_SHARE = 0.78

CONTROL_LABEL = "Control State"
OPEN_LABEL = "Open State"
SPIRITS_LABEL = "Spirits"
NON_SPIRITS_LABEL = "Non-Spirits"

DATA_DEPARTMENT_PATTERN = "data|analytics|bi"

# Fewest records a live source must give before it is preferred.
MIN_SOURCE_ITEMS = 5
MIN_SOURCE_POSTS = 3

# Texts a CSV field may hold for "no value".
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Quality-check messages.
DQ_EMPTY = "Table is empty (0 rows)"
DQ_ROWS = "Row count OK (%s rows)"
DQ_MISSING = "Missing required columns: %s"
DQ_PRESENT = "All %s required columns present"
DQ_NULLS = "Column '%s' has %s nulls/blanks (%s%%)"
DQ_NO_NULLS = "No nulls in '%s'"
DQ_DUPLICATES = "Found %s duplicate rows on %s"
DQ_NO_DUPLICATES = "No duplicates on %s"
