"""The warehouse job: load the cleaned tables, make the views, check them, export them."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright import fixed
from martwright.functions import flag_label, join_list, threshold_ladder
from martwright.operators import kpis, marts, volumes
from martwright.operators.dedupe import with_rank
from martwright.operators.quality import (
    dq_checks,
    dq_summary,
    log_run,
    read_log,
    run_checks,
    validate,
)
from martwright.operators.shares import top_k
from martwright.operators.tagging import Term, tag_terms, term_frequency, term_pairs
from martwright.sources import specs
from martwright.sources.readers import register_views
from martwright.sources.versions import KEEP, Load, live_tables, refresh
from martwright.sources.writers import conform, export_all, last_rows, write_csv

ITEM_MART = ("category", "is_flagship", "is_spirits")
ITEM = ("category", "is_flagship", "is_spirits", "item_name", "item_id")
SITE = ("region", "site_type", "headcount", "country", "site_id")
TREND_KEYS = ["item", "year", "month", "month_label", "price_tier"]
TREND_MEASURES = {
    "total_cases": "total_cases",
    "on_premise": "on_premise_cases",
    "off_premise": "off_premise_cases",
}


def tag_posts(posts: DataFrame, taxonomy: list[Term], text: str, path: str) -> dict[str, DataFrame]:
    """Tag the texts once, keep the result at `path`, and derive from it the posts with a
    delimited list (`posts`), the term counts (`terms`) and the post-term pairs (`pairs`)."""
    tag_terms(posts, text, taxonomy, "_terms").write.mode("overwrite").parquet(path)
    tagged = posts.sparkSession.read.parquet(path)
    return {
        "posts": tagged.withColumn("terms", join_list("_terms")).drop("_terms"),
        "terms": term_frequency(tagged, "_terms"),
        "pairs": term_pairs(tagged, ["post_id", "title"], "_terms"),
    }


def ranked_terms(terms: DataFrame) -> DataFrame:
    """Terms with their rank by frequency. One row per taxonomy term, so small."""
    return with_rank(terms, "frequency", out="term_rank")


def ranked_terms_ext(terms: DataFrame) -> DataFrame:
    """Terms with their rank overall and within their category."""
    return with_rank(ranked_terms(terms), "frequency", ["term_category"], "rank_within_category")


def wanted_terms(terms: DataFrame) -> DataFrame:
    """Terms of the first two tiers."""
    return terms.filter(F.col("demand_tier").isin(fixed.TIER_1, fixed.TIER_2))


def urgent_terms(terms: DataFrame, cuts=tuple(fixed.URGENCY_LABELS)) -> DataFrame:
    """Terms of the first two tiers with an urgency label."""
    label = threshold_ladder("pct_of_posts", cuts, fixed.DEFAULT_URGENCY)
    return wanted_terms(terms).withColumn("urgency_label", label)


def category_types(mart: DataFrame) -> DataFrame:
    """The category mart for reading, its kind flag as a label."""
    return mart.withColumn(
        "type", flag_label("kind_flag", fixed.SPIRITS_LABEL, fixed.NON_SPIRITS_LABEL)
    )


TOP_TERMS = 30  # fixed value: terms of the term mart

VIEWS = [
    "items_by_category",
    "category_names",
    "sites_by_region",
    "term_ranking",
    "top_terms",
    "posts_by_department",
    "department_levels",
    "portfolio_summary",
    "volume_trend",
    "control_state_summary",
    "market_share",
]


@dataclass(frozen=True)
class Warehouse:
    """The loaded tables under one folder, replaced together by `build`; see `sources.versions`."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def table(self, spec: specs.TableSpec) -> DataFrame:
        """The live rows of a table; the log has no versions."""
        if spec.name == specs.DQ_LOG.name:
            return read_log(self.spark, self.path(spec.name)).select(*spec.schema().names)
        folder = live_tables(self.spark, self.root)[spec.name]
        return self.spark.read.schema(spec.schema()).parquet(folder)

    def load(self, spec: specs.TableSpec, df: DataFrame, order: str | None = None) -> DataFrame:
        """Replace one table; the old rows stay live until the new ones are written."""
        refresh(self.spark, self.root, {spec.name: conform(last_rows(df, spec, order), spec)})
        return self.table(spec)

    def views(self) -> dict:
        """View name -> function that builds it from the loaded tables."""
        table = self.table
        items = lambda: table(specs.DIM_ITEM)
        sites = lambda: table(specs.DIM_SITE)
        posts = lambda: table(specs.FACT_POSTS)
        terms = lambda: table(specs.FACT_TERMS)
        cases = lambda: table(specs.FACT_VOLUMES)
        return {
            "items_by_category": lambda: marts.category_mart(items(), *ITEM_MART),
            "category_names": lambda: marts.category_names(
                items(), "category", "item_name", "item_id"
            ),
            "sites_by_region": lambda: marts.region_type_mart(sites(), *SITE),
            "term_ranking": lambda: ranked_terms(terms()),
            "top_terms": lambda: wanted_terms(terms()),
            "posts_by_department": lambda: marts.department_mart(
                posts(), "department", "is_remote", "is_hybrid", "term_count"
            ),
            "department_levels": lambda: marts.department_levels(
                posts(), "department", "seniority", "post_id"
            ),
            "portfolio_summary": lambda: kpis.kpi_table(items(), sites(), posts(), terms()),
            "volume_trend": lambda: volumes.volume_trend(cases(), TREND_KEYS, TREND_MEASURES),
            "control_state_summary": lambda: volumes.flag_summary(
                cases(), "item", "is_control_state", "state_code", "total_cases"
            ),
            "market_share": lambda: table(specs.FACT_SHARES),
        }

    def check(
        self, spec: specs.TableSpec, required: list[str], unique: list[str], at, run: str = ""
    ) -> DataFrame:
        """Quality checks of a live table, put into the log; returns their row of the log.

        `run` names the run, the time `at` if it is not given; a run that is repeated replaces its
        rows.
        """
        return self._log(self.table(spec), spec, required, unique, at, run)

    def _log(self, rows: DataFrame, spec, required, unique, at, run: str) -> DataFrame:
        report = dq_checks(rows, spec.name, required, unique, at)
        return log_run(dq_summary(report), self.path(specs.DQ_LOG.name), run or at.isoformat())

    def build(
        self,
        tables: dict[specs.TableSpec, DataFrame],
        at: dt.datetime,
        latest: dict[str, str] | None = None,
        export_to: str | None = None,
        run: str = "",
        keep: int = KEEP,
    ) -> dict:
        """Load and check all tables, make the views, run the read-outs, export the views.

        All tables become live at once, when every one is written and checked; a load that fails
        before leaves the tables as they were. Folders of loads before the last `keep` go.
        Rows that share a declared unique key are reduced to the last by the column that
        `latest` names for the table; a table with a key and without such a column is refused.
        Every table's checks are added to the log. A view or read-out that fails is reported
        under its name and stops nothing.
        """
        latest = latest or {}
        for spec in tables:
            if spec.unique and spec.name not in latest:
                raise ValueError(f"{spec.name} has a unique key: name the column of the last row")
        load = Load(self.spark, self.root)
        try:
            for spec, df in tables.items():
                rows = conform(last_rows(df, spec, latest.get(spec.name)), spec)
                staged = load.stage(spec.name, rows)
                required = [c.name for c in spec.columns if c.not_null]
                keys = list(spec.unique[0]) if spec.unique else []
                self._log(staged, spec, required, keys, at, run)
        except Exception:
            load.abandon()
            raise
        load.publish(keep)
        loaded = {spec.name for spec in tables}
        for spec in tables:
            self.table(spec).createOrReplaceTempView(spec.name)
        failed = register_views(self.spark, self.views())
        made = [name for name in VIEWS if name not in failed]
        counts = {f"{name} row count": f"SELECT count(*) FROM {name}" for name in sorted(loaded)}
        checks = counts | {
            "top categories": "SELECT category, item_count FROM items_by_category "
            "ORDER BY item_count DESC, category LIMIT 3",
            "sites by region": "SELECT region, site_count FROM sites_by_region "
            "ORDER BY region, site_count DESC, site_type LIMIT 5",
            "top terms": "SELECT term, frequency FROM term_ranking "
            "ORDER BY frequency DESC, term LIMIT 5",
            "KPIs": "SELECT kpi, value FROM portfolio_summary LIMIT 5",
        }
        return {
            "failed_views": failed,
            "checks": validate(self.spark, checks),
            "read_outs": run_checks(self.spark, checks, self.path("read_outs")),
            "exported": export_all(self.spark, made, export_to) if export_to else {},
        }


def gold_marts(
    items: DataFrame, sites: DataFrame, posts: DataFrame, terms: DataFrame, as_of: dt.date
) -> dict[str, DataFrame]:
    """The four marts of the cleaned tables, by name; `write_frames` stores them."""
    return {
        "category_mart_first": marts.category_mart_first(items, *ITEM),
        "region_type_mart_basic": marts.region_type_mart_basic(
            sites, "region", "site_type", "site_name", "headcount", "country"
        ),
        "top_terms": top_k(terms, "frequency", TOP_TERMS, "term"),
        "kpi_exec": kpis.kpi_exec(items, sites, posts, terms, as_of=as_of),
    }


def report_exports(
    items: DataFrame, sites: DataFrame, posts: DataFrame, terms: DataFrame
) -> dict[str, DataFrame]:
    """The frames of the reports, under display names."""
    place = {
        "site_name": "Site", "country": "Country", "region": "Region", "site_type": "Type",
        "latitude": "Latitude", "longitude": "Longitude", "headcount": "Headcount",
    }
    chart = {
        "term": "Term", "frequency": "Frequency", "pct_of_posts": "% of Posts",
        "term_category": "Category", "demand_tier": "Demand Tier",
    }
    top = terms.orderBy(F.desc("frequency"), "term").limit(20)
    return {
        "geographic_map": sites.select(*(F.col(c).alias(n) for c, n in place.items())),
        "category_distribution": marts.distribution(items, "category", "item_name"),
        "region_summary": marts.region_summary(
            sites, "region", "site_name", "headcount", "country"
        ),
        "dept_seniority": marts.cross_counts(posts, "department", "seniority"),
        "top_chart_terms": top.select(*(F.col(c).alias(n) for c, n in chart.items())),
    }


def write_frames(frames: dict[str, DataFrame], folder: str) -> None:
    """Each frame to a folder of its own, as CSV."""
    for name, df in frames.items():
        write_csv(df, f"{folder.rstrip('/')}/{name}")
