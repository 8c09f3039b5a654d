"""Cleaning jobs that check and write in one pass: raw rows in, a table and its row of the log out.

All counts of the checks are observed while the table is written: rows and blanks, repeated keys
(the rows that the first of each key pushed out), values that are no dates, missing coordinates.
No check reads the table again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from martwright.functions import strip, to_date_lenient
from martwright.operators.dedupe import dedupe_first
from martwright.operators.quality import blank_counts, checks_of_counts, dq_summary, log_run
from martwright.plans import silver


@dataclass(frozen=True, eq=False)
class Job:
    """What to do with the raw rows of a table, and what to count of them.

    `raw_counts` and `counts` are conditions on raw and on normalised rows, by the name they have
    in the log; rows that meet one are kept and counted.
    """

    name: str
    normalize: Callable[[DataFrame], DataFrame]
    required: Sequence[str]
    keys: Sequence[str] = ()
    order: Sequence[str] = ()
    source: str | None = None
    raw_counts: Mapping[str, Column] = field(default_factory=dict)
    counts: Mapping[str, Column] = field(default_factory=dict)


@dataclass(frozen=True)
class Result:
    path: str
    rows_in: int
    rows_out: int
    counts: dict[str, int]
    log: DataFrame


def _observed(df: DataFrame, seen: Observation, conditions: Mapping[str, Column]) -> DataFrame:
    counts = [F.count_if(c).alias(name) for name, c in conditions.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("_rows"), *counts)


def run_job(raw: DataFrame, job: Job, path: str, at: dt.datetime, log_path: str, run: str = "") -> Result:
    """Normalise, keep the first row per key, write the table to `path` and its checks to the log."""
    came, normal, kept = Observation(), Observation(), Observation()
    rows = job.normalize(_observed(raw, came, job.raw_counts))
    rows = _observed(rows, normal, job.counts)
    if job.keys:
        rows = dedupe_first(rows, list(job.keys), list(job.order))
    rows = silver.with_audit(rows, at, job.source)
    blanks = blank_counts(rows, job.required)
    rows = rows.observe(kept, F.count(F.lit(1)).alias("_rows"), *blanks.values())
    rows.write.mode("overwrite").parquet(path)
    rows_in, rows_out = normal.get["_rows"], kept.get["_rows"]
    more = {n: came.get[n] for n in job.raw_counts} | {n: normal.get[n] for n in job.counts}
    numbered = [(f"_more_{i}", name) for i, name in enumerate(more)]
    found = dict(kept.get) | {column: more[name] for column, name in numbered}
    if job.keys:
        found["_repeats"] = rows_in - rows_out
    schema = ", ".join(f"{name} long" for name in found)
    counted = raw.sparkSession.createDataFrame([tuple(found.values())], schema)
    report = checks_of_counts(
        counted, rows.columns, job.name, job.required, job.keys, at, numbered
    )
    logged = log_run(dq_summary(report), log_path, run or at.isoformat())
    return Result(path, rows_in, rows_out, more, logged)


NOT_A_DATE = "no date"
NO_COORDINATES = "no coordinates"


def item_job(source: str, **kwargs) -> Job:
    return Job(
        "dim_item", lambda raw: silver.normalize_items(raw, **kwargs),
        ["item_id", "item_name", "category"], ["item_name"], ["item_id"], source,
    )


def site_job(**kwargs) -> Job:
    lacking = F.col("latitude").isNull() | F.col("longitude").isNull()
    return Job(
        "dim_site", lambda raw: silver.normalize_sites(raw, **kwargs),
        ["site_id", "site_name", "country", "region"], ["site_name"], ["site_id"],
        counts={NO_COORDINATES: lacking},
    )


def post_job(at: dt.datetime, **kwargs) -> Job:
    """For posts whose terms are known (a table written by the tagging step)."""
    text = strip("posted_date")
    wrong = (F.coalesce(text, F.lit("")) != "") & to_date_lenient("posted_date").isNull()
    return Job(
        "fact_posts", lambda raw: silver.normalize_posts(raw, at, **kwargs),
        ["post_id", "title", "department"], ["title", "department"], ["post_id"],
        raw_counts={NOT_A_DATE: wrong},
    )


def term_job(**kwargs) -> Job:
    return Job(
        "fact_terms", lambda raw: silver.normalize_terms(raw, **kwargs), ["term", "frequency"]
    )
