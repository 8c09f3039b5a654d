"""Monthly volumes: trends, flag comparison, shares, and the dense month grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright import fixed
from martwright.functions.ladders import flag_label
from martwright.functions.dates import month_parts
from martwright.functions.numbers import pct
from martwright.sources.readers import read_optional


def volume_trend(fact: DataFrame, keys: list[str], measures: dict[str, str]) -> DataFrame:
    """Sums per key (item, year, month, ...); additive, see `merge_months`."""
    return fact.groupBy(*keys).agg(*(F.sum(c).alias(out) for c, out in measures.items()))


def flag_summary(fact: DataFrame, item: str, flag: str, state: str, qty: str) -> DataFrame:
    """Per item and flag: volume, distinct states, and the mean per fact row."""
    return (
        fact.groupBy(item, flag)
        .agg(
            F.sum(qty).alias("total_cases"),
            F.count_distinct(state).alias("state_count"),
            F.round(F.avg(qty), 0).alias("avg_cases_per_state"),
        )
        .withColumn("state_type", flag_label(flag, fixed.CONTROL_LABEL, fixed.OPEN_LABEL))
        .select(item, "state_type", "total_cases", "state_count", "avg_cases_per_state")
    )


def share_metrics(
    fact: DataFrame, keep: list[str], category: str, state: str, qty: str, states: DataFrame
) -> DataFrame:
    """Per item (`keep`, which holds the category): volume share of its category, distribution
    (share of all states it sold in) and velocity (volume per point of distribution)."""
    # Both totals below start from these rows, so the joins behind the fact and the
    # first shuffle run once (Spark reuses the exchange).
    per_state = fact.groupBy(*keep, F.col(state).alias("_state")).agg(F.sum(qty).alias("_cases"))
    per_item = per_state.groupBy(*keep).agg(
        F.sum("_cases").alias("cases"), F.count("_state").alias("states_sold")
    )
    totals = per_state.groupBy(F.col(category).alias("_category")).agg(
        F.sum("_cases").alias("_total")
    )
    all_states = states.agg(F.count(F.lit(1))).scalar()
    return (
        per_item.join(totals, F.col(category).eqNullSafe(F.col("_category")))
        .withColumn("volume_share_pct", pct("cases", "_total"))
        .withColumn("numeric_distribution", pct("states_sold", all_states))
        .withColumn(
            "velocity_per_point",
            F.round(F.col("cases") / F.nullif("numeric_distribution", F.lit(0.0)), 1),
        )
        .select(*keep, "volume_share_pct", "numeric_distribution", "velocity_per_point")
    )


def merge_months(trend: DataFrame, new: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """A trend with another merged in: sums of the same key add up, null keys equal each other."""
    return trend.unionByName(new).groupBy(*keys).agg(*(F.sum(c).alias(c) for c in sums))


def merge_batch(
    new: DataFrame, batch: str, path: str, keys: list[str], sums: list[str]
) -> DataFrame:
    """Add a batch of sums to the trend at `path` and return the trend.

    The trend is partitioned by `year` and `month`, which are among the keys. Every row of a month
    names the batches that are in it (`batches`), so the ledger is written with the sums, in the
    same files: a month that has the batch already is left alone, whether the batch comes twice or
    a load is repeated after a failure. Only the other months of the batch are read and rewritten.
    """
    spark, parts = new.sparkSession, ["year", "month"]
    rest = [k for k in keys if k not in parts]
    kinds = {f.name: f.dataType for f in new.select(*rest, *sums, *parts).schema}
    schema = T.StructType([T.StructField(n, kinds[n]) for n in (*rest, *sums)])
    schema = schema.add("batches", T.ArrayType(T.StringType()))
    for name in parts:
        schema = schema.add(name, kinds[name])
    trend = read_optional(spark, path, schema)
    # The months of a batch are calendar months: few, whatever its size.
    months = [tuple(r) for r in new.select(*parts).distinct().collect()]
    touched = trend.filter(_in_months(months))
    ledger = touched.select(*parts, "batches").distinct().collect()
    done = {(r["year"], r["month"]) for r in ledger if batch in r["batches"]}
    todo = [m for m in months if m not in done]
    if todo:
        before = {(r["year"], r["month"]): r["batches"] for r in ledger}
        batches = F.array(F.lit(batch))
        for month in todo:
            held = F.array(*map(F.lit, sorted({*before.get(month, []), batch})))
            batches = F.when(_in_months([month]), held).otherwise(batches)
        merged = merge_months(
            touched.filter(_in_months(todo)).drop("batches"),
            new.filter(_in_months(todo)).select(*rest, *sums, *parts), keys, sums,
        )
        rows = merged.withColumn("batches", batches).select(*schema.names)
        write = rows.repartition(*parts).write.partitionBy(*parts).mode("overwrite")
        write.option("partitionOverwriteMode", "dynamic").parquet(path)
    return read_optional(spark, path, schema)


def _in_months(months: list[tuple[int, int]]) -> Column:
    found = F.lit(False)
    for year in sorted({y for y, _ in months}):
        held = [m for y, m in months if y == year]
        found = found | ((F.col("year") == year) & F.col("month").isin(held))
    return found


def dense_series(
    fact: DataFrame, keys: list[str], when: str, measure: str, first: Column, last: Column
) -> DataFrame:
    """Monthly sums from the month of `first` to that of `last` for every key seen in them, 0
    in months without a row.

    One read of the fact and no join: the months of a key (as many as the range has, at most)
    become a map, and the range is exploded over it.
    """
    month = F.trunc(F.col(when).cast("date"), "month")
    start, stop = (F.trunc(c.cast("date"), "month") for c in (first, last))
    monthly = (
        fact.filter(F.col(when).cast("date").between(start, F.last_day(stop)))
        .groupBy(*keys, month.alias("_month"))
        .agg(F.sum(measure).alias("_sum"))
    )
    seen = F.map_from_entries(F.collect_list(F.struct("_month", "_sum")))
    series = monthly.groupBy(*keys).agg(seen.alias("_seen"))
    months = F.sequence(start, stop, F.expr("interval 1 month"))
    return (
        series.select(*keys, "_seen", F.explode(months).alias("month_start"))
        .withColumns(month_parts("month_start"))
        .withColumn(
            measure, F.coalesce(F.try_element_at("_seen", F.col("month_start")), F.lit(0))
        )
        .drop("_seen")
    )
