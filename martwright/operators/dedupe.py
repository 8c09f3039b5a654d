"""One row per key, and numbering rows, on tables of any size and skew."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.session import enable_checkpoints, written


def one_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by `order`; null keys equal each other."""
    # Spark turns "first of the window" into a group limit that also runs before
    # the shuffle: each task sends at most one row per key, however hot the key.
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(window)).filter("_nth = 1").drop("_nth")


def dedupe_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by `order`; null keys equal each other.

    `order` must tell the rows of a key apart for the result to be repeatable.
    """
    return one_per_key(df, keys, [F.asc(c) for c in order])


def upsert_latest(
    current: DataFrame, incoming: DataFrame, keys: list[str], order: str
) -> DataFrame:
    """Rows of both tables, one per key: incoming beats current, then the highest `order`."""
    both = current.withColumn("_batch", F.lit(0)).unionByName(
        incoming.withColumn("_batch", F.lit(1))
    )
    return one_per_key(both, keys, [F.desc("_batch"), F.desc(order)]).drop("_batch")


def duplicate_count(keys: list[str]) -> Column:
    """Rows beyond the first of each key, as an aggregate; null keys equal each other."""
    return F.count(F.lit(1)) - F.count_distinct(F.struct(*keys))


def _sliced(df: DataFrame, order: list[Column]) -> DataFrame:
    """Rows in sorted slices: `_slice` numbers the slices in order, `_pos` the rows of a slice.

    Range boundaries come from a sample, so the slices are checkpointed: every
    later use, and any task run again after a lost executor, sees the same ones.
    """
    enable_checkpoints(df.sparkSession)
    row = F.monotonically_increasing_id()  # slice in the upper bits, position in the lower 33
    return (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_row", row)
        .withColumn("_slice", F.shiftright("_row", 33))
        .withColumn("_pos", F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_row")
        .checkpoint()
    )


def _offsets(sliced: DataFrame, amount: Column) -> DataFrame:
    """What all earlier slices add up to: one row per slice, so never more rows than
    `spark.sql.shuffle.partitions`, which bounds the window and the broadcast."""
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = sliced.groupBy("_slice").agg(F.sum(amount).alias("_amount"))
    return F.broadcast(
        totals.select(
            "_slice", F.coalesce(F.sum("_amount").over(before), F.lit(0)).alias("_before")
        )
    )


def with_row_id(df: DataFrame, order: list[Column | str], out: str = "row_id") -> DataFrame:
    """1-based number of each row in the given order, without a one-task window.

    Range-partitions by the order, counts each slice and adds the counts of the
    earlier slices. Runs a job at once (the checkpoint). `order` should tell all
    rows apart, which also keeps the slices even when a leading column is skewed.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    sliced = _sliced(df, order)
    return (
        sliced.join(_offsets(sliced, F.lit(1)), "_slice")
        .withColumn(out, F.col("_before") + F.col("_pos") + 1)
        .drop("_slice", "_pos", "_before")
    )


def with_rank(df: DataFrame, measure: str, by: list[str] | None = None, out: str = "rank") -> DataFrame:
    """Rank by a measure, highest first, ties equal (1, 1, 3), as a plain window.

    For tables of proven small size (grouped results over a fixed set of terms);
    `with_rank_large` gives the same for any table.
    """
    window = Window.partitionBy(*(by or [])).orderBy(F.desc(measure))
    return df.withColumn(out, F.rank().over(window).cast("bigint"))


def value_ranks(counts: DataFrame, measure: str, by: list[str], n: str, out: str) -> DataFrame:
    """Rank of each value of a measure, given how many rows (`n`) have it within its group `by`.

    Runs the totals over range slices of the counts, so no task holds a whole group. Runs a
    job at once (the checkpoint).
    """
    sliced = _sliced(counts, [*(F.asc(c) for c in by), F.desc(measure)])
    earlier = (
        Window.partitionBy("_slice").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    )
    ahead = (
        sliced.withColumn("_inner", F.coalesce(F.sum(n).over(earlier), F.lit(0)))
        .join(_offsets(sliced, F.col(n)), "_slice")
        .withColumn("_ahead", F.col("_inner") + F.col("_before"))
    )
    if by:
        start = ahead.groupBy(*(F.col(c).alias(f"_by_{c}") for c in by)).agg(
            F.min("_ahead").alias("_start")
        )
        same = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]
        ahead = ahead.join(start, same).withColumn("_ahead", F.col("_ahead") - F.col("_start"))
    return ahead.select(*by, measure, (F.col("_ahead") + 1).alias(out))


def with_ranks_large(
    df: DataFrame, measure: str, by: list[str], overall: str, within: str
) -> DataFrame:
    """Both ranks by a measure, overall and within groups, for large tables.

    The rows of each group and value are counted once; both ranks come from that table, and one
    join takes them back to the rows.
    """
    counts = written(df.groupBy(*by, measure).agg(F.count(F.lit(1)).alias("_n")), "rank-counts")
    whole = counts.groupBy(measure).agg(F.sum("_n").alias("_n"))
    first = value_ranks(whole, measure, [], "_n", overall)
    ranks = value_ranks(counts, measure, by, "_n", within)
    both = _join_back(ranks, first, [measure])
    return _join_back(df, both, [*by, measure])


def _join_back(df: DataFrame, ranks: DataFrame, keys: list[str]) -> DataFrame:
    renamed = ranks.withColumnsRenamed({c: f"_key_{c}" for c in keys})
    same = [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in keys]
    return df.join(renamed, same).drop(*(f"_key_{c}" for c in keys))


def with_rank_large(
    df: DataFrame, measure: str, by: list[str] | None = None, out: str = "rank"
) -> DataFrame:
    """`with_rank` for large tables: counts the rows of each distinct value (combined before
    the shuffle), ranks the values and joins the rank of each back."""
    by = by or []
    counts = df.groupBy(*by, measure).agg(F.count(F.lit(1)).alias("_n"))
    return _join_back(df, value_ranks(counts, measure, by, "_n", out), [*by, measure])
