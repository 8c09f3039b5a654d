"""Lookups with a default: at most one match per row, no row lost."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.functions.text import column



def map_value(c: Column | str, table: Mapping[str, str], default: Column | str | None) -> Column:
    """The value of a table written in code, `default` (constant or column) for unknown keys.

    Needs neither join nor shuffle, but searches the map entry by entry for each row: for tables
    that are data, or long, `map_lookup` joins.
    """
    entries = [F.lit(text) for pair in table.items() for text in pair]
    otherwise = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.try_element_at(F.create_map(*entries), column(c)), otherwise)


def map_lookup(
    df: DataFrame,
    key: Column | str,
    lookup: DataFrame,
    lookup_key: str,
    lookup_value: str,
    out: str,
    default: Column | str | None,
) -> DataFrame:
    """A column from a lookup table, `default` where the key is unknown or null.

    Left equi-join without a hint: Spark broadcasts the lookup if its measured
    size is under `spark.sql.autoBroadcastJoinThreshold` and otherwise shuffles,
    with adaptive splitting of hot keys. Repeated lookup keys are reduced to one
    (least value) so that no row of `df` can multiply.
    """
    one_each = lookup.groupBy(F.col(lookup_key).alias("_key")).agg(
        F.min(lookup_value).alias("_value")
    )
    otherwise = default if isinstance(default, Column) else F.lit(default)
    return (
        df.withColumn("_lookup", column(key))
        .join(one_each, F.col("_lookup") == F.col("_key"), "left")
        .withColumn(out, F.coalesce(F.col("_value"), otherwise))
        .drop("_lookup", "_key", "_value")
    )
