"""A keyed table kept in hash buckets of its key, so that a batch rewrites only those it hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.operators.dedupe import one_per_key, upsert_latest
from martwright.sources.readers import read_optional

BUCKETS = 64


def _column(buckets: int) -> str:
    # The number is part of the name: a table cannot be read with another one.
    return f"bucket_of_{buckets}"


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _write(rows: DataFrame, path: str, keys: list[str], buckets: int) -> None:
    name = _column(buckets)
    # Keys are unique here, so the buckets are of even size.
    dealt = rows.withColumn(name, _bucket(keys, buckets)).repartition(buckets, name)
    write = dealt.write.partitionBy(name).mode("overwrite")
    write.option("partitionOverwriteMode", "dynamic").parquet(path)


def read_buckets(
    spark: SparkSession, path: str, schema: T.StructType, buckets: int = BUCKETS
) -> DataFrame:
    """The rows of the table, with the column of their bucket; empty if there is no table."""
    name = _column(buckets)
    return read_optional(spark, path, T.StructType([*schema.fields, T.StructField(name, T.IntegerType())]))


def upsert_buckets(
    incoming: DataFrame, path: str, keys: list[str], order: str, buckets: int = BUCKETS
) -> list[int]:
    """Put a batch into the table at `path`: incoming rows replace those of their key.

    Of several rows of a key the one with the highest `order` counts. Returns the buckets that
    were rewritten; the others are neither read nor written. The batch is read twice. Spark stages
    the new buckets and swaps them in when all are written.
    """
    spark, name = incoming.sparkSession, _column(buckets)
    hit = incoming.select(_bucket(keys, buckets).alias(name)).distinct()
    hit = sorted(r[0] for r in hit.collect())  # `buckets` numbers at most
    if not hit:
        return []
    latest = one_per_key(incoming, keys, [F.desc(order)])
    current = read_buckets(spark, path, incoming.schema, buckets).filter(F.col(name).isin(hit))
    _write(upsert_latest(current.drop(name), latest, keys, order), path, keys, buckets)
    return hit
