"""Writing: table loads, CSV, JSON records and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martwright.operators.dedupe import one_per_key
from martwright.sources.specs import TableSpec


def write_csv(df: DataFrame, path: str) -> None:
    """Replace the CSV folder at `path`: header in every file, one file per partition."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The declared columns in order, cast to their types, defaults for null or absent values."""
    columns = []
    for c in spec.columns:
        value = F.col(c.name).cast(c.type) if c.name in df.columns else F.lit(None).cast(c.type)
        if c.default is not None:
            value = F.coalesce(value, F.lit(c.default).cast(c.type))
        columns.append(value.alias(c.name))
    return df.select(*columns)


def load_table(df: DataFrame, spec: TableSpec, path: str, order: str | None = None) -> DataFrame:
    """Full refresh in place: replace the table at `path` with these rows and return it.

    The old rows go before the new are there; `versions` keeps them until a load has succeeded. With `order`, rows that share a declared unique key are reduced to the one
    with the highest `order` (the last one wins); without it all rows are kept.
    """
    conform(last_rows(df, spec, order), spec).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(spec.schema()).parquet(path)


def last_rows(df: DataFrame, spec: TableSpec, order: str | None) -> DataFrame:
    """The row of the highest `order` of each declared unique key; all rows without `order`."""
    for keys in spec.unique if order else ():
        df = one_per_key(df, list(keys), [F.desc(order)])
    return df


def append_rows(df: DataFrame, spec: TableSpec, path: str) -> None:
    """Add rows to the table at `path`."""
    conform(df, spec).write.mode("append").parquet(path)


def export_all(spark: SparkSession, names: list[str], folder: str, fmt: str = "csv") -> dict[str, int]:
    """Write each named table or view to a folder of its own; returns the row counts.

    The count is observed during the write, not by a second query.
    """
    counts = {}
    for name in names:
        seen = Observation()
        df = spark.table(name).observe(seen, F.count(F.lit(1)).alias("rows"))
        path = f"{folder.rstrip('/')}/{name}"
        if fmt == "csv":
            write_csv(df, path)
        else:
            df.write.mode("overwrite").format(fmt).save(path)
        counts[name] = seen.get["rows"]
    return counts


def to_json_records(df: DataFrame, cols: list[str] | None = None, out: str = "record") -> DataFrame:
    """Each row as one JSON object text, nulls written out."""
    record = F.struct(*(cols or df.columns))
    return df.select(F.to_json(record, {"ignoreNullFields": "false"}).alias(out))
