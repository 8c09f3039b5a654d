"""Reading: CSV with declared types, optional and fallback sources, SQL and the catalog."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright import fixed

log = logging.getLogger(__name__)


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    *,
    multiline: bool,
    null_tokens: Sequence[str] = tuple(fixed.NULL_TOKENS),
) -> DataFrame:
    """CSV with a header row and quoted fields; blank and `null_tokens` become null.

    Fields are read as text and cast to the declared type, null where they do not
    fit; a header that differs from the schema is an error. The caller says whether
    fields may hold line breaks: `multiline` makes one task of each file, without it
    Spark splits large files. `csv_splits.read_csv_splits` reads large files that hold them.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    raw = (
        spark.read.schema(text)
        .option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", multiline)
        .option("escape", '"')
        .csv(path)
    )
    return as_declared(raw, schema, null_tokens)


def as_declared(raw: DataFrame, schema: T.StructType, null_tokens: Sequence[str]) -> DataFrame:
    """Text columns cast to the declared types; null for `null_tokens` and what does not fit."""
    tokens = list(null_tokens)
    return raw.select(
        *(
            F.when(~F.col(f.name).isin(tokens), F.col(f.name)).try_cast(f.dataType).alias(f.name)
            for f in schema
        )
    )


def read_optional(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    multiline: bool = False,
) -> DataFrame:
    """The table at `path`, or an empty one of the same schema if nothing is there.

    `multiline` is for CSV, see `read_csv`.
    """
    try:
        if fmt == "csv":
            return read_csv(spark, path, schema, multiline=multiline)
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def with_fallback(
    primary: Callable[[], DataFrame], fallback: DataFrame, min_rows: int
) -> DataFrame:
    """The primary source if it gives at least `min_rows` rows, else the fallback.

    An error of Spark or of the file system in the primary also means the fallback;
    any other error is one of the program and is raised. The branch taken is logged.
    Looks at no more than `min_rows` rows of the primary, at once.
    """
    try:
        source = primary()
        found = len(source.select(F.lit(1)).take(min_rows))
    except (PySparkException, Py4JJavaError, OSError) as error:
        log.warning("fallback: the primary source failed: %s", error)
        return fallback
    if found < min_rows:
        log.warning("fallback: the primary source has %d rows of %d", found, min_rows)
        return fallback
    log.info("the primary source has at least %d rows", min_rows)
    return source


def literal_table(spark: SparkSession, fields: Sequence[str], rows: Sequence[Sequence]) -> DataFrame:
    """A small table written out in code."""
    return spark.createDataFrame([tuple(row) for row in rows], list(fields))


def register_views(spark: SparkSession, views: dict[str, Callable[[], DataFrame]]) -> dict[str, str]:
    """Create or replace named views; returns the error of each one that could not be made."""
    failed = {}
    for name, build in views.items():
        try:
            build().createOrReplaceTempView(name)
        except Exception as error:
            failed[name] = str(error)
    return failed


def query(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """A SQL statement over the session's tables and views; `{name}` stands for a passed table."""
    return spark.sql(sql, **tables)


def list_tables(spark: SparkSession, kind: str) -> DataFrame:
    """Names of the session's tables (`kind` "table") or views ("view"), sorted."""
    views = spark.sql("SHOW VIEWS").select(F.col("viewName").alias("name"))
    if kind == "view":
        return views.orderBy("name")
    tables = spark.sql("SHOW TABLES").select(F.col("tableName").alias("name"))
    return tables.join(views, "name", "left_anti").orderBy("name")
