"""Tables replaced as a whole: new rows are staged beside the old, then named by a manifest.

A manifest is a small table with one row per load: a number, and the folder of every table. Its
row is written last, as one file, so readers see all tables of a load or none, and a load that
fails leaves the tables before it readable. One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.session import remove
from martwright.sources.readers import read_optional

MANIFEST = "_manifest"
KEEP = 2  # loads whose folders stay, the live one included
_SCHEMA = (
    T.StructType()
    .add("version", T.LongType())
    .add("tables", T.MapType(T.StringType(), T.StringType()))
)


def _loads(spark: SparkSession, root: str, newest: int) -> list[tuple[int, dict[str, str]]]:
    rows = read_optional(spark, f"{root.rstrip('/')}/{MANIFEST}", _SCHEMA, "json")
    found = rows.orderBy(F.desc("version")).limit(newest).collect()
    return [(r["version"], dict(r["tables"])) for r in found]


def live_version(spark: SparkSession, root: str) -> int:
    """Number of the last load, 0 if there is none."""
    loads = _loads(spark, root, 1)
    return loads[0][0] if loads else 0


def live_tables(spark: SparkSession, root: str) -> dict[str, str]:
    """Table name -> folder of its live rows."""
    loads = _loads(spark, root, 1)
    return {n: f"{root.rstrip('/')}/{p}" for n, p in loads[0][1].items()} if loads else {}


def read_live(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    """The live rows of a table."""
    return spark.read.schema(schema).parquet(live_tables(spark, root)[name])


class Load:
    """Tables staged for one load; nothing is seen of them until `publish`."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.staged: dict[str, str] = {}

    def stage(self, name: str, rows: DataFrame) -> DataFrame:
        """Write the new rows of a table; returns them as written."""
        folder = f"{name}/{uuid.uuid4().hex}"
        self.staged[name] = folder
        rows.write.parquet(f"{self.root}/{folder}")
        return self.spark.read.schema(rows.schema).parquet(f"{self.root}/{folder}")

    def publish(self, keep: int = KEEP) -> int:
        """Make the staged tables live, all at once; returns the number of the load.

        Tables that were not staged stay as they are. Folders that none of the last `keep` loads
        names are removed: a reader of an older load must be done by then.
        """
        loads = _loads(self.spark, self.root, keep + 1)
        version, tables = loads[0] if loads else (0, {})
        row = (version + 1, tables | self.staged)
        manifest = self.spark.createDataFrame([row], _SCHEMA).coalesce(1)
        manifest.write.mode("append").json(f"{self.root}/{MANIFEST}")
        named = {p for _, t in [row, *loads[: keep - 1]] for p in t.values()}
        for _, old in loads[keep - 1 :]:
            for path in set(old.values()) - named:
                remove(self.spark, f"{self.root}/{path}")
        self.staged = {}
        return version + 1

    def abandon(self) -> None:
        """Remove what was staged."""
        for path in self.staged.values():
            remove(self.spark, f"{self.root}/{path}")
        self.staged = {}


def refresh(
    spark: SparkSession, root: str, tables: Mapping[str, DataFrame], keep: int = KEEP
) -> int:
    """Replace tables in one load. If any of them cannot be written, none is replaced."""
    load = Load(spark, root)
    try:
        for name, rows in tables.items():
            load.stage(name, rows)
    except Exception:
        load.abandon()
        raise
    return load.publish(keep)
