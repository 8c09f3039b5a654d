"""Reading tables, running Arrow functions over rows, and bounded slices of texts.

Conventions every operator keeps: it selects the columns it needs by name first, so extra
columns do no harm; an output column replaces an input column of the same name; a null text
counts as empty.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.session import fresh_path

#: Characters worked on at once inside a task; one longer text is taken alone.
SLICE_CHARS = 1_000_000
#: Bytes of an Arrow batch that a task works on, and sends back, at once.
PART_BYTES = 8_000_000


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, if they can see it."""
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder and read back: lineage ends there."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucket_of(key: str, buckets: int) -> Column:
    """crc32 of the key as text, modulo `buckets`; null for a null key."""
    return F.crc32(F.col(key).cast("string")) % buckets


def append(
    df: DataFrame,
    inputs: list[str],
    outputs: str,
    make: Callable[[], Callable[..., list[pa.Array]]],
    keep: list[str] | None = None,
) -> DataFrame:
    """Add the columns `outputs` (a DDL string) made from the columns `inputs`.

    `make()` runs once per task and returns a function from Arrow arrays, in the order of
    `inputs`, to Arrow arrays in the order of `outputs`. No rows move between tasks. `keep`
    names the columns that stay, all by default.
    """
    importable(df.sparkSession)
    added = T.StructType.fromDDL(outputs)
    names = [f.name for f in added]
    kept = [c for c in (df.columns if keep is None else keep) if c not in names]
    schema = T.StructType([df.schema[c] for c in kept] + list(added))
    needed = list(dict.fromkeys([*kept, *inputs]))
    from pyspark.sql.pandas.types import to_arrow_schema

    types = to_arrow_schema(schema).types

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in (part for whole in batches for part in parts_of(whole)):
            made = work(*(batch.column(c) for c in inputs))
            columns = [batch.column(c) for c in kept] + list(made)
            columns = [c if c.type == t else c.cast(t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.select(*needed).mapInArrow(run, schema)


def parts_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about PART_BYTES; they share the batch's memory."""
    rows = max(1, batch.num_rows * PART_BYTES // max(1, batch.nbytes))
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def texts_of(column: pa.Array) -> list[str]:
    return [t if t is not None else "" for t in column.to_pylist()]


def slices(texts: list[str], limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `limit` characters together."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def segment_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums over consecutive runs of `counts` rows; empty runs give zero."""
    out = np.zeros((len(counts), *values.shape[1:]), np.result_type(values.dtype, np.float32))
    full = counts > 0
    if full.any():
        starts = (np.cumsum(counts) - counts)[full]
        out[full] = np.add.reduceat(values, starts, axis=0, dtype=out.dtype)
    return out


def segment_totals(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """`segment_sums` of whole numbers, exact."""
    ends = np.append(0, np.cumsum(values, dtype=np.int64))
    stops = np.cumsum(counts)
    return ends[stops] - ends[stops - counts]
