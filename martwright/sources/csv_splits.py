"""CSV with line breaks in quoted fields, read by splits in parallel.

Whether a line lies inside a quoted field depends on the number of quotes before it. A first pass
counts the quotes of each split of a file; as a split turns its start state over exactly if that
number is odd, the states at all splits are a running sum over the splits. A second pass starts
each split in its state and cuts the records that lie in it. The few records that go over the end
of a split are put together from the pieces at both sides.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright import fixed
from martwright.session import importable
from martwright.sources.readers import as_declared

QUOTE = '"'
CUT = "file string, split long, first boolean, tail boolean, record string"
#: Records sent back at once.
BATCH = 4_096


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        "value",
    )


def _states(lines: DataFrame) -> DataFrame:
    """(file, split, inside, unfinished): whether each split starts and ends in a quoted field."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE)))
    counted = lines.groupBy("file", "split").agg(F.sum(quotes).alias("quotes"))
    # One row per split of a file.
    upto = Window.partitionBy("file").orderBy("split")
    return counted.withColumn("after", F.sum("quotes").over(upto)).select(
        "file", "split",
        ((F.col("after") - F.col("quotes")) % 2 == 1).alias("inside"),
        (F.col("after") % 2 == 1).alias("unfinished"),
    )


class _Split:
    """The lines of one split, cut into records as they come."""

    def __init__(self, inside: bool):
        self.odd = int(inside)
        self.leading = inside  # in a record that an earlier split started
        self.open: list[str] = []  # lines of the record that has not ended yet

    def cut(self, lines: pa.Array) -> Iterator[tuple[bool, list[str]]]:
        """(leading, records) of records that end in these lines."""
        quotes = pc.count_substring(lines, QUOTE).to_numpy(zero_copy_only=False)
        state = (self.odd + np.cumsum(quotes)) & 1
        ends = np.flatnonzero(state == 0)
        if not len(lines):
            return
        self.odd = int(state[-1])
        if not len(ends):
            self.open += lines.to_pylist()
            return
        first = int(ends[0])
        yield self.leading, ["\n".join([*self.open, *lines.slice(0, first + 1).to_pylist()])]
        self.leading = False
        starts = ends[:-1] + 1
        alone = starts == ends[1:]
        yield False, lines.take(pa.array(starts[alone])).to_pylist()
        for a, b in zip(starts[~alone].tolist(), ends[1:][~alone].tolist(), strict=True):
            yield False, ["\n".join(lines.slice(a, b + 1 - a).to_pylist())]
        self.open = lines.slice(int(ends[-1]) + 1).to_pylist()


def _cut(pieces: bool):
    """Whole records of each split, or if `pieces` the ends of records that started earlier and
    the starts of records that end later."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, split, fresh = None, None, True

        def rows(found: list[tuple]) -> Iterator[pa.RecordBatch]:
            types = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]
            names = ["file", "split", "first", "tail", "record"]
            for at in range(0, len(found), BATCH):
                columns = zip(*found[at : at + BATCH], strict=True)
                arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names)

        def rest() -> list[tuple]:
            if not pieces or split is None or not split.open:
                return []
            return [(*now, fresh and now[1] == 0, not split.leading, "\n".join(split.open))]

        for batch in batches:
            files, splits, inside, values = batch.columns
            files = files.dictionary_encode()
            codes, starts = files.indices.to_numpy(), splits.to_numpy()
            same = (codes[1:] == codes[:-1]) & (starts[1:] == starts[:-1])
            edges = [0, *(np.flatnonzero(~same) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                key = files.dictionary[int(codes[a])].as_py(), int(starts[a])
                if key != now:
                    yield from rows(rest())
                    now, split, fresh = key, _Split(inside[a].as_py()), True
                found = []
                for leading, records in split.cut(values.slice(a, b - a)):
                    for record in records:
                        if leading == pieces:
                            found.append((*now, fresh and now[1] == 0, False, record))
                        fresh = False
                yield from rows(found)
        yield from rows(rest())

    return run


def _put_together(cut: DataFrame) -> DataFrame:
    """The records that lie in several splits. A file has at most two pieces per split."""
    order = Window.partitionBy("file").orderBy("split", "tail")
    started = F.max(F.when(F.col("tail"), F.col("split"))).over(order)
    pieces = F.array_sort(F.collect_list(F.struct("split", "record")))
    return (
        cut.withColumn("started", started)
        .groupBy("file", "started")
        .agg(
            F.bool_or("first").alias("first"),
            F.array_join(F.transform(pieces, lambda p: p["record"]), "\n").alias("record"),
        )
        .select("first", "record")
    )


def csv_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(first, record): the text of every record; `first` marks the first one of a file.

    Lines end with a line feed; a carriage return before it belongs to the end of the record, and
    is kept inside a field. Text after a quote that is never closed is one record, without the line
    feed at the end of the file.
    """
    importable(spark)
    lines = _lines(spark, path)
    states = _states(lines)
    # At most one row per split, of 128 MB by default: small enough to broadcast.
    inside = F.broadcast(states.filter("inside").select("file", "split", "inside"))
    begun = lines.join(inside, ["file", "split"], "left").select(
        "file", "split", F.coalesce("inside", F.lit(False)).alias("inside"), "value"
    )
    torn = F.broadcast(states.filter("inside OR unfinished"))
    sides = lines.join(torn, ["file", "split"]).select("file", "split", "inside", "value")
    whole = begun.mapInArrow(_cut(False), CUT).select("first", "record")
    both = whole.unionByName(_put_together(sides.mapInArrow(_cut(True), CUT)))
    return both.withColumn("record", F.regexp_replace("record", "\r$", ""))


def read_csv_splits(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    *,
    null_tokens: Sequence[str] = tuple(fixed.NULL_TOKENS),
) -> DataFrame:
    """`read_csv` with `multiline`, in as many tasks as the files have splits.

    Reads the files up to three times: for the states, the records, and, where a record goes over
    the end of a split, the splits at both sides.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    options = {"escape": QUOTE, "multiLine": "true"}
    fields = F.from_csv("record", ", ".join(f"`{f.name}` string" for f in schema), options)
    records = csv_records(spark, path).filter("record <> ''")
    clean = F.when(F.col("first"), F.ltrim("record", F.lit("﻿"))).otherwise(F.col("record"))
    parsed = records.withColumn("record", clean).select("first", fields.alias("f"))
    names = F.lit(True)
    for f in text:
        names = names & F.col(f"f.`{f.name}`").eqNullSafe(F.lit(f.name))
    message = F.concat(F.lit("CSV header does not conform to the schema: "), F.to_json("f"))
    kept = (
        F.when(~F.col("first"), F.lit(True))
        .when(names, F.lit(False))
        .otherwise(F.raise_error(message).cast("boolean"))
    )
    return as_declared(parsed.filter(kept).select("f.*"), schema, null_tokens)
