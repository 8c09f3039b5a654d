"""SentencePiece encoding and decoding, giant documents by a max-plus parallel scan.

Ordinary texts are encoded where they lie. A text above two chunks is cut into chunks that spread
over tasks; each yields the transfer matrix between the states at its two ends (see
`piece_model`). The matrices are combined associatively, `FAN` neighbours at a time, up to one
matrix per document; on the way down the states at all cuts follow from the states around each
group; then every chunk is traced back on its own. Ids equal those of the library for any cuts.

Edge cases: null and empty texts have no id; characters outside the vocabulary become byte pieces
(or the unknown id in a model without them); a literal U+2581 reads back as a space, as the
library has it, all else decodes to the same text; repeated rows and null keys are kept, rows are
told apart by a number of their own. Empty tables give empty results.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.llm import common
from martwright.llm.piece_model import SPACE, START, Encoder, PieceModel, between, compose

CHUNK = 32_768  # characters
FAN = 64  # matrices combined at once


def _long(text: str, chunk: int) -> Column:
    return F.coalesce(F.length(text), F.lit(0)) > 2 * chunk


def encode(
    docs: DataFrame,
    model: bytes,
    text: str = "text",
    keep: list[str] | None = None,
    chunk: int = CHUNK,
) -> DataFrame:
    """Add `ids` (array of int) and `round_trip`, whether they decode to the text.

    `model` is the content of a model file. Decoding takes place beside encoding, in the same
    worker, so that neither texts nor ids travel for it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one vocabulary

    def make():
        encoder = Encoder(PieceModel(shared.value))

        def work(texts):
            texts, made, same = common.texts_of(texts), [], []
            for a, b in common.slices(texts):
                made.append(encoder.encode_all(texts[a:b]))
                ends = np.cumsum(made[-1][0])
                for t, s, e in zip(texts[a:b], ends - made[-1][0], ends, strict=True):
                    same.append(encoder.decode(made[-1][1][s:e].tolist()) == t)
            return [_lists(made), pa.array(same, pa.bool_())]

        return work

    def make_check():
        encoder = Encoder(PieceModel(shared.value))

        def work(texts, ids):
            pairs = zip(texts, ids, strict=True)
            return [pa.array([encoder.decode(i.as_py()) == t.as_py() for t, i in pairs], pa.bool_())]

        return work

    short = common.append(
        docs.filter(~_long(text, chunk)), [text], "ids array<int>, round_trip boolean", make, keep
    )
    giants = common.written(
        docs.filter(_long(text, chunk)).withColumn("__row", F.monotonically_increasing_id()),
        "giant-texts",
    )
    found = _encode_giants(giants, shared, text, chunk)
    added = ("ids", "round_trip")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in added]
    long = giants.drop(*added).join(found, "__row")
    checked = common.append(long, [text, "ids"], "round_trip boolean", make_check, [*kept, "ids"])
    return short.unionByName(checked)


def _lists(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.ListArray:
    """One list array of (sizes, values) pairs."""
    sizes, ids = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else ((), ())
    offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))


def _encode_giants(giants: DataFrame, shared, text: str, chunk: int) -> DataFrame:
    """Rows (__row, ids)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PieceModel(shared.value)
        for batch in batches:
            for row, whole in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                escaped = (model.prefix + whole).replace(" ", SPACE)
                size = len(escaped)
                cuts = [*range(0, size - chunk + 1, chunk), size]
                parts = []
                for number, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    low = max(0, a - model.longest)
                    context = escaped[low : min(size, b + model.longest)]
                    parts.append((row, number, context, a - low, b - low))
                columns = (list(c) for c in zip(*parts, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], ["row", "chunk", "context", "first", "stop"]
                )

    chunks = common.written(
        giants.select("__row", text)
        .mapInArrow(cut, "row long, chunk long, context string, first long, stop long")
        .repartition("row", "chunk"),
        "giant-chunks",
    )

    def make_matrix():
        encoder = Encoder(PieceModel(shared.value))

        def work(contexts, firsts, stops):
            rows = zip(*(c.to_pylist() for c in (contexts, firsts, stops)), strict=True)
            return [pa.array([json.dumps(encoder.matrix(*r)) for r in rows], pa.string())]

        return work

    level = common.written(
        common.append(
            chunks, ["context", "first", "stop"], "matrix string", make_matrix, ["row", "chunk"]
        ),
        "transfer-matrices",
    )
    levels = [level]
    most = level.agg(F.max("chunk")).first()[0] or 0
    while most > 0:
        grouped = level.withColumn("group", F.expr(f"chunk div {FAN}")).groupBy("row", "group")
        level = common.written(
            grouped.applyInPandas(_combine, "row long, chunk long, matrix string"),
            "transfer-matrices",
        )
        levels.append(level)
        most //= FAN
    state = json.dumps(START)
    states = levels[-1].select("row", "chunk", F.lit(state).alias("came"), F.lit(state).alias("goes"))
    for below in reversed(levels[:-1]):
        around = states.withColumnRenamed("chunk", "group")
        keyed = below.withColumn("group", F.expr(f"chunk div {FAN}")).join(around, ["row", "group"])
        states = keyed.groupBy("row", "group").applyInPandas(
            _descend, "row long, chunk long, came string, goes string"
        )

    def make_ids():
        encoder = Encoder(PieceModel(shared.value))

        def work(*columns):
            rows = zip(*(c.to_pylist() for c in columns), strict=True)
            ids = [
                encoder.chunk_ids(context, first, stop, tuple(json.loads(a)), tuple(json.loads(b)))
                for context, first, stop, a, b in rows
            ]
            return [pa.array(ids, pa.list_(pa.int32()))]

        return work

    traced = common.append(
        chunks.join(states, ["row", "chunk"]), ["context", "first", "stop", "came", "goes"],
        "ids array<int>", make_ids, ["row", "chunk"],
    )
    # As many ids as the text has characters at most (bytes outside the vocabulary): it was a row.
    parts = F.array_sort(F.collect_list(F.struct("chunk", "ids")))
    return traced.groupBy("row").agg(F.flatten(parts["ids"]).alias("ids")).withColumnRenamed(
        "row", "__row"
    )


def _combine(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("chunk")
    parts = [json.loads(m) for m in group["matrix"]]
    whole = parts[0]
    for part in parts[1:]:
        whole = compose(whole, part)
    row, number = group["row"].iloc[0], group["group"].iloc[0]
    return pd.DataFrame({"row": [row], "chunk": [number], "matrix": [json.dumps(whole)]})


def _descend(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("chunk")
    parts = [json.loads(m) for m in group["matrix"]]
    came, goes = (json.loads(group[c].iloc[0]) for c in ("came", "goes"))
    states = [json.dumps(s) for s in between(parts, came, goes)]
    return pd.DataFrame(
        {"row": group["row"], "chunk": group["chunk"], "came": states[:-1], "goes": states[1:]}
    )


def decode(
    encoded: DataFrame, model: bytes, ids: str = "ids", keep: list[str] | None = None
) -> DataFrame:
    """Add `decoded`, the text of the ids; null ids give an empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def make():
        encoder = Encoder(PieceModel(shared.value))

        def work(column):
            texts = (encoder.decode(i.as_py() or []) for i in column)
            return [pa.array(texts, pa.string())]

        return work

    return common.append(encoded, [ids], "decoded string", make, keep)
