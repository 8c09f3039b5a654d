"""Nearest neighbours by cosine through a block matrix join.

Queries and candidates are dealt into blocks; every pair of blocks meets in one tile. What moves
are unit vectors as int8 numbers with a scale and the length of what is lost. In a tile the product
of the int8 blocks (as float32: the sums stay below 2^24, so they are whole numbers) gives each
cosine up to a known error: with u = s q + e for both sides,
|u.v - s_u s_v q_u.q_v| <= |e_u| (1 + |e_v|) + |e_v|. Pairs whose upper bound reaches the k-th
largest lower bound, of the tile and then of all tiles, survive; only they meet the original
vectors and are recomputed in double precision. Heaps of k merge them.

Vectors that are copies of each other are as near as each other to anything, and ties go to the
smaller id, so of each set of copies only the k + 1 smallest ids can be among anyone's k nearest:
the rest leave before the join. That is exact and bounds the survivors of a hot vector.

Edge cases: vectors that are null, empty, all zero, or hold a null or non-finite component take no
part, nor do rows with a null id; an id that is repeated is one vector, the least of its vectors
(by first component, then the next), and a query if any of its rows is; a query meets only
candidates of its own length and never itself; a query with fewer than k candidates gets them all,
with none it has no row. Ties go to the smaller id.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm import common

BLOCK = 4096  # rows of a block, on either side
PART = 512  # queries of a tile worked on at once
FUZZ = 1e-6  # rounding of the scaled float32 products
BOUNDS = "query_id long, vec_id long, low double, high double"


def usable(vector: str) -> Column:
    """Whether a vector has a direction."""
    infinite = F.lit(float("inf"))
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != infinite)
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whole numbers within +-127, scales, and the lengths of what is lost."""
    scale = np.abs(unit).max(axis=1) / 127
    whole = np.rint(unit / scale[:, None])
    lost = np.linalg.norm(unit - whole * scale[:, None], axis=1)
    return whole.astype(np.float32), scale, lost


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, added from left to right, so that a pair gives the same anywhere."""
    return np.add.accumulate(a * b, axis=1)[:, -1]


def tile(q_ids, q, c_ids, c, k: int):
    """(query, candidate, low, high): pairs that may be among a query's k nearest of the tile.

    Both sides are triples of `quantise`, their whole numbers of any type.
    """
    c_whole, c_scale, c_lost = c[0].astype(np.float32), c[1], c[2]
    out = []
    for start in range(0, len(q_ids), PART):
        ids, whole, scale, lost = (x[start : start + PART] for x in (q_ids, *q))
        about = (whole.astype(np.float32) @ c_whole.T) * scale[:, None] * c_scale
        error = lost[:, None] * (1 + c_lost) + c_lost + FUZZ
        own = ids[:, None] == c_ids
        low, high = np.where(own, -np.inf, about - error), np.where(own, -np.inf, about + error)
        least = np.full(len(ids), -np.inf)
        if len(c_ids) > k:
            least = np.partition(low, len(c_ids) - k, axis=1)[:, len(c_ids) - k]
        rows, columns = np.nonzero((high >= least[:, None]) & ~own)
        out.append((ids[rows], c_ids[columns], low[rows, columns], high[rows, columns]))
    return [np.concatenate(x) for x in zip(*out, strict=True)]


class Heaps:
    """The k best (score, smaller id) of each query."""

    def __init__(self, k: int):
        self.k, self.heaps = k, defaultdict(list)

    def add(self, queries, ids, scores) -> None:
        for query, i, score in zip(queries.tolist(), ids.tolist(), scores.tolist(), strict=True):
            heap = self.heaps[query]
            if len(heap) < self.k:
                heapq.heappush(heap, (score, -i))
            elif (score, -i) > heap[0]:
                heapq.heapreplace(heap, (score, -i))

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found = [(q, -i, s) for q, heap in self.heaps.items() for s, i in sorted(heap, reverse=True)]
        query, ids, score = zip(*found, strict=True) if found else ((), (), ())
        return np.array(query, np.int64), np.array(ids, np.int64), np.array(score, np.float64)


def _matrix(vectors: pa.Array) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), -1 if len(vectors) else 0)


def _by_length(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and matrix of the vectors of each length."""
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield at, _matrix(vectors.take(pa.array(at)))


def quantised(rows: DataFrame) -> DataFrame:
    """The rows with their vector as `whole` (int8 numbers), `scale` and `lost`."""

    def make():
        def work(vectors):
            wholes = [b""] * len(vectors)
            scales, losses = np.zeros(len(vectors)), np.zeros(len(vectors))
            for at, part in _by_length(vectors):
                unit = part / np.sqrt(_dot(part, part))[:, None]
                whole, scales[at], losses[at] = quantise(unit)
                for i, numbers in zip(at.tolist(), whole.astype(np.int8), strict=True):
                    wholes[i] = numbers.tobytes()
            return [pa.array(wholes, pa.binary()), pa.array(scales), pa.array(losses)]

        return work

    kept = [c for c in rows.columns if c != "vector"]
    return common.append(
        rows, ["vector"], "whole binary, scale double, lost double", make, kept
    )


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    key: str = "vec_id",
    vector: str = "embedding",
    block: int = BLOCK,
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k nearest candidates of each query row."""
    found = vectors.filter(usable(vector) & F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("query"),
    )
    rows = common.written(
        found.groupBy("id").agg(F.min("vector").alias("vector"), F.bool_or("query").alias("query")),
        "vectors",
    )
    copies = Window.partitionBy("vector").orderBy("id")
    offered = (
        rows.withColumn("place", F.row_number().over(copies))
        .filter(F.col("place") <= k + 1)
        .drop("place")
    )
    sizes = rows.agg(F.count("*").alias("n"), F.count_if("query").alias("q")).first()
    blocks, query_blocks = (max(1, -(-n // block)) for n in (sizes["n"], sizes["q"]))

    def dealt(df: DataFrame, own: int, others: int, name: str, other: str, query: bool) -> DataFrame:
        mine = F.pmod(F.xxhash64("id"), F.lit(own)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        return quantised(df.select("id", "vector")).select(
            F.octet_length("whole").alias("length"), mine.alias(name), every.alias(other), "id",
            "whole", "scale", "lost", F.lit(query).alias("query"),
        )

    tiles = dealt(rows.filter("query"), query_blocks, blocks, "q_block", "c_block", True).unionByName(
        dealt(offered, blocks, query_blocks, "c_block", "q_block", False)
    )

    def meet(table: pa.Table) -> pa.Table:
        marks = table.column("query").to_numpy()
        sides = []
        for mark in (marks, ~marks):
            part = table.filter(pa.array(mark))
            flat = np.frombuffer(b"".join(part.column("whole").to_pylist()), np.int8)
            whole = flat.reshape(len(part), -1 if len(part) else 0)
            sides.append((
                part.column("id").to_numpy(),
                (whole, part.column("scale").to_numpy(), part.column("lost").to_numpy()),
            ))
        (q_ids, q), (c_ids, c) = sides
        if len(q_ids) and len(c_ids):
            bounds = tile(q_ids, q, c_ids, c, k)
        else:
            bounds = [np.zeros(0, np.int64)] * 2 + [np.zeros(0)] * 2
        return pa.table(dict(zip(("query_id", "vec_id", "low", "high"), map(pa.array, bounds), strict=True)))

    near = common.written(
        tiles.groupBy("length", "q_block", "c_block").applyInArrow(meet, BOUNDS), "near-pairs"
    )
    # The k-th largest lower bound of a query over all tiles; none if it has fewer pairs.
    lows = Window.partitionBy("query_id").orderBy(F.desc("low"))
    least = (
        near.select("query_id", "low").withColumn("nth", F.row_number().over(lows))
        .filter(F.col("nth") == k).select("query_id", F.col("low").alias("least"))
    )
    pairs = near.join(least, "query_id", "left").filter(
        F.col("least").isNull() | (F.col("high") >= F.col("least"))
    )
    asked = rows.filter("query").select(F.col("id").alias("query_id"), F.col("vector").alias("q"))
    held = rows.select(F.col("id").alias("vec_id"), F.col("vector").alias("c"))
    exact = pairs.select("query_id", "vec_id").join(asked, "query_id").join(held, "vec_id")

    def make():
        def work(queries, candidates):
            cosine = np.empty(len(queries))
            for at, a in _by_length(queries):
                c = _matrix(candidates.take(pa.array(at)))
                cosine[at] = _dot(a, c) / (np.sqrt(_dot(a, a)) * np.sqrt(_dot(c, c)))
            return [pa.array(cosine, pa.float64())]

        return work

    scored = common.append(exact, ["q", "c"], "score double", make, ["query_id", "vec_id"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = Heaps(k)
        for batch in batches:
            heaps.add(*(c.to_numpy() for c in batch.columns))
        query, ids, score = heaps.rows()
        ranks = [r for heap in heaps.heaps.values() for r in range(1, len(heap) + 1)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(query), pa.array(ranks, pa.int32()), pa.array(ids), pa.array(score)],
            ["query_id", "rank", "vec_id", "score"],
        )

    return scored.repartition("query_id").mapInArrow(
        merge, "query_id long, rank int, vec_id long, score double"
    )
