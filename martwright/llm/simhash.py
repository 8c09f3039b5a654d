"""SimHash near-duplicates found through a Gray-order hierarchical index.

Fingerprints: words are runs of anything but ASCII white space, A-Z lower-cased; shingles are
`width` consecutive words, repeats included, joined by a space (all words if there are fewer); a
bit is set if it is set in over half of the shingles' XXH64 (UTF-8, seed 42). No word: zero.

Links: two fingerprints that differ in at most d bits agree on one of any d + 1 pieces of the
bits. The index is a hierarchy of masked patterns. Its upper nodes fix one piece each: a
fingerprint goes to d + 1 nodes, so every pair within d bits meets in one of them. A node with
more than `leaf` fingerprints is split again by pieces of its free bits, until free bits bound
its size (at most 2^free distinct fingerprints). Inside a node fingerprints are sorted by Gray
rank, which puts those with long common patterns side by side; runs of neighbours form groups,
and groups of groups, each with the mask of the bits its members share and their pattern. Two
groups whose shared bits already differ in more than d places are pruned as a whole. A node gives
only the edges that span its components, never all of its pairs.

Copies meet as one fingerprint before any of this. Components are taken over the edges.

Edge cases: a null or wordless text has fingerprint zero and links like any other; repeated rows
are kept, each with the same component; rows with a null key take part, and a component whose
keys are all null has a null id. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.llm import common
from martwright.llm.components import components

WORD_BLOCK = 200_000  # words of one text hashed at once
LEAF = 4096  # fingerprints searched together in memory
FAN = 8  # groups under a group
BUCKET = 32  # fingerprints under a lowest group
PAIRS = 1 << 18  # pairs of groups looked at together
ALL_BITS = (1 << 64) - 1

# -- fingerprints --------------------------------------------------------------------------

_xxh64 = partial(xxhash.xxh64_intdigest, seed=42)


def fingerprint(text: str, width: int = 3) -> int:
    words = text.encode("utf-8", "surrogatepass").lower().split()
    count = max(1, len(words) - width + 1) if words else 0
    ones = np.zeros(64, np.int64)
    for start in range(0, count, WORD_BLOCK):
        part = words[start : start + WORD_BLOCK + width - 1]
        shifted = (part[i:] for i in range(width)) if len(words) >= width else ()
        shingles = map(b" ".join, zip(*shifted)) if len(words) >= width else [b" ".join(words)]  # noqa: B905
        hashes = np.fromiter(map(_xxh64, shingles), np.uint64)
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count).view(">u8")[0])


def fingerprints(
    docs: DataFrame,
    width: int = 3,
    text: str = "text",
    keep: list[str] | None = None,
    out: str = "fp",
) -> DataFrame:
    """Add `out`, the fingerprint as a signed long."""

    def make():
        def work(texts):
            made = [fingerprint(t or "", width) for t in (x.as_py() for x in texts)]
            return [pa.array(np.array(made, np.uint64).view(np.int64), pa.int64())]

        return work

    return common.append(docs, [text], f"{out} long", make, keep)


# -- the index inside one node -------------------------------------------------------------


def gray_rank(code: Column) -> Column:
    """Place of a 64-bit code in Gray order, as a long that sorts like the unsigned rank."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code.bitwiseXOR(F.lit(-(1 << 63)))


def _groups(patterns: np.ndarray, masks: np.ndarray, fan: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns and masks of the groups made of `fan` neighbours each."""
    starts = np.arange(0, len(patterns), fan)
    first = np.repeat(patterns[starts], np.diff(starts, append=len(patterns)))
    differ = np.bitwise_or.reduceat(patterns ^ first, starts)
    shared = np.bitwise_and.reduceat(masks, starts) & ~differ
    return patterns[starts] & shared, shared


def _children(groups: np.ndarray, fan: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(position in `groups`, child) for all children."""
    child = groups[:, None] * fan + np.arange(fan)
    which = np.repeat(np.arange(len(groups)), fan).reshape(-1, fan)
    real = child < size
    return which[real], child[real]


def _expand(a: np.ndarray, b: np.ndarray, fan: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of children of paired groups, each unordered pair once."""
    which, left = _children(a, fan, size)
    position, right = _children(b[which], fan, size)
    left = left[position]
    once = left <= right
    return left[once], right[once]


def _unite(roots: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    while True:
        x, y = roots[a], roots[b]
        apart = x != y
        if not apart.any():
            return roots
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(roots, np.maximum(x, y), np.minimum(x, y))
        while (jumped := roots[roots]).tobytes() != roots.tobytes():
            roots = jumped


def spanning_roots(codes: np.ndarray, most: int) -> np.ndarray:
    """For distinct codes in Gray order, a representative of each one's component."""
    full = np.full(len(codes), ALL_BITS, np.uint64)
    levels = [(codes, full, 1)]
    while len(levels[-1][0]) > 1:
        fan = BUCKET if len(levels) == 1 else FAN
        levels.append((*_groups(levels[-1][0], levels[-1][1], fan), fan))
    roots = np.arange(len(codes))
    stack = [(len(levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        level, a, b = stack.pop()
        if len(a) > PAIRS // levels[level][2] ** 2 + 1 and len(a) > 1:
            half = len(a) // 2
            stack += [(level, a[:half], b[:half]), (level, a[half:], b[half:])]
            continue
        fan = levels[level][2]
        if level:
            patterns, masks, _ = levels[level - 1]
            a, b = _expand(a, b, fan, len(patterns))
            differ = (patterns[a] ^ patterns[b]) & masks[a] & masks[b]
            near = np.bitwise_count(differ) <= most
            a, b = a[near], b[near]
            if level > 1:
                if len(a):
                    stack.append((level - 1, a, b))
            elif len(a):
                roots = _unite(roots, a, b)
    return roots


# -- links over all fingerprints -----------------------------------------------------------


def _pieces(mask: int, parts: int) -> list[int]:
    """Masks that fix, besides `mask`, one of `parts` pieces of the free bits."""
    free = [1 << i for i in range(64) if not mask >> i & 1]
    cuts = [len(free) * i // parts for i in range(parts + 1)]
    return [mask | sum(free[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _search(most: int, leaf: int, last: bool):
    """Streams the sorted rows of a task; nodes above `leaf` pass on to be split again."""

    def flush(mask: int, codes: list[np.ndarray]):
        codes = np.concatenate(codes)
        roots = spanning_roots(codes.view(np.uint64), most)
        own = roots != np.arange(len(codes))
        return codes[roots[own]], codes[own]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, size, over = None, [], 0, False
        for batch in batches:
            mask, pattern, fp = (batch.column(i).to_numpy() for i in range(3))
            if not len(fp):
                continue
            change = np.flatnonzero((np.diff(mask) != 0) | (np.diff(pattern) != 0)) + 1
            starts = np.concatenate([[0], change])
            ends = np.append(change, len(fp))
            edges_a, edges_b, again, again_mask = [], [], [], []
            for i, (s, e) in enumerate(zip(starts, ends, strict=True)):
                if i and e - s == 1 and e < len(fp) and size <= 1:
                    key, held, size, over = (mask[s], pattern[s]), [fp[s:e]], 1, False
                    continue
                if (mask[s], pattern[s]) != key:
                    if size > 1 and not over:
                        a, b = flush(key[0], held)
                        edges_a.append(a), edges_b.append(b)
                    key, held, size, over = (mask[s], pattern[s]), [], 0, False
                held.append(fp[s:e])
                size += e - s
                if size > leaf and not last:
                    over = True
                    again += held
                    again_mask += [np.full(len(h), mask[s]) for h in held]
                    held = []
            yield _rows(edges_a, edges_b, again, again_mask)
        if size > 1 and not over:
            a, b = flush(key[0], held)
            yield _rows([a], [b], [], [])

    return run


def _rows(edges_a, edges_b, again, again_mask) -> pa.RecordBatch:
    a = np.concatenate([*edges_a, *again, np.zeros(0, np.int64)])
    linked = sum(map(len, edges_a))
    b = np.concatenate([*edges_b, np.zeros(len(a) - linked, np.int64)])
    mask = np.concatenate([np.zeros(linked, np.int64), *again_mask])
    split = np.arange(len(a)) >= linked
    columns = [pa.array(c) for c in (split, mask.astype(np.int64), a, b)]
    return pa.RecordBatch.from_arrays(columns, names=["split", "mask", "a", "b"])


def links(codes: DataFrame, most: int = 2, leaf: int = LEAF) -> DataFrame:
    """Edges (a, b) that connect exactly the distinct `fp` linked within `most` bits."""
    masks = [0]
    todo = codes.select(F.lit(0).cast("long").alias("mask"), "fp")
    found = None
    while True:
        children = {m: _pieces(m, most + 1) for m in masks}
        masks = sorted({c for own in children.values() for c in own})
        last = max(64 - m.bit_count() for m in masks) <= max(1, leaf.bit_length() - 1)
        lookup = F.create_map(
            *[
                x
                for m, own in children.items()
                for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(c)) for c in own]))
            ]
        )
        keyed = todo.select(F.explode(lookup[F.col("mask")]).alias("mask"), "fp").select(
            "mask", F.col("mask").bitwiseAND(F.col("fp")).alias("pattern"), "fp"
        )
        keyed = keyed.repartition("mask", "pattern").sortWithinPartitions(
            "mask", "pattern", gray_rank(F.col("fp"))
        )
        made = common.written(
            keyed.mapInArrow(_search(most, leaf, last), "split boolean, mask long, a long, b long"),
            "simhash-links",
        )
        edges = made.filter(~F.col("split")).select("a", "b")
        found = edges if found is None else found.unionByName(edges)
        todo = made.filter("split").select("mask", F.col("a").alias("fp"))
        if last or todo.isEmpty():
            return found


def _named(marked: DataFrame, key: str, most: int) -> DataFrame:
    """Rows (fp, component_id) for every fingerprint of `marked` (key, fp)."""
    codes = common.written(marked.groupBy("fp").agg(F.min(key).alias("least")), "simhash-codes")
    linked = components(links(codes, most))
    rooted = codes.join(linked, codes["fp"] == linked["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    first = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(first, "root").select("fp", "component_id")


def group(
    docs: DataFrame, width: int = 3, most: int = 2, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Rows (key, fp, component_id): the smallest key reachable over links."""
    marked = common.written(fingerprints(docs, width, text, [key]), "simhash")
    return marked.join(_named(marked, key, most), "fp").select(key, "fp", "component_id")


def deduplicate(
    docs: DataFrame, width: int = 3, most: int = 2, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The document of the smallest key of each component (one row, if rows repeat a key).

    The numbers of the rows that go are written first: their size is then known, and where it is
    small Spark broadcasts them and no text moves.
    """
    marked = fingerprints(docs, width, text, out="__fp")
    marked = common.written(
        marked.withColumn("__row", F.monotonically_increasing_id()), "simhash-rows"
    )
    order = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), "__row")
    rows = marked.select(F.col("__fp").alias("fp"), "__row", order.alias("order"))
    copies = rows.join(_named(rows, "order", most), "fp").filter(
        F.col("order")["__row"] != F.col("component_id")["__row"]
    )
    copies = common.written(copies.select("__row"), "simhash-copies")
    return marked.join(copies, "__row", "left_anti").select(*docs.columns)
