"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

A seed hashes the words that a fixed mask picks from a window and ignores the rest, so a hit
survives substitutions under the ignored places. Items and documents give seeds at every position.
The masks follow from the lengths of the items (`choose_masks`): for each length they meet every
substitution pattern that the check below accepts, so no alignment it would count is missed. Masks
of five words with ignored places between them do for lengths from 8 words at 80 %; shorter items,
of which fewer words stay equal, need masks of fewer words. Seeds are joined on their hash; each hit
fixes an alignment of item and document, and the alignment counts if, in some window of `window`
item words (the whole item if shorter), at least `share` of the words are equal.

Words are lower-cased runs of letters and digits. Long items are cut into overlapping pieces. The
documents are cut into seeds once: the seeds of a benchmark of up to `block_words` words, counted
before the join, are broadcast; beyond that both sides are shuffled by seed, and Spark splits hot
ones.

Edge cases: null and empty texts hold no seed; items of few words are held to the same share (up to
four words at 80 % must be equal in all, and an item of one word is met by every text that has the
word; `clean` asks for `least` equal words besides); repeated documents are each found, rows that
repeat a key and an item give one result; a null key is a key of its own. Without benchmark items or
documents the result is empty.
"""

from __future__ import annotations

import math
from functools import cache
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.llm import common

Mask = tuple[int, ...]
#: Words that a mask picks, most first, and how far it reaches at most.
WEIGHTS = (5, 4)
SPAN = 11
FEW = 3  # masks that may share a length, so that documents give few seeds
PATTERNS = 100_000  # substitution patterns that are tried out for one length
PIECE = 256  # item words per piece, besides the overlap
BLOCK_WORDS = 200_000
LEAST = 8  # equal words of an overlap that makes a document go


def words_of(text: str) -> Column:
    return F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+")


@cache
def spaced_masks(weight: int) -> tuple[Mask, ...]:
    """All masks of so many words with an ignored place between them, the shortest first."""
    return tuple(
        (0, *inner, last)
        for last in range(weight, SPAN)
        for inner in combinations(range(1, last), weight - 2)
    )


@cache
def _patterns(length: int, changed: int) -> np.ndarray:
    """Which words are equal, as bits, for every way to change so many of them."""
    whole = (1 << length) - 1
    return np.array(
        [whole - sum(1 << i for i in c) for c in combinations(range(length), changed)], np.int64
    )


@cache
def _met(mask: Mask, length: int, changed: int) -> np.ndarray:
    """Whether the mask fits into the equal words of each pattern somewhere."""
    patterns, bits = _patterns(length, changed), sum(1 << i for i in mask)
    found = np.zeros(len(patterns), bool)
    for at in range(length - mask[-1]):
        found |= (patterns >> at) & bits == bits
    return found


def _cover(lengths: dict[int, int], weight: int) -> list[Mask] | None:
    """Few masks of a weight that together meet all patterns of all lengths, found greedily."""
    met = {m: np.concatenate([_met(m, n, c) for n, c in lengths.items()]) for m in spaced_masks(weight)}
    left, chosen = np.ones(len(next(iter(met.values()))), bool), []
    while left.any() and len(chosen) < FEW:
        best = max(met, key=lambda m: int((met[m] & left).sum()))
        chosen.append(best)
        left &= ~met[best]
    return None if left.any() else chosen


def choose_masks(lengths: list[int], share: float) -> dict[Mask, list[int]]:
    """Masks, each with the lengths it is used for, so that for each length every pattern with a
    share of `share` equal words is met by one of its masks at least.

    Lengths take masks of the most words that FEW of them suffice for, all lengths of a weight
    the same masks. Where none does (or there are too many patterns to try), the equal words lie
    in one run more than there are changes, so a run of the mean length is always there.
    """
    used: dict[Mask, list[int]] = {}
    changes = {n: n - max(1, math.ceil(n * share)) for n in sorted(set(lengths))}
    todo = {n: c for n, c in changes.items() if c >= 0}
    for weight in WEIGHTS:
        own = {
            n: c
            for n, c in todo.items()
            if n - c >= weight and n < 60 and math.comb(n, c) <= PATTERNS and _cover({n: c}, weight)
        }
        # Together they may need more masks than FEW: the shortest ones then wait for less weight.
        while own and not (masks := _cover(own, weight)):
            del own[min(own)]
        for mask in masks if own else ():
            used[mask] = [n for n in own if n > mask[-1]]
        todo = {n: c for n, c in todo.items() if n not in own}
    for n, changed in todo.items():
        run = tuple(range(max(1, -(-(n - changed) // (changed + 1)))))
        used.setdefault(run, []).append(n)
    return used


def masks_for(length: int, share: float) -> list[Mask]:
    """The masks of one length."""
    return list(choose_masks([length], share))


def _seeds(hashes: Column, mask: Mask) -> Column:
    """The seed of a mask at each place of the words, given their hashes; null at the last places."""
    n = F.size(hashes)

    def seed(i: Column) -> Column:
        picked = F.xxhash64(F.lit(str(mask)), *[F.get(hashes, i + o) for o in mask])
        return F.when(i + mask[-1] < n, picked)

    # The text of the mask is part of the hash: seeds of different masks never meet.
    return F.transform(F.sequence(F.lit(0), n - 1), seed)


def _exploded(df: DataFrame, words: str, masks: dict[Mask, Column], *keep: str) -> DataFrame:
    """A row per seed: the columns `keep`, the seed and its place; never the words.

    Each word is hashed once. A mask is used for the rows of which its condition holds. The explode
    is an outer one: Catalyst adds a filter to an inner one that computes all again.
    """
    hashed = df.select(*keep, F.transform(words, lambda w: F.xxhash64(w)).alias("__h"), *(
        held.alias(f"__use{m}") for m, held in enumerate(masks.values())
    ))
    none = F.array().cast("array<bigint>")
    seeds = [
        F.when(F.col(f"__use{m}") & (F.size("__h") > 0), _seeds(F.col("__h"), mask)).otherwise(none)
        for m, mask in enumerate(masks)
    ]
    made = hashed.select(
        *keep, F.size("__h").alias("__n"),
        F.posexplode_outer(F.concat(*seeds)).alias("__at", "__seed"),
    )
    return made.select(*keep, "__seed", (F.col("__at") % F.col("__n")).alias("__pos"))


def _pieces(benchmark: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """Pieces of the items with their words and where they start."""
    words = F.filter(words_of(text), lambda w: w != "")
    whole = benchmark.select(F.col(item).alias("__item"), words.alias("__w")).filter(
        F.size("__w") > 0
    )
    starts = F.sequence(F.lit(0), F.greatest(F.size("__w") - window, F.lit(0)), F.lit(PIECE))
    pieces = whole.select("__item", "__w", F.explode(starts).alias("__start"))
    return pieces.select(
        "__item", F.slice("__w", F.col("__start") + 1, PIECE + window).alias("__iw"), "__start"
    )


def _matched(words: str, window: int) -> Column:
    """Most equal words in a window of the item along the alignment that starts at `__from`."""
    size = F.size("__iw")

    def equal(k: Column) -> Column:
        same = F.get(words, F.col("__from") + k) == F.get("__iw", k)
        return F.coalesce(same.cast("int"), F.lit(0))

    def slide(state: Column, k: Column) -> Column:
        left = F.when(k >= window, equal(k - window)).otherwise(F.lit(0))
        inside = state["inside"] + equal(k) - left
        return F.struct(inside.alias("inside"), F.greatest(state["most"], inside).alias("most"))

    start = F.struct(F.lit(0).alias("inside"), F.lit(0).alias("most"))
    return F.aggregate(F.sequence(F.lit(0), size - 1), start, slide, lambda state: state["most"])


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = 20,
    share: float = 0.8,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Rows (key, item, matched_words, window_words, first_word), one per document and item.

    `first_word` is where the item, or its piece, would start in the document's words.
    """
    pieces = _pieces(benchmark, item, item_text, window)
    wide = F.least(F.size("__iw"), F.lit(window))
    # At most `window` lengths.
    lengths = pieces.groupBy(wide.alias("n")).agg(F.sum(F.size("__iw")).alias("words")).collect()
    used = choose_masks([r["n"] for r in lengths], share) or {(0,): []}
    texts = docs.select(F.col(key).alias("__key"), words_of(text).alias("__words"))
    placed = _exploded(texts, "__words", dict.fromkeys(used, F.lit(True)), "__key")
    of_item = {mask: wide.isin(own) for mask, own in used.items()}
    seeds = _exploded(pieces, "__iw", of_item, "__item", "__start")
    seeds = seeds.withColumnRenamed("__pos", "__ipos")
    if sum(r["words"] for r in lengths) <= block_words:
        seeds = F.broadcast(seeds)
    start = (F.col("__pos") - F.col("__ipos")).alias("__from")
    hits = placed.join(seeds, "__seed").select("__key", "__item", "__start", start).distinct()
    aligned = common.written(hits, "alignments")
    aligned = aligned.withColumnRenamed("__key", "__hit")
    pieces = pieces.select(F.col("__item").alias("__i"), F.col("__start").alias("__s"), "__iw")
    checked = (
        texts.join(aligned, F.col("__key").eqNullSafe(F.col("__hit")))
        .join(pieces, F.col("__item").eqNullSafe(F.col("__i")) & (F.col("__start") == F.col("__s")))
        .select(
            "__key", "__item", "__from", wide.alias("__wide"),
            _matched("__words", window).alias("__matched"),
        )
        .filter(F.col("__matched") >= F.col("__wide") * share)
    )
    best = F.max(F.struct("__matched", "__wide", (-F.col("__from")).alias("__back"))).alias("b")
    return (
        checked.groupBy("__key", "__item")
        .agg(best)
        .select(
            F.col("__key").alias(key),
            F.col("__item").alias(item),
            F.col("b.__matched").alias("matched_words"),
            F.col("b.__wide").alias("window_words"),
            (-F.col("b.__back")).alias("first_word"),
        )
    )


def clean(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", least: int = LEAST, **options
) -> DataFrame:
    """The documents without an overlap of `least` equal words or more, all columns.

    Overlaps of fewer words (of items as short as "of the") are listed by `overlaps`, but do not
    make a document go. The keys that go are written first: their size is then known, and where it
    is small Spark broadcasts them and no text moves.
    """
    found = overlaps(docs, benchmark, key, **options).filter(F.col("matched_words") >= least)
    hit = common.written(found.select(F.col(key).alias("__hit")).distinct(), "contaminated")
    return docs.join(hit, docs[key].eqNullSafe(F.col("__hit")), "left_anti")
