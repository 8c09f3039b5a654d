"""Fill-in-middle transformation over a set of token boundaries in roaring containers.

The places where the tokens of a text end, in code points, are a sorted set of numbers. It is held
in containers by the upper bits: an array of the lower 16 bits, a bitmap or runs, whichever is the
smallest, with the cumulative number of members before each container. The k-th boundary is found
by a search over these counts and a selection inside one container, so both cuts cost the same
however long the text is. The texts are cut where they lie; nothing is shuffled. Draws and digests
of keys, and the way back, are built-in functions.

Edge cases: null and empty texts are plain and have no token; a text of white space only is one
token; texts that hold a marker are plain, so that the way back is certain; a null key draws from
the seed alone. Very long texts are cut whole; repeated rows and null keys are kept; empty tables
give empty results; columns named like an output are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.llm import common

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_BELOW = 50  # percent of texts that are transformed
SPM_BELOW = 80  # percent of them with the suffix first
LOW_BITS = 16
ARRAY, BITMAP, RUNS = "array", "bitmap", "runs"
WORDS = 1 << (LOW_BITS - 6)  # 64-bit words of a bitmap


def contain(low: np.ndarray) -> tuple[str, np.ndarray]:
    """The smallest container of sorted 16-bit numbers: its kind and content."""
    breaks = np.flatnonzero(np.diff(low.astype(np.int64)) != 1)
    runs = len(breaks) + 1
    size = min(2 * len(low), 8 * WORDS, 4 * runs)
    if size == 4 * runs and size < 2 * len(low):
        first = low[np.append(0, breaks + 1)]
        last = low[np.append(breaks, len(low) - 1)]
        return RUNS, np.stack([first, last - first], axis=1)
    if size == 2 * len(low):
        return ARRAY, low
    bits = np.zeros(64 * WORDS, np.uint8)
    bits[low] = 1
    return BITMAP, np.packbits(bits, bitorder="little").view("<u8")


def select_within(kind: str, content: np.ndarray, nth: int) -> int:
    """The nth (from 0) member of a container."""
    if kind == ARRAY:
        return int(content[nth])
    if kind == RUNS:
        before = np.append(0, np.cumsum(content[:, 1].astype(np.int64) + 1))
        run = int(np.searchsorted(before, nth, side="right")) - 1
        return int(content[run, 0]) + nth - int(before[run])
    before = np.append(0, np.cumsum(np.bitwise_count(content).astype(np.int64)))
    word = int(np.searchsorted(before, nth, side="right")) - 1
    bits = int(content[word])
    for _ in range(nth - int(before[word])):
        bits &= bits - 1  # without the lowest bit that is set
    return 64 * word + (bits & -bits).bit_length() - 1


class BoundarySet:
    def __init__(self, places: np.ndarray):
        """`places`: sorted distinct numbers of 32 bits at most."""
        high = places >> LOW_BITS
        self.keys, first = np.unique(high, return_index=True)
        stops = np.append(first[1:], len(places))[: len(first)]
        low = (places & ((1 << LOW_BITS) - 1)).astype(np.uint16)
        self.containers = [contain(low[a:b]) for a, b in zip(first, stops, strict=True)]
        #: Members up to and with each container.
        self.upto = stops.astype(np.int64)

    def __len__(self) -> int:
        return int(self.upto[-1]) if len(self.upto) else 0

    def select(self, nth: int) -> int:
        """The nth (from 0) member."""
        at = int(np.searchsorted(self.upto, nth, side="right"))
        before = int(self.upto[at - 1]) if at else 0
        return int(self.keys[at]) << LOW_BITS | select_within(*self.containers[at], nth - before)


def boundaries(text: str) -> BoundarySet:
    """Ends of the tokens: a word with the white space before it, or white space at the end."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    space = (points == 0x20) | ((points >= 0x09) & (points <= 0x0D))
    ends = np.flatnonzero(~space & np.append(space[1:], True)[: len(space)]) + 1
    if len(space) and space[-1]:
        ends = np.append(ends, len(space))
    return BoundarySet(ends)


def draws(key: str, seed: int = 42) -> list[Column]:
    """Four unsigned numbers of 32 bits from the SHA-256 of seed and key."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    digest = F.sha2(text, 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def transform(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    keep: list[str] | None = None,
    seed: int = 42,
) -> DataFrame:
    """Add `n` (tokens), `form` (plain, psm or spm), `prefix_chars`, `middle_chars` (code points,
    null if plain) and `output`."""

    def make():
        def work(texts, *numbers):
            rows = [
                transform_text(t, *h)
                for t, *h in zip(
                    common.texts_of(texts), *(c.to_pylist() for c in numbers), strict=True
                )
            ]
            columns = zip(*rows, strict=True) if rows else [()] * 5
            types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            return [pa.array(c, t) for c, t in zip(columns, types, strict=True)]

        return work

    names = [f"__draw{i}" for i in range(4)]
    kept = [c for c in (docs.columns if keep is None else keep)]
    drawn = docs.withColumns(dict(zip(names, draws(key, seed), strict=True)))
    outputs = "n long, form string, prefix_chars long, middle_chars long, output string"
    return common.append(drawn, [text, *names], outputs, make, kept)


def transform_text(text: str, h1: int, h2: int, h3: int, h4: int) -> tuple:
    ends = boundaries(text)
    n = len(ends)
    if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= PLAIN_BELOW:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (ends.select(k - 1) if k else 0 for k in (a, b))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < SPM_BELOW:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def restored(output: str = "output", form: str = "form") -> Column:
    """The exact text, from the output and its form alone.

    No text with a marker is transformed, and none can arise across a cut (a marker holds `<` only
    at its start), so the first of each marker is the one that was put there.
    """
    out = F.col(output)

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        start = F.lit(len(first) + 1)
        mark, end = F.instr(out, second), F.instr(out, MIDDLE)
        one = F.substr(out, start, mark - start)
        two = F.substr(out, mark + len(second), end - mark - len(second))
        return one, two, F.substr(out, end + len(MIDDLE))

    prefix, suffix, middle = parts(PREFIX, SUFFIX)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(SUFFIX, PREFIX)
    spm = F.concat(prefix, middle, suffix)
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(out)
