"""Merges of a BPE vocabulary over many short strings at once, as array operations."""

from __future__ import annotations

import numpy as np

NONE = np.int32(2**31 - 1)
WIDTHS = (8, 16, 32)  # strings are worked on together with others of about their length


class Merger:
    """Applies merges, best rank first and leftmost among equals, to batches of strings.

    A symbol is a piece's number, or `base` + code point for a character that is no piece.
    """

    def __init__(self, scores: dict[str, float], numbers: dict[str, int], joined: set[str]):
        self.base = max(numbers.values(), default=0) + 1
        order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.symbol_of = np.arange(0x110000, dtype=np.int64) + self.base
        for piece, number in numbers.items():
            if len(piece) == 1:
                self.symbol_of[ord(piece)] = number

        def symbol(text: str) -> int | None:
            return int(self.symbol_of[ord(text)]) if len(text) == 1 else numbers.get(text)

        found = {}
        for piece, number in numbers.items():
            for i in range(1, len(piece)):
                a, b = symbol(piece[:i]), symbol(piece[i:])
                if a is not None and b is not None:
                    found[a << 22 | b] = (order[scores[piece]], number)
        keys = np.array(sorted(found) or [-1], np.int64)
        self.rank = np.array([found[k][0] for k in keys] if found else [NONE], np.int32)
        self.into = np.array([found[k][1] for k in keys] if found else [0], np.int64)
        self.keys, self.bits = keys, 20
        self.slots = np.full(1 << self.bits, -1, np.int64)
        todo, step = np.arange(len(keys)), 0
        home = self._home(keys)
        while len(todo):
            at = (home[todo] + step) & ((1 << self.bits) - 1)
            free = self.slots[at] < 0
            _, first = np.unique(at[free], return_index=True)
            placed = todo[free][first]
            self.slots[at[free][first]] = placed
            todo = np.setdiff1d(todo, placed)
            step += 1
        self.probes = step
        self.joined = np.array(sorted(ord(p[0]) << 21 | ord(p[1]) for p in joined), np.int64)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def _pair(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the merge of neighbours and what it gives."""
        keys = a << 22 | b
        found = np.full(len(keys), -1, np.int64)
        todo, home = np.arange(len(keys)), self._home(keys)
        for step in range(self.probes):
            slot = self.slots[(home[todo] + step) & ((1 << self.bits) - 1)]
            hit = (slot >= 0) & (self.keys[slot] == keys[todo])
            found[todo[hit]] = slot[hit]
            todo = todo[(slot >= 0) & ~hit]
            if not len(todo):
                break
        rank = np.where(found >= 0, self.rank[found], NONE)
        return rank, self.into[found]

    def breaks(self, points: np.ndarray) -> np.ndarray:
        """Whether no piece joins a character to the one before it."""
        pairs = points[:-1].astype(np.int64) << 21 | points[1:]
        at = np.minimum(np.searchsorted(self.joined, pairs), max(0, len(self.joined) - 1))
        known = self.joined[at] == pairs if len(self.joined) else np.zeros(len(pairs), bool)
        return np.append(True, ~known)[: len(points)]

    def apply(self, points: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        """Symbols of the strings points[start : start + size], as (string, symbol), in order."""
        strings, symbols, places = [], [], []
        low = 0
        for width in (*WIDTHS, int(sizes.max(initial=0))):
            chosen = np.flatnonzero((sizes > low) & (sizes <= width))
            low = max(low, width)
            for some in np.array_split(chosen, max(1, len(chosen) * width // (1 << 21))):
                if len(some):
                    s, y, at = self._merge(points, starts[some], sizes[some])
                    strings.append(some[s]), symbols.append(y), places.append(at)
        if not strings:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        strings, symbols, places = map(np.concatenate, (strings, symbols, places))
        order = np.lexsort((places, strings))
        return strings[order], symbols[order]

    def _merge(self, points, starts, sizes):
        many, width = len(starts), int(sizes.max())
        column = np.arange(width)
        inside = column < sizes[:, None]
        symbols = np.zeros((many, width), np.int64)
        symbols[inside] = self.symbol_of[points[(starts[:, None] + column)[inside]]]
        after = np.tile(column + 1, (many, 1))
        before = np.tile(column - 1, (many, 1))
        rank = np.full((many, width), NONE, np.int32)
        into = np.zeros((many, width), np.int64)
        pairs = np.nonzero(column < sizes[:, None] - 1)
        rank[pairs], into[pairs] = self._pair(symbols[pairs], symbols[pairs[0], pairs[1] + 1])
        alive = inside.copy()
        rows = np.arange(many)
        while len(rows):
            at = rank[rows].argmin(axis=1)
            more = rank[rows, at] != NONE
            rows, at = rows[more], at[more]
            if not len(rows):
                break
            gone = after[rows, at]
            symbols[rows, at] = into[rows, at]
            alive[rows, gone], rank[rows, gone] = False, NONE
            follow = after[rows, gone]
            after[rows, at] = follow
            inner = follow < sizes[rows]
            before[rows[inner], follow[inner]] = at[inner]
            rank[rows, at] = NONE
            r, a, f = rows[inner], at[inner], follow[inner]
            rank[r, a], into[r, a] = self._pair(symbols[r, a], symbols[r, f])
            led = before[rows, at] >= 0
            r, a = rows[led], at[led]
            b = before[r, a]
            rank[r, b], into[r, b] = self._pair(symbols[r, b], symbols[r, a])
        string, place = np.nonzero(alive)
        return string, symbols[string, place], place
