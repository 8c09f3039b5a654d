"""URL rules by a bit-parallel wildcard automaton.

All glob rules are packed into one row of bits, a state per place of a rule, over as many 64-bit
words as needed. Reading character c of a URL turns the states D into
    ((D << 1) & B[c]) | (D & S[c]),
where B[c] holds the states that c leads into and S[c] those that a `*` before lets stay: Shift-And
for every rule at once. A batch of URLs advances side by side, longest first.

A rule `host/path` is the glob `*.host/path*` over `.` + host + path: the host or a subdomain, and
a path that starts with the rule's. Before the first `/` a `*` or `?` never takes a `/`. Of the
rules that fit, the longest decides; equally long ones by their place in the list.

Edge cases: a null URL or one without `://` has an empty host and path, no rule, and is blocked,
as is a URL with an empty host; any other URL that no rule fits is allowed. Only A-Z are
lower-cased, only in the host. Repeated rows are judged alike; URLs of any length are read whole.
"""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm import common

SLASH = ord("/")


class GlobAutomaton:
    """Shift-And masks of all globs over bytes; `*` any run, `?` any one."""

    def __init__(self, globs: list[str]):
        places = [_places(g.encode()) for g in globs]
        self.words = max(1, -(-sum(len(p) for p in places) // 64))
        self.into = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)
        self.first = np.zeros(self.words, np.uint64)
        self.accept: list[tuple[int, np.uint64]] = []
        state = 0
        for pattern in places:
            for i, (chars, loops) in enumerate(pattern):
                word, bit = state // 64, np.uint64(1 << state % 64)
                if i == 0:
                    self.first[word] |= bit
                self.into[chars, word] |= bit
                self.stay[loops, word] |= bit
                state += 1
            self.accept.append((word, bit))

    def run(self, texts: list[bytes]) -> np.ndarray:
        """(text, glob): whether the glob fits the whole text."""
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        order = np.argsort(-size, kind="stable")
        begin, lengths = (np.cumsum(size) - size)[order], size[order]
        flat = np.frombuffer(b"".join(texts), np.uint8)
        states = np.tile(self.first, (len(texts), 1))
        longest = int(lengths[0]) if len(texts) else 0
        active = np.searchsorted(-lengths, -np.arange(longest), side="left")
        for t in range(longest):
            now = states[: active[t]]
            char = flat[begin[: active[t]] + t]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            states[: active[t]] = (moved & self.into[char]) | (now & self.stay[char])
        fits = np.empty((len(texts), len(self.accept)), bool)
        for i, (word, bit) in enumerate(self.accept):
            fits[order, i] = states[:, word] & bit != 0
        return fits


def _places(glob: bytes) -> list[tuple[list[int], list[int]]]:
    """Per state: the characters that lead into it, those it stays on."""
    places: list[tuple[list[int], list[int]]] = [([], [])]
    in_host = True
    for c in glob:
        any_char = [b for b in range(256) if not (in_host and b == SLASH)]
        if c == ord("*"):
            places[-1] = (places[-1][0], any_char)
        else:
            places.append((any_char if c == ord("?") else [c], []))
        in_host = in_host and c != SLASH
    return places


def judge(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    url: str = "url",
    keep: list[str] | None = None,
) -> DataFrame:
    """Add `host`, `path`, `rule`, `verdict`. `rules`: (`allow` or `block`, `host/path`)."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    address = F.coalesce(F.col(url), F.lit(""))
    host = F.translate(
        F.regexp_extract(address, parts, 1), string.ascii_uppercase, string.ascii_lowercase
    )
    found = pages.select(
        *[c for c in (pages.columns if keep is None else keep) if c not in ("host", "path")],
        host.alias("host"), F.regexp_extract(address, parts, 2).alias("path"),
    )
    ranked = sorted(rules, key=lambda r: -len(r[1]))

    def make():
        automaton = GlobAutomaton([f"*.{rule}*" for _, rule in ranked])
        names = np.array([rule for _, rule in ranked] + [None], object)

        def work(hosts, paths):
            hosts, paths = hosts.to_pylist(), paths.to_pylist()
            texts = [f".{h}{p}".encode() for h, p in zip(hosts, paths, strict=True)]
            chosen = np.full(len(texts), len(ranked))
            for a, b in common.slices(hosts):
                fits = automaton.run(texts[a:b])
                any_fits = fits.any(axis=1) if ranked else np.zeros(b - a, bool)
                chosen[a:b] = np.where(any_fits, fits.argmax(axis=1) if ranked else 0, len(ranked))
            verdicts = [
                ranked[c][0] if c < len(ranked) else "allow" if h else "block"
                for c, h in zip(chosen, hosts, strict=True)
            ]
            return [pa.array(names[chosen].tolist(), pa.string()), pa.array(verdicts, pa.string())]

        return work

    return common.append(found, ["host", "path"], "rule string, verdict string", make)
