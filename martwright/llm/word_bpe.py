"""BPE encoding and decoding with word ends, merged over a contiguous rank array.

A text is normalised, split into words and every distinct word is merged once: its parts lie side
by side in an array, beside them the rank of the merge of each part with the next. The least rank
(the leftmost among equals) is looked for, the boundary behind it deleted, and the ranks of the
two neighbours read anew, until no rank is left. Words of a batch that fall in one width class
advance together, one deleted boundary each per round, so their arrays stay contiguous and lose a
column per round. Above LONGEST bytes a scan of the whole array per merge would be quadratic:
such words take the same merges in the same order from a heap.

Ids are those of the library that the vocabulary file is written for. Words come from `re` and
`regex`; a text with characters that the interpreter's Unicode tables do not know is normalised
and split by the library itself, whose tables are newer. Merging is always done here.

Edge cases: null and empty texts, and texts of white space only, have no id and decode to the
empty text; the file's special tokens, written out in a text, become their ids; decoding joins the
tokens' own spellings, as the library does without a decoder; null ids decode to the empty text.
Very long texts and words are encoded whole. Repeated rows and null keys are kept; empty tables
give empty results; columns named like an output are replaced.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from martwright.llm import common

NONE = np.int32(2**31 - 1)
WIDTHS = (2, 4, 6, 8, 10, 12, 16, 24, 40, 64)  # bytes of the words worked on together
LONGEST = WIDTHS[-1]
CACHED = 300_000  # words a task remembers before it starts anew
SUFFIX = "</w>"

# How the vocabulary's words are told apart. For ASCII texts in lower case, and all.
ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ \t-\ra-z0-9]+")
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, spare = [], 256
    for byte in range(256):
        letters.append(chr(byte if byte in printable else spare))
        spare += byte not in printable
    return letters


@cache
def unassigned() -> np.ndarray:
    """For each code point, whether the interpreter's Unicode tables lack it."""
    return np.array([unicodedata.category(chr(c)) == "Cn" for c in range(sys.maxunicode + 1)])


class WordBpe:
    def __init__(self, content: str):
        """`content`: a vocabulary file in JSON with `model.vocab`, `model.merges`, `added_tokens`."""
        parsed = json.loads(content)
        vocab, merges = parsed["model"]["vocab"], parsed["model"]["merges"]
        self.content = content
        self.special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        self.tokens = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, number in (vocab | self.special).items():
            self.tokens[number] = token
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.final = np.array([vocab[c + SUFFIX] for c in letters], np.int64)
        self.shift = len(self.tokens).bit_length()
        self.pad = (1 << self.shift) - 1  # no token has this number
        found = {}
        for rank, pair in enumerate(merges):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            found[vocab[a] << self.shift | vocab[b]] = (rank, vocab[a + b])
        self.rule = found
        self.keys = np.array([*sorted(found), 1 << 62], np.int64)
        self.ranks = np.array([found[k][0] for k in self.keys[:-1].tolist()] + [NONE], np.int32)
        self.into = np.array([found[k][1] for k in self.keys[:-1].tolist()] + [0], np.int64)
        self._cut = re.compile("|".join(map(re.escape, self.special)) or r"(?!)")
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.known = np.zeros(0, np.uint32)

    # ---- texts to words ----

    @cached_property
    def _library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self.content)

    def words(self, text: str) -> list[str]:
        """The words of a text without special tokens."""
        if text.isascii():
            return ASCII_WORDS.findall(text.lower())
        if unassigned()[np.frombuffer(text.encode("utf-32-le"), np.uint32)].any():
            normal = self._library.normalizer.normalize_str(text)
            spans = self._library.pre_tokenizer.pre_tokenize_str(normal)
            return [normal[a:b] for _, (a, b) in spans]
        text = unicodedata.normalize("NFC", text)
        # A final sigma is lower-cased like any other.
        text = "".join(map(str.lower, text)) if "Σ" in text else text.lower()
        return WORDS.findall(text)

    def _pieces(self, text: str) -> list[str]:
        """Words and special tokens in order; a special token starts with a zero character."""
        if not self._cut.search(text):
            return self.words(text)
        out, at = [], 0
        for m in self._cut.finditer(text):
            out += [*self.words(text[at : m.start()]), "\0" + m[0]]
            at = m.end()
        return out + self.words(text[at:])

    # ---- words to ids ----

    def _pair(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the merge of neighbours and what it gives."""
        keys = a << self.shift | b
        at = np.searchsorted(self.keys, keys)
        return np.where(self.keys[at] == keys, self.ranks[at], NONE), self.into[at]

    def _merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and ids of the words, in order."""
        length = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(length) - length
        sizes, parts, low = np.zeros(len(words), np.int64), [], 0
        for width in WIDTHS:
            chosen = np.flatnonzero((length > low) & (length <= width))
            low = width
            if len(chosen):
                parts.append(self._rounds(points, starts[chosen], length[chosen], width, chosen))
        for row in np.flatnonzero(length > LONGEST):
            ids = self._merge_long(words[row])
            parts.append((np.full(len(ids), row), np.arange(len(ids)), np.array(ids, np.int64)))
        if not parts:
            return sizes, np.zeros(0, np.uint32)
        rows, places, ids = (np.concatenate(x) for x in zip(*parts, strict=True))
        sizes = np.bincount(rows, minlength=len(words))
        out = np.zeros(len(ids), np.uint32)
        out[(np.cumsum(sizes) - sizes)[rows] + places] = ids
        return sizes, out

    def _rounds(self, points, starts, length, width, rows):
        """(row, place, id) of every part left of words of at most `width` bytes."""
        column = np.arange(width)
        inside = column < length[:, None]
        parts = np.full((len(rows), width), self.pad, np.int64)
        parts[inside] = self.inner[points[(starts[:, None] + column)[inside]]]
        ends = length - 1
        parts[np.arange(len(rows)), ends] = self.final[points[starts + ends]]
        ranks, into = (x.reshape(len(rows), width - 1) for x in self._pair(
            parts[:, :-1].ravel(), parts[:, 1:].ravel()))
        done = []
        while True:
            many, width = parts.shape
            if width > 1:
                least = ranks.argmin(axis=1)
                ready = ranks[np.arange(many), least] == NONE
            else:
                least, ready = np.zeros(many, np.int64), np.ones(many, bool)
            row, place = np.nonzero(parts[ready] != self.pad)
            done.append((rows[ready][row], place, parts[ready][row, place]))
            more = ~ready
            if not more.any():
                return tuple(np.concatenate(x) for x in zip(*done, strict=True))
            rows, least, parts, ranks, into = (x[more] for x in (rows, least, parts, ranks, into))
            each = np.arange(len(rows))
            parts[each, least] = into[each, least]
            # Delete the boundary: the part after it and the rank before that part go.
            gone = np.arange(width) != (least + 1)[:, None]
            parts = parts[gone].reshape(len(rows), width - 1)
            kept = np.arange(width - 1) != least[:, None]
            ranks = ranks[kept].reshape(len(rows), width - 2)
            into = into[kept].reshape(len(rows), width - 2)
            after = np.flatnonzero(least < width - 2)
            for some, at in (after, least), (np.flatnonzero(least > 0), least - 1):
                at = at[some]
                ranks[some, at], into[some, at] = self._pair(parts[some, at], parts[some, at + 1])

    def _merge_long(self, word: bytes) -> list[int]:
        """The same merges by a heap of (rank, place), for words of any length."""
        parts = [*self.inner[list(word[:-1])].tolist(), int(self.final[word[-1]])]
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap = []

        def offer(at: int) -> None:
            if at >= 0 and after[at] < len(parts):
                key = parts[at] << self.shift | parts[after[at]]
                if key in self.rule:
                    heapq.heappush(heap, (self.rule[key][0], at, key))

        for at in range(len(parts)):
            offer(at)
        while heap:
            _, at, key = heapq.heappop(heap)
            gone = after[at]
            if gone >= len(parts) or parts[at] << self.shift | parts[gone] != key:
                continue  # one of the two is no longer there
            parts[at], parts[gone] = self.rule[key][1], -1
            after[at] = after[gone]
            if after[at] < len(parts):
                before[after[at]] = at
            offer(before[at])
            offer(at)
        return [p for p in parts if p >= 0]

    def _learn(self, words: list[str]) -> None:
        special = [w for w in words if w[0] == "\0" and w[1:] in self.special]
        plain = [w for w in words if not (w[0] == "\0" and w[1:] in self.special)]
        sizes, ids = self._merge([w.encode() for w in plain])
        sizes = np.concatenate([sizes, np.ones(len(special), np.int64)]).astype(np.int64)
        ids = np.concatenate([ids, np.array([self.special[w[1:]] for w in special], np.uint32)])
        self.place.update(zip([*plain, *special], range(len(self.sizes), len(self.sizes) + len(words))))
        self.starts = np.concatenate([self.starts, len(self.known) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.known = np.concatenate([self.known, ids.astype(np.uint32)])

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each text, and the ids of all."""
        flat, counts = [], []
        for text in texts:
            words = self._pieces(text)
            flat += words
            counts.append(len(words))
        if len(self.place) > CACHED:
            self._forget()
        coded = pa.array(flat, pa.string()).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        new = [w for w in distinct if w not in self.place]
        if new:
            self._learn(new)
        at = np.fromiter(map(self.place.__getitem__, distinct), np.int64, len(distinct))
        at = at[coded.indices.to_numpy()]
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        shifted = np.repeat(self.starts[at] - (ends - sizes), sizes)
        ids = self.known[shifted + np.arange(total)]
        return common.segment_totals(sizes, np.array(counts, np.int64)), ids

    def decode(self, ids) -> str:
        return " ".join(map(self.tokens.__getitem__, ids))


def encode(
    docs: DataFrame,
    content: str,
    text: str = "text",
    keep: list[str] | None = None,
    packed: bool = False,
) -> DataFrame:
    """Add `ids` and `decoded`, the text they decode to.

    `content` is the text of a vocabulary file. The ids are an array of int, or if `packed` their
    little-endian unsigned 32-bit numbers as one binary value, as training files hold them.
    Decoding takes place beside encoding, so ids do not travel for it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(content)  # one vocabulary

    def make():
        model = WordBpe(shared.value)

        def work(texts):
            texts, sizes, ids, decoded = common.texts_of(texts), [], [], []
            for a, b in common.slices(texts):
                many, found = model.encode_all(texts[a:b])
                sizes.append(many)
                ids.append(found)
                listed, at = found.tolist(), 0
                for n in many.tolist():
                    decoded.append(model.decode(listed[at : at + n]))
                    at += n
            return [_column(sizes, ids, packed), pa.array(decoded, pa.string())]

        return work

    kind = "binary" if packed else "array<int>"
    return common.append(docs, [text], f"ids {kind}, decoded string", make, keep)


def _column(sizes: list[np.ndarray], ids: list[np.ndarray], packed: bool) -> pa.Array:
    sizes = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
    ids = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
    ends = np.append(0, np.cumsum(sizes)).astype(np.int32)
    if packed:
        content = pa.py_buffer(ids.astype("<u4").tobytes())
        return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends * 4), content])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32)))


def decode(
    encoded: DataFrame, content: str, ids: str = "ids", keep: list[str] | None = None
) -> DataFrame:
    """Add `decoded`, the text of the ids (array or packed)."""
    shared = encoded.sparkSession.sparkContext.broadcast(content)

    def make():
        model = WordBpe(shared.value)

        def work(column):
            rows = (i.as_py() or [] for i in column)
            rows = (np.frombuffer(r, "<u4").tolist() if isinstance(r, bytes) else r for r in rows)
            return [pa.array([model.decode(r) for r in rows], pa.string())]

        return work

    return common.append(encoded, [ids], "decoded string", make, keep)
