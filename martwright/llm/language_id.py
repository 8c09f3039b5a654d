"""Language identification of mixed-language text.

Script ranges narrow the candidate languages of each word; each word gets a score per candidate
from character n-grams; Viterbi with a switching penalty then labels the words, so that a span
only changes language where the evidence outweighs the penalty. The document's language is the
one that labels most letters, its score that share of the letters.

Everything inside a task is arrays over code points: letters and their scripts come from lookup
tables, n-grams are hashed, and Viterbi runs over the documents of a batch side by side.

Edge cases: a null text or a text without a letter is `und` with score 0 and no span; words in a
script no learned language uses carry no evidence; a text made of such words only gets the most
frequent learned language; ties go to the first language in alphabetical order; with no learned
language every text is `und`. Null languages are not learned. Empty tables give empty results.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.llm import common

#: First and last code point of each script. Fixed values, from the Unicode blocks.
SCRIPT_RANGES = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F), (0xA8E0, 0xA8FF)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7FF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)],
    "han": [(0x2E80, 0x2FDF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3134F)],
}
UNDECIDED = "und"
END_OF_UNICODE = 0x110000


@dataclass(frozen=True)
class LangParams:
    buckets: int = 1 << 15  # per n-gram length
    train_rows: int = 8000  # bound of the labelled sample
    smoothing: float = 0.5
    weight: float = 0.5  # of an n-gram's log-probability: n-grams of a word overlap
    switch_penalty: float = 8.0
    least_script_share: float = 0.005  # of a language's letters, to count the script as its own


@dataclass
class LangModel:
    params: LangParams
    languages: list[str]
    grams: np.ndarray  # (2 * buckets, languages): weighted log-probabilities
    allowed: np.ndarray  # (scripts + 1, languages)
    prior: np.ndarray  # share of the sample


@cache
def unicode_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per code point: 2 for a letter, 1 for a mark inside words; lower case; script (0: none)."""
    word = np.zeros(END_OF_UNICODE, np.uint8)
    lower = np.arange(END_OF_UNICODE, dtype=np.int32)
    for c in range(END_OF_UNICODE):
        kind = unicodedata.category(chr(c))
        if kind[0] in "LM":
            word[c] = 2 if kind[0] == "L" else 1
            if kind in ("Lu", "Lt") and len(low := chr(c).lower()) == 1:
                lower[c] = ord(low)
    script = np.zeros(END_OF_UNICODE, np.uint8)
    for number, ranges in enumerate(SCRIPT_RANGES.values(), 1):
        for first, last in ranges:
            script[first : last + 1] = number
    return word, lower, script


@dataclass
class Words:
    """The words of a slice of texts, in order."""

    per_doc: np.ndarray  # words of each document
    lettered: np.ndarray  # whether the document has a letter
    letters: np.ndarray  # letters of each word
    starts: np.ndarray  # first character, counted from its document's start
    script: np.ndarray
    grams: np.ndarray  # (letters, 2) buckets


def find_words(texts: list[str], buckets: int) -> Words:
    word, lower, script = unicode_tables()
    raw = "\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass")
    points = np.frombuffer(raw, np.uint32).astype(np.int32)
    kind = word[points]
    inside = kind > 0
    low = np.where(inside, lower[points], 0)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = np.flatnonzero(first)
    offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
    doc = np.searchsorted(offsets, starts, side="right") - 1
    at = np.flatnonzero(inside)
    before = np.concatenate([[0], low])[at]
    after = np.concatenate([low, [0, 0]])
    one, two = after[at + 1], after[at + 2]
    two = np.where(one == 0, 0, two)
    here = low[at].astype(np.int64)
    three = (before.astype(np.int64) * 1_000_003 + here) * 1_000_003 + one
    four = three * 1_000_003 + two
    grams = np.empty((len(at), 2), np.int64)
    grams[:, 0] = (three ^ (three >> 15)) % buckets
    grams[:, 1] = (four ^ (four >> 17)) % buckets + buckets
    return Words(
        np.bincount(doc, minlength=len(texts)),
        np.logical_or.reduceat(kind == 2, offsets[:-1]),
        np.diff(np.searchsorted(at, starts), append=len(at)),
        starts - offsets[doc],
        script[points[starts]],
        grams,
    )


def word_scores(words: Words, model: LangModel) -> np.ndarray:
    """Evidence per word and language; languages of another script are out of the running."""
    size = len(words.grams)
    scores = np.zeros((len(words.letters), len(model.languages)), np.float32)
    if size:
        per_letter = model.grams[words.grams[:, 0]] + model.grams[words.grams[:, 1]]
        scores = common.segment_sums(per_letter, words.letters)
    allowed = model.allowed[words.script]
    scores -= scores.max(axis=1, keepdims=True, initial=-np.inf)
    scores[~allowed] = -1e4
    scores[~allowed.any(axis=1)] = 0
    return scores


def viterbi(scores: np.ndarray, per_doc: np.ndarray, penalty: float) -> np.ndarray:
    """Best language of every word; documents advance side by side, longest first."""
    path = np.zeros(len(scores), np.int64)
    if not len(scores):
        return path
    order = np.argsort(-per_doc, kind="stable")
    lengths = per_doc[order]
    begin = (np.cumsum(per_doc) - per_doc)[order]
    active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
    own = np.arange(scores.shape[1])
    back = np.empty(scores.shape, np.uint8)
    best = scores[begin[: active[0]]].astype(np.float64)
    for t in range(1, lengths[0]):
        rows = begin[: active[t]] + t
        value = best[: active[t]]
        leader = value.argmax(axis=1)
        switched = value[np.arange(len(value)), leader][:, None] - penalty
        stay = value >= switched
        back[rows] = np.where(stay, own, leader[:, None])
        best[: active[t]] = np.where(stay, value, switched) + scores[rows]
    here = best.argmax(axis=1)
    for t in range(lengths[0] - 1, -1, -1):
        rows = begin[: active[t]] + t
        path[rows] = here[: active[t]]
        if t:
            here[: active[t]] = back[rows, here[: active[t]]]
    return path


def label(texts: list[str], model: LangModel):
    """Language, score and spans (first character, end, language) of each text."""
    return label_known(texts, model)[:3]


def label_known(texts: list[str], model: LangModel):
    """`label`, and the share of letters that lie in scripts of any learned language."""
    languages, count = model.languages, len(model.languages)
    found = [
        find_words(texts[a:b], model.params.buckets)
        for a, b in common.slices(texts, max(10_000, 4 * common.SLICE_CHARS // max(4, count)))
    ]
    per_doc = np.concatenate([w.per_doc for w in found] or [np.zeros(0, np.int64)])
    letters = np.concatenate([w.letters for w in found] or [np.zeros(0, np.int64)])
    starts = np.concatenate([w.starts for w in found] or [np.zeros(0, np.int64)])
    doc = np.repeat(np.arange(len(texts)), per_doc)
    if not count:
        none = np.zeros(len(texts))
        return [UNDECIDED] * len(texts), none, [[] for _ in texts], none
    scores = np.concatenate([word_scores(w, model) for w in found]) if found else np.zeros((0, count))
    known = (
        np.concatenate([model.allowed[w.script].any(axis=1) for w in found])
        if found else np.zeros(0, bool)
    )
    path = viterbi(scores, per_doc, model.params.switch_penalty)
    share = np.bincount(
        doc * count + path, np.where(known, letters, 0), minlength=len(texts) * count
    ).reshape(-1, count)
    total = np.bincount(doc, letters, minlength=len(texts))
    learned = share.sum(axis=1) / np.maximum(total, 1)
    share[share.sum(axis=1) == 0] = model.prior * 1e-6
    chosen = share.argmax(axis=1)
    score = share[np.arange(len(texts)), chosen] / np.maximum(total, 1)
    change = np.ones(len(path), bool)
    change[1:] = (path[1:] != path[:-1]) | (doc[1:] != doc[:-1])
    heads = np.flatnonzero(change)
    tails = np.append(heads, len(path))[1:] - 1
    spans: list[list] = [[] for _ in texts]
    ends = starts + letters
    for d, a, b, lang in zip(doc[heads], starts[heads], ends[tails], path[heads], strict=True):
        spans[d].append({"start": int(a), "stop": int(b), "lang": languages[lang]})
    lettered = np.concatenate([w.lettered for w in found] or [np.zeros(0, bool)])
    names = [languages[c] if n else UNDECIDED for c, n in zip(chosen, lettered, strict=True)]
    spans = [s if n else [] for s, n in zip(spans, lettered, strict=True)]
    return names, np.where(lettered, score, 0.0), spans, np.where(lettered, learned, 0.0)


# -- Spark ---------------------------------------------------------------------------------


def train(
    docs: DataFrame,
    learn_from: Column,
    params: LangParams = LangParams(),
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> LangModel:
    """Learn from at most `params.train_rows` rows, those of the smallest key hashes.

    Tasks count n-grams and letters per script; Spark adds the counts up, so that the driver
    gets one number per language and bucket.
    """
    usable = learn_from & F.col(lang).isNotNull() & F.col(key).isNotNull()
    sample = (
        docs.filter(usable).select(key).distinct().orderBy(F.xxhash64(key), key)
        .limit(params.train_rows)
    )
    rows = docs.filter(usable).select(key, text, lang).join(F.broadcast(sample), key, "left_semi")
    size = 2 * params.buckets

    def count(batches):
        grams, scripts, seen = {}, {}, {}
        for batch in batches:
            texts, langs = common.texts_of(batch.column(0)), batch.column(1).to_pylist()
            for a, b in common.slices(texts):
                words = find_words(texts[a:b], params.buckets)
                letters = common.segment_sums(words.letters, words.per_doc).astype(np.int64)
                cuts = np.cumsum(letters)
                word_cuts = np.cumsum(words.per_doc)
                for i, name in enumerate(langs[a:b]):
                    own = words.grams[cuts[i] - letters[i] : cuts[i]]
                    w = slice(word_cuts[i] - words.per_doc[i], word_cuts[i])
                    grams[name] = grams.get(name, 0) + np.bincount(own.ravel(), minlength=size)
                    scripts[name] = scripts.get(name, 0) + np.bincount(
                        words.script[w], words.letters[w], minlength=len(SCRIPT_RANGES) + 1
                    )
                    seen[name] = seen.get(name, 0) + 1
        for name, counts in grams.items():
            yield _counts(name, 0, counts)
            yield _counts(name, 1, scripts[name])
            yield _counts(name, 2, np.array([seen[name]]))

    counted = (
        rows.select(text, lang).mapInArrow(count, "lang string, kind int, bucket int, n double")
        .groupBy("lang", "kind", "bucket").agg(F.sum("n").alias("n")).collect()
    )
    languages = sorted({r["lang"] for r in counted})
    number = {name: i for i, name in enumerate(languages)}
    tables = [np.zeros((n, len(languages))) for n in (size, len(SCRIPT_RANGES) + 1, 1)]
    for r in counted:
        tables[r["kind"]][r["bucket"], number[r["lang"]]] = r["n"]
    grams, scripts, seen = tables
    halves = [h + params.smoothing for h in (grams[: params.buckets], grams[params.buckets :])]
    logs = np.concatenate([np.log(h / h.sum(axis=0)) for h in halves]) * params.weight
    share = scripts / np.maximum(scripts.sum(axis=0), 1)
    return LangModel(
        params, languages, logs.astype(np.float32), share >= params.least_script_share,
        (seen[0] / max(seen.sum(), 1)),
    )


def _counts(name: str, kind: int, counts: np.ndarray) -> pa.RecordBatch:
    bucket = np.flatnonzero(counts)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([name] * len(bucket), pa.string()), pa.array([kind] * len(bucket), pa.int32()),
            pa.array(bucket, pa.int32()), pa.array(counts[bucket], pa.float64()),
        ],
        names=["lang", "kind", "bucket", "n"],
    )


def identify(
    docs: DataFrame,
    model: LangModel,
    text: str = "text",
    keep: list[str] | None = None,
    out: tuple[str, str, str] = ("lang_pred", "score", "spans"),
    known: str = "",
) -> DataFrame:
    """Add language, score and spans (array of start, stop, lang in characters).

    `known`, if given, names a column with the share of letters in scripts of learned languages:
    a text in two of them has a low score but a high share.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets times languages

    def make():
        def work(texts):
            names, score, spans, share = [], [], [], []
            texts = common.texts_of(texts)
            for a, b in common.slices(texts, 8 * common.SLICE_CHARS):
                n, s, p, k = label_known(texts[a:b], shared.value)
                names, spans = names + n, spans + p
                score.append(s)
                share.append(k)
            numbers = [
                pa.array(np.concatenate(x) if x else [], pa.float64()) for x in (score, share)
            ]
            made = [pa.array(names, pa.string()), numbers[0], pa.array(spans, SPANS)]
            return [*made, numbers[1]] if known else made

        return work

    outputs = "{} string, {} double, {} array<struct<start:int,stop:int,lang:string>>".format(*out)
    return common.append(docs, [text], outputs + (f", {known} double" if known else ""), make, keep)


SPANS = pa.list_(
    pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("lang", pa.string())])
)
