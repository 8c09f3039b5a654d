"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

A document becomes a sparse vector x: hashed words with x = sqrt(tf / T), so that their squares
sum to one, and one entry per structure statistic or metadata value, placed in quantile bins.
The score is sigmoid(w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j); the pairwise sum costs
linear time by the sum-of-squares identity
    sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2].

Training takes a bounded sample of labelled rows (`FMParams.train_rows`), featurised by Spark;
the weights are fitted in numpy. Scoring is one narrow pass over whole texts.

Edge cases: a null text counts as empty and is scored by its structure and metadata alone; a
null length falls in a bin of its own; repeated rows are scored alike; rows without a usable
label are left out of training; with no labelled row at all, or one class only, every score is
that class's share (0.5 with no label). Empty tables give empty results.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.llm import common

STATS = (
    "chars", "word_length", "letters", "digits", "upper", "space", "lines", "marks", "symbols",
    "distinct", "top_word", "repeats", "stated_chars",
)


@dataclass(frozen=True)
class FMParams:
    buckets: int = 1 << 15  # hashed words
    bins: int = 16  # per structure statistic
    rank: int = 8
    train_rows: int = 5000  # bound of the labelled sample
    steps: int = 240  # of gradient descent, however few the rows
    batch: int = 128
    rate: float = 0.05
    decay: float = 1e-4
    seed: int = 7


@dataclass
class FMModel:
    params: FMParams
    edges: np.ndarray  # (statistics, bins - 1)
    bias: float = 0.0
    weights: np.ndarray = field(default=None)
    factors: np.ndarray = field(default=None)


# -- features ------------------------------------------------------------------------------


class WordBuckets(dict):
    """Bucket of each word, remembered for up to `most` words."""

    def __init__(self, buckets: int, most: int = 200_000):
        super().__init__()
        self.buckets, self.most = buckets, most

    def __missing__(self, word: str) -> int:
        bucket = zlib.crc32(word.encode("utf-8", "surrogatepass")) % self.buckets
        if len(self) < self.most:
            self[word] = bucket
        return bucket


def _byte_classes() -> np.ndarray:
    kind = np.zeros(256, np.uint8)
    for b in range(256):
        c = chr(b)
        if b >= 128 or c.islower():
            kind[b] = 1
        elif c.isupper():
            kind[b] = 2
        elif c.isdigit():
            kind[b] = 3
        elif c == "\n":
            kind[b] = 4
        elif c.isspace():
            kind[b] = 5
        elif c in ".,;:!?'\"()-":
            kind[b] = 6
        else:
            kind[b] = 7
    return kind


BYTE_CLASS = _byte_classes()


def word_features(texts: list[str], words: WordBuckets):
    """(document, bucket, tf) of the hashed words; each document's words, and how many of them
    repeat the one before."""
    counts, repeats = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    parts = []
    for i, text in enumerate(texts):
        found = text.lower().split()
        counts[i] = len(found)
        parts.append(np.fromiter(map(words.__getitem__, found), np.int64, len(found)))
        repeats[i] = np.count_nonzero(parts[-1][1:] == parts[-1][:-1])
    keys = np.repeat(np.arange(len(texts)), counts) * words.buckets
    keys += np.concatenate(parts) if parts else np.zeros(0, np.int64)
    keys, tf = np.unique(keys, return_counts=True)
    return keys // words.buckets, keys % words.buckets, tf, counts, repeats


def structure(texts: list[str], stated: np.ndarray, doc, tf, counts, repeats) -> np.ndarray:
    """The statistics of STATS per document; nan where there is none."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    kinds = BYTE_CLASS[np.frombuffer(b"".join(raw), np.uint8)]
    share = [common.segment_sums((kinds == k).astype(np.uint8), size) for k in range(1, 8)]
    low, up, digit, line, space, mark, symbol = (s / np.maximum(size, 1) for s in share)
    words = np.maximum(counts, 1)
    distinct = np.bincount(doc, minlength=len(texts))
    top = np.zeros(len(texts))
    np.maximum.at(top, doc, tf)
    return np.stack(
        [
            np.log2(1 + size), size / words, low + up, digit, up, space, line, mark, symbol,
            distinct / words, top / words, repeats / words, np.log2(1 + np.maximum(stated, 0)),
        ],
        axis=1,
    )


def vectors(texts: list[str], stated: np.ndarray, words: WordBuckets):
    """Sparse word part (doc, bucket, x) and the raw statistics."""
    doc, bucket, tf, counts, repeats = word_features(texts, words)
    x = np.sqrt(tf / np.maximum(counts, 1)[doc])
    return doc, bucket, x.astype(np.float32), structure(texts, stated, doc, tf, counts, repeats)


def binned(stats: np.ndarray, edges: np.ndarray, params: FMParams) -> np.ndarray:
    """Feature number of each statistic; the last bin is for missing values."""
    out = np.empty(stats.shape, np.int64)
    for j in range(stats.shape[1]):
        bins = np.searchsorted(edges[j], stats[:, j], side="right")
        bins[np.isnan(stats[:, j])] = params.bins
        out[:, j] = params.buckets + j * (params.bins + 1) + bins
    return out


# -- model ---------------------------------------------------------------------------------

#: Weight of a statistic's entry beside the words, whose squares sum to one.
STAT_X = np.float32(1.0)


def logits(model: FMModel, doc, bucket, x, stats) -> np.ndarray:
    """Linear-time scores by the sum-of-squares identity."""
    n = len(stats)
    counts = np.bincount(doc, minlength=n)
    linear = common.segment_sums(model.weights[bucket] * x, counts)
    vx = model.factors[bucket] * x[:, None]
    total, squares = common.segment_sums(vx, counts), common.segment_sums(vx * vx, counts)
    for ids in binned(stats, model.edges, model.params).T:
        linear = linear + model.weights[ids] * STAT_X
        vs = model.factors[ids] * STAT_X
        total, squares = total + vs, squares + vs * vs
    return model.bias + linear + 0.5 * (total * total - squares).sum(axis=1)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]], params: FMParams) -> FMModel:
    """Weights by AdaGrad on the log loss. `rows`: buckets, x, statistics, label."""
    size = params.buckets + len(STATS) * (params.bins + 1)
    rng = np.random.default_rng(params.seed)
    edges = np.zeros((len(STATS), params.bins - 1))
    model = FMModel(params, edges, weights=np.zeros(size, np.float32))
    model.factors = np.zeros((size, params.rank), np.float32)
    labels = np.array([r[3] for r in rows], np.float32)
    if len(labels) == 0 or labels.min() == labels.max():
        share = float(labels.mean()) if len(labels) else 0.5
        model.bias = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
        return model
    stats = np.array([r[2] for r in rows])
    for j in range(len(STATS)):
        seen = stats[~np.isnan(stats[:, j]), j]
        if len(seen):
            edges[j] = np.quantile(seen, np.arange(1, params.bins) / params.bins)
    model.factors = rng.normal(0, 0.02, (size, params.rank)).astype(np.float32)
    stat_ids = binned(stats, edges, params)
    model.bias = float(np.log(labels.mean() / (1 - labels.mean())))
    seen_w, seen_v = np.full(size, 1e-6, np.float32), np.full(model.factors.shape, 1e-6, np.float32)
    rounds = -(-params.steps * min(params.batch, len(rows)) // len(rows))
    for _ in range(rounds):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), params.batch):
            chosen = order[at : at + params.batch]
            ids = [np.concatenate([rows[i][0], stat_ids[i]]) for i in chosen]
            counts = np.fromiter(map(len, ids), np.int64, len(ids))
            x = np.concatenate(
                [np.concatenate([rows[i][1], np.full(len(STATS), STAT_X)]) for i in chosen]
            ).astype(np.float32)
            ids = np.concatenate(ids)
            vx = model.factors[ids] * x[:, None]
            total = common.segment_sums(vx, counts)
            pairs = 0.5 * (total**2 - common.segment_sums(vx * vx, counts)).sum(axis=1)
            z = model.bias + common.segment_sums(model.weights[ids] * x, counts) + pairs
            slope = (sigmoid(z) - labels[chosen]) / len(chosen)
            at_row = np.repeat(slope, counts)[:, None]
            slopes_v = at_row * x[:, None] * (np.repeat(total, counts, axis=0) - vx)
            by_id = np.argsort(ids, kind="stable")
            used, per_id = np.unique(ids[by_id], return_counts=True)
            grad_w = common.segment_sums((at_row[:, 0] * x)[by_id], per_id)
            grad_v = common.segment_sums(slopes_v[by_id], per_id)
            grad_w += params.decay * model.weights[used]
            grad_v += params.decay * model.factors[used]
            seen_w[used] += grad_w**2
            seen_v[used] += grad_v**2
            model.weights[used] -= params.rate * grad_w / np.sqrt(seen_w[used])
            model.factors[used] -= params.rate * grad_v / np.sqrt(seen_v[used])
            model.bias -= params.rate * float(slope.sum())
    return model


# -- Spark ---------------------------------------------------------------------------------


def train(
    docs: DataFrame,
    labels: DataFrame,
    learn_from: Column,
    params: FMParams = FMParams(),
    key: str = "doc_id",
    text: str = "text",
    stated: str = "n_chars",
    target: str = "quality",
) -> FMModel:
    """Fit on at most `params.train_rows` labelled rows, those of the smallest key hashes."""
    usable = labels.filter(learn_from & F.col(target).isin(0, 1) & F.col(key).isNotNull())
    sample = (
        usable.select(key, F.col(target).cast("int").alias("__label"))
        .distinct()
        .orderBy(F.xxhash64(key), key, "__label")
        .limit(params.train_rows)
    )
    rows = docs.select(key, text, stated).join(F.broadcast(sample), key)  # bounded by train_rows

    def make():
        words = WordBuckets(params.buckets)

        def work(texts, lengths):
            texts = common.texts_of(texts)
            lengths = np.asarray(lengths.cast(pa.float64()).to_numpy(zero_copy_only=False))
            out = []
            for a, b in common.slices(texts):
                doc, bucket, x, stats = vectors(texts[a:b], lengths[a:b], words)
                cuts = np.searchsorted(doc, np.arange(1, b - a))
                out += zip(np.split(bucket, cuts), np.split(x, cuts), stats, strict=True)
            parts = list(zip(*out, strict=True)) or [[], [], []]
            types = (pa.list_(pa.int32()), pa.list_(pa.float32()), pa.list_(pa.float64()))
            return [
                pa.array([v.tolist() for v in p], t) for p, t in zip(parts, types, strict=True)
            ]

        return work

    made = common.append(
        rows, [text, stated], "buckets array<int>, x array<float>, stats array<double>",
        make, [key, "__label"],
    ).collect()
    made.sort(key=lambda r: (str(r[0]), r[1], len(r[2]), r[2]))  # rows arrive in any order
    return fit(
        [(np.array(r[2], np.int64), np.array(r[3], np.float32), np.array(r[4]), r[1]) for r in made],
        params,
    )


def score(
    docs: DataFrame,
    model: FMModel,
    text: str = "text",
    stated: str = "n_chars",
    keep: list[str] | None = None,
    out: str = "score",
) -> DataFrame:
    """Add `out` (0 to 1, higher: better) to every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # size fixed by FMParams

    def make():
        words = WordBuckets(shared.value.params.buckets)

        def work(texts, lengths):
            texts = common.texts_of(texts)
            lengths = np.asarray(lengths.cast(pa.float64()).to_numpy(zero_copy_only=False))
            out = [
                logits(shared.value, *vectors(texts[a:b], lengths[a:b], words))
                for a, b in common.slices(texts)
            ]
            return [pa.array(sigmoid(np.concatenate(out)) if out else [], pa.float64())]

        return work

    return common.append(docs, [text, stated], f"{out} double", make, keep)
