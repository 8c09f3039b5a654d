"""Language-model scores by masked pseudo-likelihood.

A small network in numpy predicts a token from the `SIDE` tokens on both of its sides:
    h = tanh(sum over places o of E[w(t + o)] A[o] + b)
    P(w | sides) = P(class of w | h) P(w | class, h)
The vocabulary is cut into classes of equal size by frequency, so that a token costs two short
softmaxes. A document's score is the sum of the conditional log-probabilities of all its tokens,
each masked in turn. Without given params the vocabulary is open: a word outside the most frequent
ones costs, besides the network's probability of an unknown word, that of its letters,
    P(w | unknown) = product over characters of P(c | the two before it),
from trigram counts over all such words of the corpus, smoothed down to a uniform distribution over
all code points (Witten-Bell), so that a rare or garbled word is charged for what it says.

What is gathered grows with the corpus: word counts over all documents (each task sends what it
has counted, Spark adds up), the trigrams of the rare ones, then weights. Texts are cut into tokens
once: training and scoring read a table of ids. Training is iterative parameter mixing over shards:
a document's shard follows from a hash of its key, the number of shards from the number of tokens,
and a shard's documents are sorted by that hash, so the weights do not depend on how the input is
dealt over files and tasks. In each round every shard is gone over from the mixed weights, masking
every `mask_every`-th token from one phase after another. The phases are dealt over the rounds, so
that every token is a target at least once. Then its weights are sent with the number of targets
seen; Spark averages them block by block, as a stream.

Edge cases: null and empty texts have no token, log-probability 0 and a null mean; with given
params words outside the vocabulary are one unknown token and no more; places beyond the text are a padding token; repeated rows
are scored alike (and count in training as often as they occur). Ties in frequency go to the
alphabetically first word. Without documents there is nothing to score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm import common

PLACES = (-2, -1, 1, 2)
SIDE = 2
PAD, UNKNOWN = 0, 1
COUNTED = 200_000  # distinct words a task holds before it sends its counts
BLOCK = 4096  # weights averaged together
CHUNK = 8192  # tokens scored together
RAISED = 60.0  # e to so much, summed over a vocabulary, is far within 32-bit numbers, and so is 1 / it
SHARD_TOKENS = 2_000_000  # tokens of a shard, about; one longer document is not split
MASKED_TOKENS = 250_000  # tokens of a shard that are masked together, phase after phase


@dataclass(frozen=True)
class LMParams:
    classes: int = 48
    per_class: int = 48  # the vocabulary has classes * per_class tokens
    width: int = 16
    hidden: int = 32
    rounds: int = 2
    mask_every: int = 32  # targets of one phase; the rounds share the phases
    batch: int = 4096
    rate: float = 0.1
    seed: int = 11
    spelled: bool = False  # words outside the vocabulary are charged for their letters

    def phases(self, turn: int) -> range:
        """Where the masks of a round start; over all rounds each phase comes at least once."""
        return range(turn % self.mask_every, self.mask_every, self.rounds)

    @property
    def size(self) -> int:
        return self.classes * self.per_class

    def shapes(self) -> dict[str, tuple[int, ...]]:
        return {
            "embed": (self.size, self.width),
            "mix": (len(PLACES) * self.width, self.hidden),
            "bias": (self.hidden,),
            "outer": (self.hidden, self.classes),
            "outer_bias": (self.classes,),
            "inner": (self.classes, self.hidden, self.per_class),
            "inner_bias": (self.classes, self.per_class),
        }


Weights = dict[str, np.ndarray]


def initial(params: LMParams) -> Weights:
    rng = np.random.default_rng(params.seed)
    return {
        name: (
            np.zeros(shape) if "bias" in name else rng.normal(0, shape[-2] ** -0.5, shape)
        ).astype(np.float32)
        for name, shape in params.shapes().items()
    }


def packed(weights: Weights) -> np.ndarray:
    return np.concatenate([w.ravel() for w in weights.values()])


def unpacked(flat: np.ndarray, params: LMParams) -> Weights:
    weights, at = {}, 0
    for name, shape in params.shapes().items():
        size = int(np.prod(shape))
        weights[name] = flat[at : at + size].reshape(shape).astype(np.float32)
        at += size
    return weights


# -- tokens and windows --------------------------------------------------------------------


class Tokens(dict):
    """Token of a word."""

    def __init__(self, words: list[str]):
        super().__init__({w: i + 2 for i, w in enumerate(words)})

    def __missing__(self, word: str) -> int:
        return UNKNOWN


START, STOP = "\n", " "  # never in a word, which holds no white space
CHARACTERS = 0x110000


class Spelling:
    """Log-probability of the letters of words."""

    def __init__(self, trigrams: Iterable[tuple[str, int]]):
        # Per context of 2, 1 and 0 characters: how often each followed; in all, and how many kinds.
        self.seen: tuple[dict[str, int], ...] = ({}, {}, {})
        self.total: tuple[dict[str, list[int]], ...] = ({}, {}, {})
        for three, n in trigrams:
            for k in range(3):
                self.seen[k][three[k:]] = self.seen[k].get(three[k:], 0) + n
        for seen, total in zip(self.seen, self.total, strict=True):
            for gram, n in seen.items():
                both = total.setdefault(gram[:-1], [0, 0])
                both[0] += n
                both[1] += 1
        # The steps of all trigrams that were seen, by their three code points.
        points = _points("".join(self.seen[0])).reshape(-1, 3)
        keys, steps = _packed_three(points), np.fromiter(map(self.step, self.seen[0]), float)
        order = np.argsort(keys)
        self.keys, self.steps = np.append(keys[order], -1), np.append(steps[order], 0.0)

    def step(self, three: str) -> float:
        """Log-probability of the third character after the other two."""
        p = 1 / CHARACTERS
        for k in (2, 1, 0):
            if both := self.total[k].get(three[k:-1]):
                p = (self.seen[k].get(three[k:], 0) + both[1] * p) / (both[0] + both[1])
        return float(np.log(p))

    def __getitem__(self, word: str) -> float:
        return float(self.costs([word])[0])

    def costs(self, words: list[str]) -> np.ndarray:
        """Log-probability of each word."""
        if not words:
            return np.zeros(0)
        spelled = [START * 2 + w + STOP for w in words]
        points = _points("".join(spelled))
        sizes = np.fromiter(map(len, spelled), np.int64, len(spelled))
        keys = _packed_three(np.stack([points[:-2], points[1:-1], points[2:]], axis=1))
        last = np.cumsum(sizes)[:-1]
        inside = np.ones(len(keys), bool)  # not over the end of a word
        inside[last - 1] = inside[last - 2] = False
        keys = keys[inside]
        at = np.searchsorted(self.keys[:-1], keys)
        steps = self.steps[at]
        for i in np.flatnonzero(self.keys[at] != keys).tolist():
            steps[i] = self.step("".join(chr(keys[i] >> k & 0x1FFFFF) for k in (42, 21, 0)))
        return common.segment_sums(steps, sizes - 2)


class Numbered(dict):
    """Number of a word: its token, or for a word outside the vocabulary one of its own, from the
    size of the vocabulary on, with what its letters cost. Up to COUNTED of those are kept."""

    def __init__(self, words: list[str], spelling: Spelling | None):
        self.size, self.spelling = len(words) + 2, spelling
        self.tokens = {w: i + 2 for i, w in enumerate(words)}
        self._restart()

    def _restart(self) -> None:
        self.clear()
        self.update(self.tokens)
        self.new: list[str] = []  # not spelled yet
        self.costs = np.zeros(0)

    def __missing__(self, word: str) -> int:
        number = self[word] = self.size + len(self.costs) + len(self.new)
        self.new.append(word)
        return number

    def cut(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All tokens, number per text, and what the letters of each text's words cost."""
        if len(self.costs) > COUNTED:
            self._restart()
        found = [t.lower().split() for t in texts]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        words = chain.from_iterable(found)
        flat = np.fromiter(map(self.__getitem__, words), np.int64, counts.sum())
        new = self.spelling.costs(self.new) if self.spelling else np.zeros(len(self.new))
        self.costs, self.new = np.concatenate([self.costs, new]), []
        outside = np.flatnonzero(flat >= self.size)
        costs = np.zeros(len(flat))
        costs[outside] = self.costs[flat[outside] - self.size]
        flat[outside] = UNKNOWN
        return flat, counts, common.segment_sums(costs, counts)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)


def _packed_three(points: np.ndarray) -> np.ndarray:
    return points[:, 0] << 42 | points[:, 1] << 21 | points[:, 2]


def padded_tokens(flat: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens with SIDE paddings around each text, and the places of real ones."""
    row = np.repeat(np.arange(len(counts)), counts)
    places = np.arange(len(flat)) + SIDE * (row + 1)
    padded = np.full(len(flat) + SIDE * (len(counts) + 1), PAD)
    padded[places] = flat
    return padded, places


def tokenise(texts: list[str], tokens: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens with SIDE paddings around each text, places of real ones, number per text."""
    found = [t.lower().split() for t in texts]
    counts = np.fromiter(map(len, found), np.int64, len(found))
    words = chain.from_iterable(found)
    flat = np.fromiter(map(tokens.__getitem__, words), np.int64, counts.sum())
    return *padded_tokens(flat, counts), counts


# -- network -------------------------------------------------------------------------------


def _within_reach(z: np.ndarray, axis: int) -> None:
    """Subtract the largest along an axis, where there is a number too far from 0 to be raised; a
    softmax is the same without, and maxima of short rows cost as much as the rest of it."""
    if max(z.max(), -z.min()) > RAISED:
        z -= z.max(axis=axis, keepdims=True)


def _softmax(z: np.ndarray) -> np.ndarray:
    """In place, over the columns of each row."""
    _within_reach(z, 1)
    np.exp(z, out=z)
    z /= (z @ np.ones(z.shape[1], z.dtype))[:, None]
    return z


def _log_chosen(z: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Log-probability of the chosen row of each column; overwrites `z`."""
    _within_reach(z, 0)
    found = z[chosen, np.arange(z.shape[1])]
    np.exp(z, out=z)
    return found - np.log(z.sum(axis=0))


def _order(values: np.ndarray, limit: int) -> np.ndarray:
    """Stable order of values below a limit; short integers are sorted by their digits."""
    return np.argsort(values.astype(np.uint16) if limit <= 1 << 16 else values, kind="stable")


def _cuts(group: np.ndarray, classes: int) -> list[int]:
    """Where each class starts in sorted classes."""
    return np.searchsorted(group, np.arange(classes + 1)).tolist()


def log_probabilities(w: Weights, padded: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Log-probability of the token at each place, given those on both sides."""
    classes, _, per_class = w["inner"].shape
    # What a token adds to the hidden layer at each of the places beside.
    added = [w["embed"] @ mix for mix in np.split(w["mix"], len(PLACES))]
    out = np.empty(len(places))
    for a in range(0, len(places), CHUNK):
        own = places[a : a + CHUNK]
        order = _order(padded[own], len(w["embed"]))
        own = own[order]
        group, member = padded[own] // per_class, padded[own] % per_class
        total = added[0].take(padded[own + PLACES[0]], axis=0)
        for rows, o in zip(added[1:], PLACES[1:], strict=True):
            total += rows.take(padded[own + o], axis=0)
        total += w["bias"]
        h = np.ascontiguousarray(np.tanh(total, out=total).T)
        z = w["outer"].T @ h
        z += w["outer_bias"][:, None]
        part = _log_chosen(z, group)
        z = np.empty((per_class, len(own)), h.dtype)
        cuts = _cuts(group, classes)
        for c, (s, e) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if e > s:
                z[:, s:e] = w["inner"][c].T @ h[:, s:e]
                z[:, s:e] += w["inner_bias"][c][:, None]
        out[a + order] = part + _log_chosen(z, member)
    return out


class Trainer:
    """AdaGrad on the negative log-probability of masked tokens."""

    def __init__(self, weights: Weights, params: LMParams):
        self.w, self.params = {n: x.copy() for n, x in weights.items()}, params
        self.seen = {n: np.full(x.shape, 1e-4, np.float32) for n, x in weights.items()}

    def _move(self, name: str, grad: np.ndarray) -> None:
        seen = self.seen[name]
        seen += grad * grad
        grad *= self.params.rate
        grad /= np.sqrt(seen)
        self.w[name] -= grad

    def step(self, padded: np.ndarray, places: np.ndarray) -> None:
        w, n, params = self.w, len(places), self.params
        # By token, so that the rows of a class lie side by side.
        places = places[_order(padded[places], params.size)]
        group, member = padded[places] // params.per_class, padded[places] % params.per_class
        rows = np.arange(n)
        context = np.stack([padded[places + o] for o in PLACES], axis=1).ravel()
        seen = w["embed"].take(context, axis=0).reshape(n, -1)
        h = seen @ w["mix"]
        h += w["bias"]
        np.tanh(h, out=h)
        d_outer = h @ w["outer"]
        d_outer += w["outer_bias"]
        _softmax(d_outer)[rows, group] -= 1
        d_h = d_outer @ w["outer"].T
        cuts = _cuts(group, params.classes)
        used = [c for c in range(params.classes) if cuts[c + 1] > cuts[c]]
        d = np.empty((n, params.per_class), h.dtype)
        for c in used:
            own = slice(cuts[c], cuts[c + 1])
            np.matmul(h[own], w["inner"][c], out=d[own])
            d[own] += w["inner_bias"][c]
        _softmax(d)[rows, member] -= 1
        d_inner, d_inner_bias = np.zeros_like(w["inner"]), np.zeros_like(w["inner_bias"])
        for c in used:
            own = slice(cuts[c], cuts[c + 1])
            d_h[own] += d[own] @ w["inner"][c].T
            np.matmul(h[own].T, d[own], out=d_inner[c])
            np.matmul(np.ones(cuts[c + 1] - cuts[c], d.dtype), d[own], out=d_inner_bias[c])
        d_z = np.subtract(1, h * h)
        d_z *= d_h
        d_seen = (d_z @ w["mix"].T).reshape(-1, params.width)
        by = _order(context, params.size)
        counts = np.bincount(context, minlength=params.size)
        d_embed = common.segment_sums(d_seen.take(by, axis=0), counts)
        every = np.ones(n, h.dtype)
        self._move("inner", d_inner / n)
        self._move("inner_bias", d_inner_bias / n)
        self._move("outer", h.T @ d_outer / n)
        self._move("outer_bias", every @ d_outer / n)
        self._move("mix", seen.T @ d_z / n)
        self._move("bias", every @ d_z / n)
        self._move("embed", d_embed / n)


# -- Spark ---------------------------------------------------------------------------------


@dataclass
class LMModel:
    params: LMParams
    words: list[str]
    weights: Weights
    trigrams: list[tuple[str, int]] | None = None  # of the words outside, if those are spelled


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every word of the documents and how often it occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            texts = common.texts_of(batch.column(0))
            for a, b in common.slices(texts):
                for t in texts[a:b]:
                    counts.update(t.lower().split())
                if len(counts) >= COUNTED:
                    yield _counted(counts)
                    counts.clear()
        yield _counted(counts)

    counted = docs.select(text).mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame, size: int) -> list[str]:
    """The most frequent words."""
    top = counts.orderBy(F.desc("n"), "word")
    return [r["word"] for r in top.limit(size).collect()]


def trigrams_outside(counts: DataFrame, words: list[str]) -> list[tuple[str, int]]:
    """Trigrams of all words outside the vocabulary, with how often they occur.

    There are as many as the scripts of the corpus allow, not as it has words.
    """
    known = counts.sparkSession.sparkContext.broadcast(frozenset(words))  # size fixed by LMParams

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, int] = {}
        for batch in batches:
            for word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if word in known.value:
                    continue
                own = START * 2 + word + STOP
                for i in range(len(own) - 2):
                    three = own[i : i + 3]
                    sums[three] = sums.get(three, 0) + n
                if len(sums) >= COUNTED:
                    yield _counted(sums)
                    sums.clear()
        yield _counted(sums)

    made = counts.mapInArrow(cut, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return [(r["word"], r["n"]) for r in made.collect()]


def _counted(counts: dict[str, int]) -> pa.RecordBatch:
    columns = [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["word", "n"])


#: What a model is trained with if nothing else is asked for.
OPEN = LMParams(spelled=True)


def read_words(docs: DataFrame, params: LMParams = OPEN, text: str = "text") -> LMModel:
    """Vocabulary and spelling from all documents; weights not trained yet."""
    counts = word_counts(docs, text)
    if params.spelled:
        counts = common.written(counts, "word-counts")  # read twice
    words = vocabulary(counts, params.size - 2)
    trigrams = trigrams_outside(counts, words) if params.spelled else None
    return LMModel(params, words, initial(params), trigrams)


def encode(
    docs: DataFrame, model: LMModel, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Add `lm_ids` (tokens as little-endian unsigned 16-bit numbers) and `lm_spelled`, what the
    letters of the words outside the vocabulary cost."""
    if model.params.size > 1 << 16:
        raise ValueError("ids have 16 bits")
    shared = docs.sparkSession.sparkContext.broadcast((model.words, model.trigrams))

    def make():
        words, trigrams = shared.value
        numbered = Numbered(words, None if trigrams is None else Spelling(trigrams))

        def work(texts):
            texts, ids, spelled = common.texts_of(texts), [], []
            for a, b in common.slices(texts):
                flat, counts, costs = numbered.cut(texts[a:b])
                ends = np.cumsum(counts)
                flat16 = flat.astype("<u2")
                ids += [flat16[e - n : e].tobytes() for n, e in zip(counts, ends, strict=True)]
                spelled.append(costs)
            sums = np.concatenate(spelled) if spelled else np.zeros(0)
            return [pa.array(ids, pa.binary()), pa.array(sums, pa.float64())]

        return work

    return common.append(docs, [text], "lm_ids binary, lm_spelled double", make, keep)


def _sharded(coded: DataFrame, key: str | None) -> DataFrame:
    """(shard, ids), the rows of a shard together in one file and in the order of their hash."""
    size = F.octet_length("lm_ids")
    total = coded.agg(F.sum(size)).first()[0] or 0
    shards = max(1, -(-total // (2 * SHARD_TOKENS)))
    named = F.xxhash64(F.lit("shard"), *([F.col(key)] if key else [F.col("lm_ids")]))
    rows = coded.filter(size > 0).select(
        F.pmod(named, F.lit(shards)).alias("shard"), named.alias("place"), F.col("lm_ids").alias("ids")
    )
    # The ids themselves settle the order of rows that share a key.
    order = ["shard", "place", "ids"]
    dealt = rows.repartitionByRange(shards, "shard").sortWithinPartitions(*order)
    return common.written(dealt.select("shard", "ids"), "lm-shards")


def _targets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """Shards in pieces of about MASKED_TOKENS tokens, cut alike however rows come in batches."""
    now, held, size = None, [], 0
    for batch in batches:
        for shard, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and (shard != now or size >= 2 * MASKED_TOKENS):
                yield now, held
                held, size = [], 0
            now = shard
            held.append(ids)
            size += len(ids)
    if held:
        yield now, held


def fit(coded: DataFrame, model: LMModel, key: str | None = None) -> LMModel:
    """The model with weights trained on encoded documents, in shards by hash of `key` (of the ids
    without one, which puts copies into one shard)."""
    params, weights = model.params, model.weights
    session = coded.sparkSession
    common.importable(session)
    shards = _sharded(coded, key)
    for turn in range(params.rounds):
        shared = session.sparkContext.broadcast(weights)  # fixed size

        def learn(batches, turn=turn, shared=shared):
            now, trainer, targets = None, None, 0

            def sent():
                flat = packed(trainer.w) * targets
                blocks = [flat[s : s + BLOCK] for s in range(0, len(flat), BLOCK)]
                return pa.RecordBatch.from_arrays(
                    [
                        pa.array(range(len(blocks)), pa.int32()),
                        pa.array([float(targets)] * len(blocks)),
                        pa.array(blocks, pa.list_(pa.float32())),
                    ],
                    names=["block", "targets", "total"],
                )

            for shard, held in _targets(batches):
                if shard != now:
                    if targets:
                        yield sent()
                    now, trainer, targets = shard, Trainer(shared.value, params), 0
                counts = np.fromiter(map(len, held), np.int64, len(held)) // 2
                flat = np.frombuffer(b"".join(held), "<u2").astype(np.int64)
                padded, places = padded_tokens(flat, counts)
                for phase in params.phases(turn):
                    masked = places[phase :: params.mask_every]
                    for s in range(0, len(masked), params.batch):
                        trainer.step(padded, masked[s : s + params.batch])
                    targets += len(masked)
            if targets:
                yield sent()

        def add(batches):
            sums: dict[int, tuple[float, np.ndarray]] = {}
            for batch in batches:
                for block, n, total in zip(*batch.columns, strict=True):
                    old, values = sums.get(block.as_py(), (0.0, 0.0))
                    flat = total.values.to_numpy().astype(np.float64)
                    sums[block.as_py()] = old + n.as_py(), values + flat
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(sums, pa.int32()),
                    pa.array([n for n, _ in sums.values()], pa.float64()),
                    pa.array([v for _, v in sums.values()], pa.list_(pa.float64())),
                ],
                names=["block", "targets", "total"],
            )

        sent = shards.mapInArrow(learn, "block int, targets double, total array<float>")
        mixed = sent.repartition("block").mapInArrow(
            add, "block int, targets double, total array<double>"
        )
        found = sorted(mixed.collect())  # one row per block of weights
        if found:
            flat = np.concatenate([np.array(r["total"]) / r["targets"] for r in found])
            weights = unpacked(flat, params)
        shared.unpersist()
    return LMModel(params, model.words, weights, model.trigrams)


def train(
    docs: DataFrame, params: LMParams = OPEN, text: str = "text", key: str | None = "doc_id"
) -> LMModel:
    """Vocabulary, spelling and weights from all documents."""
    common.importable(docs.sparkSession)
    key = key if key in docs.columns else None
    model = read_words(docs, params, text)
    coded = common.written(encode(docs, model, text, [key] if key else []), "lm-ids")
    return fit(coded, model, key)


def score_encoded(
    coded: DataFrame, model: LMModel, keep: list[str] | None = None
) -> DataFrame:
    """`score` of documents that are encoded."""
    shared = coded.sparkSession.sparkContext.broadcast(model.weights)  # fixed size

    def make():
        def work(ids, spelled):
            held, sums = ids.to_pylist(), []
            n = np.fromiter(map(len, held), np.int64, len(held)) // 2
            for a, b in _runs(n):
                flat = np.frombuffer(b"".join(held[a:b]), "<u2").astype(np.int64)
                logs = log_probabilities(shared.value, *padded_tokens(flat, n[a:b]))
                sums.append(common.segment_sums(logs, n[a:b]))
            total = (np.concatenate(sums) if sums else np.zeros(0)) + spelled.to_numpy()
            mean = pa.array(total / np.maximum(n, 1), mask=n == 0)
            return [pa.array(n, pa.int64()), pa.array(total, pa.float64()), mean]

        return work

    outputs = "n_tokens long, log_prob double, mean_log_prob double"
    kept = [c for c in (coded.columns if keep is None else keep) if c not in ("lm_ids", "lm_spelled")]
    return common.append(coded, ["lm_ids", "lm_spelled"], outputs, make, kept)


def _runs(counts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about MASKED_TOKENS tokens."""
    start, size = 0, 0
    for i, n in enumerate(counts.tolist()):
        if i > start and size + n > MASKED_TOKENS:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(counts):
        yield start, len(counts)


def score(
    docs: DataFrame, model: LMModel, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Add `n_tokens`, `log_prob` (the sum) and `mean_log_prob` (null without a token)."""
    kept = [c for c in (docs.columns if keep is None else keep) if c not in SCORES]
    return score_encoded(encode(docs, model, text, kept), model, kept)


SCORES = ("n_tokens", "log_prob", "mean_log_prob")
