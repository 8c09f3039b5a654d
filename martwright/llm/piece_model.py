"""A SentencePiece model as a lattice with max-plus weights.

A text is a path of pieces. Following piece `t` after piece `u` weighs the score of `t` in a
unigram model; in a merge (BPE) model it weighs 0 if the merges leave `u` and `t` apart when they
are applied to `ut`, and minus infinity otherwise. A path of finite weight is then exactly the
result of the merges: the first merge across a border would also happen inside that one pair. So
both kinds of model are the best path under max-plus, and can be cut anywhere.

The state at a cut is the piece that covers the character before it, with the number of its
characters beyond the cut. A chunk's transfer matrix holds the best weight from each state at its
start to each state at its end; matrices multiply associatively under (max, +).

Where no piece joins the characters on both sides of a place (before a space mark that follows
another character, between any two characters that no piece joins) every path has a border. Text
between such places, a unit, is encoded once and remembered.
"""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import chain

import numpy as np

from martwright.llm.merges import Merger

SPACE = "▁"
NEVER = float("-inf")
START = ("", 0)  # the state before the first character, and at a place where all paths break
LONGEST_MERGED = 256  # characters of a unit merged in arrays; longer ones go through the lattice
Matrix = tuple[list, list, list]  # states in, states out, weights[in][out]


class PieceModel:
    """Pieces and scores of a model file. Only the identity normaliser is supported."""

    def __init__(self, content: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(content)
        rules, self.merges = proto.normalizer_spec, proto.trainer_spec.model_type == 2
        if proto.trainer_spec.model_type not in (1, 2):
            raise ValueError("only unigram and BPE models have a lattice of pieces")
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces:
            raise ValueError("only the identity normaliser is supported")
        if proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only space marks before words are supported")
        self.prefix = " " if rules.add_dummy_prefix else ""
        self.ids, self.scores, self.bytes, self.unknown = {}, {}, {}, 0
        self.table: list[bytes] = []
        for number, piece in enumerate(proto.pieces):
            raw = piece.piece.replace(SPACE, " ").encode()
            if piece.type in (1, 4):  # normal, user-defined
                self.ids[piece.piece], self.scores[piece.piece] = number, piece.score
            elif piece.type == 6:
                raw = bytes([int(piece.piece[3:5], 16)])
                self.bytes[raw[0]] = number
            elif piece.type == 2:
                self.unknown, raw = number, " ⁇ ".encode()
            else:
                raw = b""
            self.table.append(raw)
        self.longest = max(map(len, self.ids), default=1)
        self.worst = min(self.scores.values(), default=0.0) - 10
        #: Neighbouring characters that some piece joins; between any others all paths break.
        self.joined = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.merger = Merger(self.scores, self.ids, self.joined)
        self.lines_break = not any("\n" in pair for pair in self.joined)
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("pieces over several words are not supported")


class Encoder:
    """Encodes texts and chunks of texts; remembers up to `most` units and pairs."""

    def __init__(self, model: PieceModel, most: int = 300_000):
        self.model, self.most = model, most
        self.pairs: dict[tuple[str, str], float] = {}
        self.forget()

    def forget(self) -> None:
        """Drop what is remembered of units. Their ids lie in one array, `starts` apart."""
        self.marked, self.plain = _Units(self, SPACE), _Units(self, "")
        self.pending: list[str] = []
        self.flat, self.starts = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
        self.count = 0

    # -- weights ---------------------------------------------------------------------------

    def merged(self, text: str) -> list[str]:
        """Pieces by the model's merges: best score first, then leftmost."""
        parts, score_of = list(text), self.model.scores.get
        scores = [score_of(a + b, NEVER) for a, b in zip(parts, parts[1:], strict=False)]
        while scores and (best := max(scores)) != NEVER:
            at = scores.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at < len(scores):
                scores[at] = score_of(parts[at] + parts[at + 1], NEVER)
            if at:
                scores[at - 1] = score_of(parts[at - 1] + parts[at], NEVER)
        return parts

    def weight(self, u: str, t: str) -> float:
        if not self.model.merges:
            return self.model.scores.get(t, self.model.worst)
        if not u:
            return 0.0 if len(t) == 1 or self.merged_self(t) else NEVER
        found = self.pairs.get((u, t))
        if found is None:
            found = 0.0 if self.merged(u + t) == [u, t] else NEVER
            if len(self.pairs) >= self.most:
                self.pairs.clear()
            self.pairs[u, t] = found
        return found

    def merged_self(self, t: str) -> bool:
        found = self.pairs.get(("", t))
        if found is None:
            found = self.pairs["", t] = float(self.merged(t) == [t])
        return bool(found)

    def starting(self, text: str, at: int):
        """Pieces that start at a place; any single character is one."""
        yield text[at]
        for end in range(at + 2, min(len(text), at + self.model.longest) + 1):
            if text[at:end] in self.model.ids:
                yield text[at:end]

    # -- the lattice -----------------------------------------------------------------------

    def spread(self, text: str, first: int, stop: int, start: dict, last: int):
        """Best weights per place and last piece, from the states `start` (place -> piece ->
        weights) through all pieces that start in [first, stop) and end at `last` at most."""
        best: dict[int, dict[str, list[float]]] = defaultdict(dict)
        for place, states in start.items():
            best[place].update({u: list(w) for u, w in states.items()})
        back: dict[tuple[int, str], str] = {}
        for at in range(first, stop):
            states = best.get(at)
            if not states:
                continue
            for t in self.starting(text, at):
                end = at + len(t)
                if end > last:
                    continue
                for u, weights in states.items():
                    step = self.weight(u, t)
                    if step == NEVER:
                        continue
                    into = best[end].get(t)
                    if into is None:
                        best[end][t] = [w + step for w in weights]
                        back[end, t] = u
                    else:
                        for i, w in enumerate(weights):
                            if w + step > into[i]:
                                into[i] = w + step
                                back[end, t] = u
        return best, back

    def path(self, text: str, first: int, stop: int, came: tuple[str, int], goes: tuple[str, int]):
        """Pieces that start in [first, stop), between a state at `first` and one at `stop`."""
        begin = first + came[1]
        best, back = self.spread(
            text, begin, stop, {begin: {came[0]: [0.0]}}, stop + goes[1]
        )
        at = stop + goes[1]
        piece = goes[0] or max(best[at], key=lambda t: best[at][t][0])
        pieces = []
        while at > begin:
            pieces.append(piece)
            at, piece = at - len(piece), back[at, piece]
        return pieces[::-1]

    def resolve(self) -> None:
        """Encode the units met since the last time."""
        texts, self.pending = self.pending, []
        if not texts:
            return
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        points = points.astype(np.int64)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        merger = self.model.merger
        cut = merger.breaks(points)
        cut[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
        starts = np.flatnonzero(cut)
        parts = np.diff(starts, append=len(points))
        unit = np.repeat(np.arange(len(texts)), sizes)[starts]
        short = (parts <= LONGEST_MERGED) & self.model.merges
        chosen = np.flatnonzero(short)
        owner, symbols = merger.apply(points, starts[chosen], parts[chosen])
        part = chosen[owner]
        length, ids = self.ids_of_symbols(symbols)
        part = np.repeat(part, length)
        for i in np.flatnonzero(~short):
            text = "".join(map(chr, points[starts[i] : starts[i] + parts[i]]))
            own = list(chain.from_iterable(
                map(self.ids_of, self.path(text, 0, len(text), START, START))
            ))
            part, ids = np.append(part, np.full(len(own), i)), np.append(ids, own)
        order = np.argsort(part, kind="stable")
        per_unit = np.bincount(unit[part], minlength=len(texts))
        self.flat.append(ids[order].astype(np.int32))
        self.starts.append(self.starts[-1][-1] + np.cumsum(per_unit))

    def ids_of_symbols(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids per symbol, and the ids: bytes for characters without a piece."""
        base = self.model.merger.base
        length = np.ones(len(symbols), np.int64)
        strange = np.flatnonzero(symbols >= base)
        spelled = {s: self.ids_of(chr(s - base)) for s in np.unique(symbols[strange]).tolist()}
        length[strange] = [len(spelled[s]) for s in symbols[strange].tolist()]
        ids = np.repeat(symbols, length)
        first = (np.cumsum(length) - length)[strange]
        for at, s in zip(first.tolist(), symbols[strange].tolist(), strict=True):
            ids[at : at + len(spelled[s])] = spelled[s]
        return length, ids

    def ids_of(self, piece: str) -> tuple[int, ...]:
        model = self.model
        if piece in model.ids:
            return (model.ids[piece],)
        if model.bytes:
            return tuple(model.bytes[b] for b in piece.encode("utf-8", "surrogatepass"))
        return (model.unknown,)

    # -- whole texts -----------------------------------------------------------------------

    def units(self, text: str, marked: bool) -> list[int]:
        """Numbers of the units of a text; `marked`: the first word follows a space."""
        out = []
        for i, line in enumerate(text.split("\n") if self.model.lines_break else [text]):
            if i:
                out.append(self.plain["\n"])
            words = line.split(" ")
            if len(words) > 1 and (line[0] == " " or line[-1] == " " or "  " in line):
                whole = (" " if marked and not i else "") + line
                found = _UNIT.findall(whole.replace(" ", SPACE))
                out += map(self.plain.__getitem__, found)
                continue
            out.append((self.marked if marked and not i else self.plain)[words[0]])
            out += map(self.marked.__getitem__, words[1:])
        return out

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each text, and all ids."""
        if self.count > self.most:
            self.forget()
        marked = bool(self.model.prefix)
        found = [self.units(t, marked) if t else [] for t in texts]
        per_text = np.fromiter(map(len, found), np.int64, len(found))
        numbers = np.fromiter(chain.from_iterable(found), np.int64, per_text.sum())
        return self._gather(numbers, per_text)

    def _gather(self, numbers: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        self.resolve()
        if len(self.flat) > 1:
            self.starts, self.flat = [np.concatenate(self.starts)], [np.concatenate(self.flat)]
        starts, flat = self.starts[0], self.flat[0]
        size = np.diff(starts)[numbers]
        ends = np.cumsum(size)
        shift = np.repeat(starts[numbers] - (ends - size), size)
        ids = flat[shift + np.arange(len(shift))]
        upto = np.append(0, ends)[np.cumsum(per_text)]
        return np.diff(upto, prepend=0), ids

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text."""
        return self.encode_all([text])[1].tolist()

    def decode(self, ids) -> str:
        raw = b"".join(map(self.model.table.__getitem__, ids)).decode("utf-8", "replace")
        return raw.removeprefix(self.model.prefix) if self.model.prefix else raw

    # -- chunks ----------------------------------------------------------------------------

    def states(self, text: str, at: int) -> list[tuple[str, int]]:
        """States possible at a cut: pieces over the character before it."""
        if at == 0:
            return [START]
        return [
            (t, begin + len(t) - at)
            for begin in range(max(0, at - self.model.longest), at)
            for t in self.starting(text, begin)
            if begin + len(t) >= at
        ]

    def breaks(self, text: str, first: int, stop: int) -> tuple[int, int] | None:
        """First and last place of a chunk where all paths break, apart from its ends."""
        places = [m.start() for m in (_BREAK.search(text, first, stop),) if m]
        if not places:
            return None
        last = places[0]
        for at in range(stop - 1, places[0], -1):
            if text[at] == SPACE and text[at - 1] != SPACE:
                last = at
                break
        return places[0], last

    def matrix(self, text: str, first: int, stop: int) -> Matrix:
        """Transfer matrix of the chunk [first, stop) of escaped text with context around it."""
        ins = self.states(text, first)
        final = stop == len(text)
        start: dict[int, dict[str, list[float]]] = defaultdict(dict)
        for i, (piece, beyond) in enumerate(ins):
            row = start[first + beyond].setdefault(piece, [NEVER] * len(ins))
            row[i] = 0.0
        found = self.breaks(text, first, stop)
        if not found:
            best, _ = self.spread(text, first, stop, start, len(text))
            return ins, *self._exits(best, stop, len(ins), final)
        head, tail = found
        best, _ = self.spread(text, first, head, start, head)
        into = [max((w[i] for w in best[head].values()), default=NEVER) for i in range(len(ins))]
        middle = self.middle_weight(text[head:tail])
        best, _ = self.spread(text, tail, stop, {tail: {"": [0.0]}}, len(text))
        outs, out = self._exits(best, stop, 1, final)
        return ins, outs, [[a + middle + b for b in out[0]] for a in into]

    def _exits(self, best, stop: int, size: int, final: bool):
        if final:
            ends = list(best[stop].values())
            return [START], [[max((w[i] for w in ends), default=NEVER)] for i in range(size)]
        found = [
            ((t, end - stop), w) for end, states in best.items() if end >= stop
            for t, w in states.items()
        ]
        return [s for s, _ in found], [[w[i] for _, w in found] for i in range(size)]

    def middle_weight(self, text: str) -> float:
        if self.model.merges or not text:
            return 0.0
        pieces = (self.path(u, 0, len(u), START, START) for u in _UNIT.findall(text))
        return sum(self.model.scores.get(p, self.model.worst) for u in pieces for p in u)

    def chunk_ids(self, text: str, first: int, stop: int, came, goes) -> list[int]:
        """Ids of the pieces that start in the chunk, given the states at its ends."""
        found = self.breaks(text, first, stop)
        if not found:
            pieces = self.path(text, first, stop, came, goes)
            return list(chain.from_iterable(map(self.ids_of, pieces)))
        head, tail = found
        ids = list(chain.from_iterable(
            map(self.ids_of, self.path(text, first, head, came, START))
        ))
        plain = text[head + 1 : tail].replace(SPACE, " ")
        if tail > head:
            numbers = np.array(self.units(plain, True), np.int64)
            ids += self._gather(numbers, np.array([len(numbers)]))[1].tolist()
        ids += chain.from_iterable(map(self.ids_of, self.path(text, tail, stop, START, goes)))
        return ids


_UNIT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_BREAK = re.compile(f"(?<=[^{SPACE}]){SPACE}")


class _Units(dict):
    """Numbers of units by their text without the mark."""

    def __init__(self, encoder: Encoder, mark: str):
        super().__init__()
        self.encoder, self.mark = encoder, mark

    def __missing__(self, word: str) -> int:
        own = self.encoder
        own.pending.append(self.mark + word.replace(" ", SPACE))
        self[word] = number = own.count
        own.count += 1
        return number


def compose(a: Matrix, b: Matrix) -> Matrix:
    """The max-plus product of the matrices of neighbouring chunks."""
    place = {s: i for i, s in enumerate(map(tuple, a[1]))}
    shared = [(place[s], j) for j, s in enumerate(map(tuple, b[0])) if s in place]
    weights = [
        [
            max((row[i] + b[2][j][k] for i, j in shared), default=NEVER)
            for k in range(len(b[1]))
        ]
        for row in a[2]
    ]
    return a[0], b[1], weights


def between(parts: list[Matrix], came, goes) -> list[tuple]:
    """States at all borders of consecutive chunks on the best path from `came` to `goes`."""
    first = parts[0]
    row = first[2][list(map(tuple, first[0])).index(tuple(came))]
    best, backs = dict(zip(map(tuple, first[1]), row, strict=True)), []
    for part in parts[1:]:
        ins = list(map(tuple, part[0]))
        now, back = {}, {}
        for k, out in enumerate(map(tuple, part[1])):
            ways = [(best.get(s, NEVER) + part[2][j][k], s) for j, s in enumerate(ins)]
            now[out], back[out] = max(ways, key=lambda w: w[0])
        best = now
        backs.append(back)
    states = [tuple(goes)]
    for back in reversed(backs):
        states.append(back[states[-1]])
    return [tuple(came), *states[::-1]]
