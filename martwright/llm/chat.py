"""Chat formatting with a grammar round trip.

A conversation is rendered turn after turn; each turn stands between the markers of its role:
    system     <<SYS>>text<</SYS>>
    user       [INST]text[/INST]
    assistant  <s>text</s>
    any other  [ROLE]name[:]text[/ROLE]
The grammar is regular: a conversation is a sequence of turns, a turn an opening marker, text
without a marker, and the closing marker of the same role. A deterministic parser reads each
rendered turn back; where what it recovers is not the source (a text holds a marker, or something
that would be unescaped), the text is escaped and rendered again, until it is identical. Escaping
puts one more backslash after the first character of every marker, however many stand there;
reading takes one away, so any text survives. The parser is between turns after each turn, hence
turns that read back alone read back in sequence, and no task needs a whole conversation.

The loss mask covers the text of assistant turns, as spans within the rendered turn.

Order: by turn, then role, then text; null turns first. Edge cases: null roles and texts count as
empty; repeated rows are turns of their own; a null conversation id is a conversation; without
rows there is no conversation. Conversations of any length stream through a digest, sorted, one
turn at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm import common

MARKERS = {
    "system": ("<<SYS>>", "<</SYS>>"),
    "user": ("[INST]", "[/INST]"),
    "assistant": ("<s>", "</s>"),
}
NAMED = ("[ROLE]", "[:]", "[/ROLE]")
_CONTROLS = [m for pair in MARKERS.values() for m in pair] + list(NAMED)
_TAILS = "|".join(re.escape(c[1:]) for c in _CONTROLS)
_ANY = re.compile("|".join(map(re.escape, _CONTROLS)))
_BARE = re.compile(rf"([<\[])(\\*)({_TAILS})")
_ESCAPED = re.compile(rf"([<\[])\\(\\*)({_TAILS})")


def escape(text: str) -> str:
    return _BARE.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """The rendered turn, and where its text starts and stops; both parts are already escaped."""
    if role in MARKERS:
        before, after = MARKERS[role]
    else:
        before, after = f"{NAMED[0]}{role}{NAMED[1]}", NAMED[2]
    return before + text + after, len(before), len(before) + len(text)


class GrammarError(ValueError):
    """The text is not a sequence of turns."""


def parse(rendered: str) -> list[tuple[str, str, int, int]]:
    """Role, text, start and stop of every turn."""
    turns, at = [], 0
    openers = {pair[0]: (role, pair[1]) for role, pair in MARKERS.items()}
    while at < len(rendered):
        found = _ANY.match(rendered, at)
        if not found or found[0] not in (*openers, NAMED[0]):
            raise GrammarError(f"no turn starts at {at}")
        start = found.end()
        if found[0] == NAMED[0]:
            middle = _ANY.search(rendered, start)
            if not middle or middle[0] != NAMED[1]:
                raise GrammarError(f"no role name at {start}")
            role, closer = unescape(rendered[start : middle.start()]), NAMED[2]
            start = middle.end()
        else:
            role, closer = openers[found[0]]
        last = _ANY.search(rendered, start)
        if not last or last[0] != closer:
            raise GrammarError(f"no {closer} after {start}")
        turns.append((role, unescape(rendered[start : last.start()]), start, last.start()))
        at = last.end()
    return turns


def format_turn(role: str, text: str) -> tuple[str, int, int, int]:
    """Rendered turn, start and stop of its text, rounds of escaping it took."""
    name, body, rounds = role, text, 0
    while True:
        rendered, start, stop = render(name, body)
        try:
            if parse(rendered) == [(role, text, start, stop)]:
                return rendered, start, stop, rounds
        except GrammarError:
            pass
        if rounds == 1:
            raise AssertionError("escaping did not make the turn readable")
        name, body, rounds = name if role in MARKERS else escape(name), escape(body), rounds + 1


def format_turns(
    rows: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Rows (conversation, turn, role, text, formatted, loss_start, loss_stop, rounds).

    The formatted texts of a conversation, in order, are the formatted conversation. The loss
    span, in characters of the turn's formatted text, is null for turns without loss.
    """

    def make():
        def work(roles, texts):
            made = [
                format_turn(r, t)
                for r, t in zip(common.texts_of(roles), common.texts_of(texts), strict=True)
            ]
            formatted, start, stop, rounds = zip(*made, strict=True) if made else ((),) * 4
            learned = [r == "assistant" for r in roles.to_pylist()]
            spans = [
                pa.array([x if on else None for x, on in zip(c, learned, strict=True)], pa.int32())
                for c in (start, stop)
            ]
            return [pa.array(formatted, pa.string()), *spans, pa.array(rounds, pa.int32())]

        return work

    return common.append(
        rows, [role, text],
        "formatted string, loss_start int, loss_stop int, rounds int", make,
        [conversation, turn, role, text],
    )


DIGESTS = (
    "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def read_back(
    formatted: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """A row per conversation, from the formatted text and the loss mask alone.

    `turns_sha256` digests role, newline, text, newline of every turn; `loss_sha256` all text
    under the mask. Role and text columns only order turns of the same number.
    """
    kind = formatted.schema[conversation].dataType.simpleString()
    ordered = formatted.repartition(conversation).sortWithinPartitions(
        conversation, F.col(turn).asc_nulls_first(), role, text
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, done = None, None, []
        for batch in batches:
            done = []
            for key, piece, start, stop in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if state is None or key != now:
                    if state is not None:
                        done.append((now, *state.result()))
                    now, state = key, _Digest()
                state.add(piece, start, stop)
            yield _digest_rows(done, batch.schema.field(0).type, conversation)
        if state is not None:
            yield _digest_rows([(now, *state.result())], batch.schema.field(0).type, conversation)

    return ordered.select(conversation, "formatted", "loss_start", "loss_stop").mapInArrow(
        digest, f"{conversation} {kind}, {DIGESTS}"
    )


class _Digest:
    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.count = self.loss_chars = self.chars = 0

    def add(self, piece: str, start: int | None, stop: int | None) -> None:
        for role, text, _, _ in parse(piece):
            self.turns.update(f"{role}\n{text}\n".encode())
            self.count += 1
        self.chars += len(piece)
        if start is not None:
            text = unescape(piece[start:stop])
            self.loss_chars += len(text)
            self.loss.update(text.encode())

    def result(self) -> tuple:
        digests = self.turns.hexdigest(), self.loss.hexdigest()
        return self.count, digests[0], self.loss_chars, digests[1], self.chars


def _digest_rows(rows: list[tuple], kind: pa.DataType, conversation: str) -> pa.RecordBatch:
    names = [conversation, *(part.split()[0] for part in DIGESTS.split(", "))]
    types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    columns = zip(*rows, strict=True) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
    )
