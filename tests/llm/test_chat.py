import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from martwright.llm import chat

PIECES = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[:]", "\\", "<", "[", "a"]
hostile = st.lists(st.sampled_from([*PIECES, "<\\s>", "[\\\\INST]", "\n"]), max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "[:]"]), hostile)))
def test_any_conversation_reads_back(turns):
    formatted = [chat.format_turn(*t) for t in turns]
    parsed = chat.parse("".join(f[0] for f in formatted))
    assert [(r, t) for r, t, _, _ in parsed] == turns
    for (_, text), (piece, start, stop, _) in zip(turns, formatted, strict=True):
        assert chat.unescape(piece[start:stop]) == text


def test_only_conflicts_are_escaped():
    assert chat.format_turn("user", "a <b> [c]")[0] == "[INST]a <b> [c][/INST]"
    piece, _, _, rounds = chat.format_turn("assistant", "</s>[INST] ok [/INST]")
    assert rounds == 1 and piece == "<s><\\/s>[\\INST] ok [\\/INST]</s>"
    for broken in ("text", "[INST]open", "[INST]a</s>", "<s>a[INST]</s>", "</s>"):
        with pytest.raises(chat.GrammarError):
            chat.parse(broken)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_digests(spark):
    rows = [
        (1, 0, "user", "hi", "x"), (1, 1, "assistant", "<s>", None), (1, 1, "assistant", "<s>", None),
        (2, 3, "assistant", "late", None), (2, None, "system", None, None), (2, 1, None, "who", None),
        (None, 0, "user", "lost", None), (3, 0, "tool", "", None), (4, 0, "assistant", "z" * 300_000, None),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    out = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(df)).collect()}
    assert set(out) == {1, 2, 3, 4, None}
    want = {
        1: (3, "user\nhi\nassistant\n<s>\nassistant\n<s>\n", "<s><s>"),
        2: (3, "system\n\n\nwho\nassistant\nlate\n", "late"),
        3: (1, "tool\n\n", ""), None: (1, "user\nlost\n", ""), 4: (1, f"assistant\n{'z' * 300_000}\n", "z" * 300_000),
    }
    for key, (n, turns, loss) in want.items():
        r = out[key]
        assert (r["n_turns"], r["turns_sha256"]) == (n, sha(turns))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), sha(loss))
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0
