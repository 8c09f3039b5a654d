import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from martwright.llm import turn_trie
from martwright.llm.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"
NAMES = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
    "ends_sha256",
]
SCHEMA = "conv_id long, turn long, role string, text string, ta string, depth int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows, mod=9):
    """The contract on rebuilt lists of turns."""
    convs = {}
    for r in rows:
        if r[0] is not None:
            convs.setdefault(r[0], []).append((r[1], r[2] or "", r[3] or ""))
    for turns in convs.values():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, sha(sha(t[1]) + sha(t[2]))))
    rebuilt = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % mod
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        rebuilt[c] = [t[1:] for t in convs.get(base, [])[:h] + turns[h:]]
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, inside in members.items():
        subtree = [n for n in members if n[: len(node)] == node]
        childless = [n for n in subtree if not any(x[:-1] == n and x for x in members)]
        ends = sorted(c for c in inside if len(rebuilt[c]) == len(node))
        out.append((
            min(inside), len(node), min(members[node[:-1]]) if node else None, len(inside),
            sum(len(n) == len(node) + 1 for n in subtree), len(childless),
            sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in subtree if n),
            sha(",".join(map(str, ends))),
        ))
    return sorted(out, key=str)


def trie(df, mod=9, longest=8):
    conv = F.col("conv")
    head = F.crc32(conv.cast("string")) % mod
    nodes, rows = turn_trie.build(df, conv - conv % 5, head, longest)
    full = nodes.join(turn_trie.member_digests(rows), turn_trie.KEY, "left")
    full = full.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(sha(""))))
    return sorted(map(tuple, full.select(NAMES).collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 7) for r in rows], SCHEMA)


def test_odd_rows(spark):
    rows = [
        (0, 0, "user", "a"), (0, 1, "assistant", "b"), (0, 1, "assistant", "b"), (0, None, None, None),
        (1, 0, "user", "a"), (1, 5, "", ""), (2, None, "x", None), (3, 2, "user", "long " * 50_000),
        (4, 1, "user", "tie 1"), (4, 1, "user", "tie 2"), (4, 1, "user", "tie 1"),
        (None, 0, "user", "lost"), (-3, 0, "user", "negative"), (-5, 0, "user", "base"),
        (11, 0, "user", "no base"), (13, 0, "é", "日本"), (13, 1, "", "é日本"),
    ]
    assert trie(frame(spark, rows)) == brute(rows)


def test_no_rows(spark):
    assert trie(frame(spark, [])) == []
    assert trie(frame(spark, [(None, 1, "a", "b")])) == []


def test_random_conversations(spark):
    rng = random.Random(4)
    rows = []
    for c in range(150):
        if rng.random() < 0.9:
            for t in range(rng.randrange(1, 14)):
                rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice("ab") * rng.randrange(3)))
    rng.shuffle(rows)
    assert trie(frame(spark, rows)) == brute(rows)


@pytest.fixture
def many_slices(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_conversations_over_several_slices(spark, many_slices):
    """One conversation and one chain of shared nodes that hold most rows."""
    rows = [(c, t, "user", f"t{t % 7}") for c in (5, 6, 20) for t in range(60)]
    rows += [(c, t, "user", f"{c}") for c in range(40, 48) for t in range(3)]
    assert trie(frame(spark, rows)) == brute(rows)
    same = [(5, 1, "user", "same")] * 80 + [(6, 1, "user", "same")] * 80
    assert trie(frame(spark, same)) == brute(same)


def test_shared_products_lead_to_another_base(spark, monkeypatch):
    """With tiny primes sequences share products; references are left as they are."""
    tried = []
    first = turn_trie.Base.__init__

    def weak(self, seed):
        first(self, seed)
        tried.append(seed)
        if seed < 2:
            self.bases = [1, 1, 1, 1]  # products are sums: the order of turns is lost

    monkeypatch.setattr(turn_trie.Base, "__init__", weak)
    rows = [(c, t, "user", x) for c, s in ((10, "abcd"), (20, "bacd"), (30, "abdc")) for t, x in enumerate(s)]
    assert trie(frame(spark, rows), mod=1) == brute(rows, mod=1)
    assert tried == [0, 1, 2]


def test_references_name_their_turns(spark):
    rows = [(0, 0, "user", "a"), (0, 1, "assistant", "b"), (5, 0, "user", "a"), (5, 1, "user", None)]
    df = frame(spark, rows)
    nodes, _ = turn_trie.build(df, F.col("conv"), F.lit(0), 0)
    named = nodes.filter("depth > 0").join(turn_trie.turn_texts(df), turn_trie.REFERENCE)
    got = {(r["conv_id"], r["depth"], r["role"], r["text"]) for r in named.collect()}
    assert got == {(0, 1, "user", "a"), (0, 2, "assistant", "b"), (5, 2, "user", "")}


def test_two_turns_of_one_reference_are_refused(spark, monkeypatch):
    df = frame(spark, [(0, 0, "user", "a"), (1, 0, "user", "b")])
    monkeypatch.setattr(turn_trie, "_digest", lambda role, text: F.sha2(role, 256))
    with pytest.raises(RuntimeError, match="124 bits"):
        trie(df)


def test_query_is_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{DATA}/conversations.parquet'")
    want = con.execute(ORACLE_SQL["op12_prefix_trie"])
    names = [d[0] for d in want.description]
    want = sorted(map(tuple, want.fetchall()), key=str)
    got = QUERIES["op12_prefix_trie"](spark, DATA)
    assert sorted(got.columns) == sorted(names) == sorted(NAMES)
    assert sorted(map(tuple, got.select(names).collect()), key=str) == want
    stored = con.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    assert [tuple(map(r.__getitem__, map(names.index, NAMES))) for r in want] == sorted(
        brute(stored), key=lambda r: str(tuple(r[NAMES.index(n)] for n in names))
    )
