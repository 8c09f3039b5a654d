from odd_rows import no_docs, odd_docs  # noqa: F401

import numpy as np
import pytest
import xxhash

from martwright.llm import simhash
from martwright.llm.common import table
from martwright.llm.components import components

DATA = "/root/testdata/sf0.001"


def brute_fingerprint(text, width):
    words = (text or "").encode().lower().split()
    many = max(1, len(words) - width + 1) if words else 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + width]), 42) for i in range(many)]
    bits = [sum(h >> b & 1 for h in hashes) * 2 > len(hashes) for b in range(64)]
    return sum(1 << b for b, on in enumerate(bits) if on)


def brute_components(codes, most):
    parent = list(range(len(codes)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= most:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(codes))]


def test_components_of_documents(spark):
    docs = table(spark, DATA, "documents")
    rows = docs.select("doc_id", "text").collect()
    codes = [brute_fingerprint(r["text"], 3) for r in rows]
    root = brute_components(codes, 2)
    first = {c: min(r["doc_id"] for r, x in zip(rows, root, strict=True) if x == c) for c in root}
    want = {r["doc_id"]: (f, first[c]) for r, f, c in zip(rows, codes, root, strict=True)}
    got = {
        r["doc_id"]: (r["fp"] % (1 << 64), r["component_id"])
        for r in simhash.group(docs).collect()
    }
    assert got == want
    kept = [r["doc_id"] for r in simhash.deduplicate(docs).collect()]
    assert sorted(kept) == sorted(first.values())


@pytest.mark.parametrize("leaf", [4096, 30])
def test_links_of_dense_clusters(spark, leaf):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 9, dtype=np.uint64)
    one = np.uint64(1)
    flips = [one << rng.integers(0, 64, 500).astype(np.uint64) for _ in range(3)]
    codes = np.unique(base[rng.integers(0, 9, 500)] ^ flips[0] ^ flips[1] ^ flips[2])
    df = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "fp long")
    root = {r["node"]: r["root"] for r in components(simhash.links(df, 2, leaf)).collect()}
    got, want = {}, {}
    for c, b in zip(codes, brute_components([int(c) for c in codes], 2), strict=True):
        signed = int(c.view(np.int64))
        got.setdefault(root.get(signed, signed), set()).add(signed)
        want.setdefault(b, set()).add(signed)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_odd_rows(odd_docs, no_docs):
    rows = simhash.group(odd_docs).collect()
    assert len(rows) == 8
    empty = [r for r in rows if r["doc_id"] in (2, 3, 4)]
    assert {(r["fp"], r["component_id"]) for r in empty} == {(0, 2)}
    assert {r["component_id"] for r in rows if r["doc_id"] == 1} == {1}
    assert [r["component_id"] for r in rows if r["doc_id"] is None] == [None]
    kept = simhash.deduplicate(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 2, 5, 6]
    assert simhash.group(no_docs).count() == 0 and simhash.deduplicate(no_docs).count() == 0
