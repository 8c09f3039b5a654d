from odd_rows import no_docs, odd_docs  # noqa: F401

import numpy as np

from martwright.llm import lm_scoring as lm
from martwright.llm.common import table

DATA = "/root/testdata/sf0.001"
SMALL = lm.LMParams(classes=4, per_class=4, width=3, hidden=5, batch=8)


def test_probabilities_add_up_to_one():
    weights = {n: w + 0.1 for n, w in lm.initial(SMALL).items()}
    padded = np.array([0, 0, 3, 7, 2, 0, 0])
    total = 0.0
    for token in range(SMALL.size):
        padded[3] = token
        total += np.exp(lm.log_probabilities(weights, padded, np.array([3]))[0])
    assert abs(total - 1) < 1e-5


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(0)
    weights = {n: (w + rng.normal(0, 0.1, w.shape)).astype(np.float32) for n, w in lm.initial(SMALL).items()}
    padded = np.concatenate([[0, 0], rng.integers(1, SMALL.size, 9), [0, 0]])
    places = np.arange(2, 11)
    trainer = lm.Trainer(weights, SMALL)
    grads = {}
    trainer._move = lambda name, grad, rows=slice(None): grads.setdefault(name, []).append((rows, grad))
    trainer.step(padded, places)
    for name in weights:
        full = np.zeros(weights[name].shape)
        for rows, grad in grads[name]:
            full[rows] += grad
        at = tuple(rng.integers(0, s) for s in full.shape)
        at = np.unravel_index(np.abs(full).argmax(), full.shape) if name == "embed" else at
        losses = []
        for step in (1e-2, -1e-2):
            moved = {n: w.copy() for n, w in weights.items()}
            moved[name][at] += step
            losses.append(-lm.log_probabilities(moved, padded, places).mean())
        assert abs((losses[0] - losses[1]) / 2e-2 - full[at]) < 2e-3, name


def test_learns_from_both_sides(spark):
    docs = table(spark, DATA, "documents")
    params = lm.LMParams(classes=16, per_class=16, mask_every=4)
    model = lm.train(docs, params)
    rows = lm.score(docs, model, keep=["doc_id", "text"]).collect()
    tokens = sum(r["n_tokens"] for r in rows)
    assert tokens == sum(len(r["text"].split()) for r in rows)
    padded, places, _ = lm.tokenise([r["text"] for r in rows], lm.Tokens(model.words))
    share = np.bincount(padded[places]) / tokens
    entropy = -(share[share > 0] * np.log(share[share > 0])).sum()
    assert -sum(r["log_prob"] for r in rows) / tokens < entropy
    flat = lm.log_probabilities(model.weights, padded, places)
    assert abs(flat.sum() - sum(r["log_prob"] for r in rows)) < 1e-3 * tokens


def test_odd_rows(odd_docs, no_docs):
    model = lm.train(odd_docs, SMALL)
    assert len(model.words) == SMALL.size - 2
    out = {r["doc_id"]: r for r in lm.score(odd_docs, model).collect()}
    for key in (2, 3, 4):
        assert (out[key]["n_tokens"], out[key]["log_prob"], out[key]["mean_log_prob"]) == (0, 0.0, None)
    assert out[5]["n_tokens"] == 40_000 and np.isfinite(out[5]["log_prob"])
    assert lm.score(no_docs, lm.train(no_docs, SMALL)).count() == 0


def test_spelling_adds_up_to_one_and_knows_its_words():
    counts = {"ab": 5, "abc": 3, "b": 2}
    grams = {}
    for word, n in counts.items():
        own = lm.START * 2 + word + lm.STOP
        for i in range(len(own) - 2):
            grams[own[i : i + 3]] = grams.get(own[i : i + 3], 0) + n
    spelling = lm.Spelling(grams.items())
    for context in ("\n\n", "\na", "ab", "zz"):
        seen = sum(np.exp(spelling.step(context + c)) for c in ("a", "b", "c", " "))
        rest = np.exp(spelling.step(context + "q")) * (lm.CHARACTERS - 4)
        assert abs(seen + rest - 1) < 1e-9
    assert spelling["ab"] > spelling["abc"] > spelling["ba"] > spelling["qq"]


def test_garbled_words_cost_more_than_rare_ones(spark):
    """Both texts are unknown tokens throughout; only their letters tell them apart."""
    rows = [(n, " ".join(r["text"].split())) for n, r in enumerate(table(spark, DATA, "documents").collect())]
    counts = {}
    for _, text in rows:
        for w in text.lower().split():
            counts[w] = counts.get(w, 0) + 1
    rare = sorted(w for w, n in counts.items() if n == 2 and w.isalpha())[::20][:40]
    rng = np.random.default_rng(3)
    garbled = ["".join(rng.choice(list("qxzjkwvy"), len(w))) for w in rare]
    rows += [(-1, " ".join(rare)), (-2, " ".join(garbled))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = lm.train(docs.filter("doc_id >= 0"))
    assert model.params.spelled and not {*rare, *garbled} & {*model.words}
    out = {r["doc_id"]: r for r in lm.score(docs, model, keep=["doc_id"]).collect() if r["doc_id"] < 0}
    assert out[-1]["n_tokens"] == out[-2]["n_tokens"] == len(rare)
    assert out[-1]["mean_log_prob"] > out[-2]["mean_log_prob"] + 5


def test_every_token_is_a_target(spark):
    """With the production params, also where each task has one text of fewer words than the stride."""
    for rounds in (1, 2, 3, 40):
        params = lm.LMParams(rounds=rounds)
        phases = {p for turn in range(rounds) for p in params.phases(turn)}
        assert phases == set(range(params.mask_every))
    docs = spark.createDataFrame([(n, "only five short words here") for n in range(6)], "doc_id long, text string")
    model = lm.train(docs.repartition(6, "doc_id"))
    assert not np.array_equal(model.weights["outer_bias"], lm.initial(model.params)["outer_bias"])
    scored = lm.score(docs, model).collect()
    # The last place is reached by the fifth phase only.
    padded, places, _ = lm.tokenise(["only five short words here"], lm.Tokens(model.words))
    start = lm.log_probabilities(lm.initial(model.params), padded, places)
    assert (lm.log_probabilities(model.weights, padded, places) > start).all() and len(scored) == 6


def test_production_params_learn_more_than_a_sixteenth_teaches(spark):
    docs = table(spark, DATA, "documents")
    model = lm.train(docs)
    texts = [r["text"] or "" for r in docs.collect()]
    padded, places, _ = lm.tokenise(texts, lm.Tokens(model.words))
    few = lm.Trainer(lm.initial(model.params), model.params)
    for phase in (0, 16):
        masked = places[phase :: model.params.mask_every]
        for s in range(0, len(masked), model.params.batch):
            few.step(padded, masked[s : s + model.params.batch])
    share = np.bincount(padded[places]) / len(places)
    entropy = -(share[share > 0] * np.log(share[share > 0])).sum()
    whole = lm.log_probabilities(model.weights, padded, places).mean()
    assert whole > lm.log_probabilities(few.w, padded, places).mean() and -whole < entropy


def test_scores_do_not_depend_on_the_partitions(spark, monkeypatch):
    """Several shards, dealt over 1 and 7 partitions in other orders."""
    monkeypatch.setattr(lm, "SHARD_TOKENS", 12_000)
    docs = table(spark, DATA, "documents").select("doc_id", "text")
    copies = docs.unionByName(docs.limit(5)).unionByName(docs.limit(3).selectExpr("doc_id", "'other' AS text"))
    found = []
    for dealt in (copies.coalesce(1), copies.repartition(7), copies.orderBy("text").repartition(3, "text")):
        model = lm.train(dealt)
        rows = lm.score(dealt, model).select("doc_id", "text", "log_prob").collect()
        found.append(sorted((r["doc_id"], r["text"], r["log_prob"]) for r in rows))
    for other in found[1:]:
        assert [r[:2] for r in other] == [r[:2] for r in found[0]]
        for a, b in zip(found[0], other, strict=True):
            assert abs(a[2] - b[2]) <= 1e-3 * abs(a[2])


def test_log_prob_is_that_of_a_full_softmax(spark):
    """Every document against plain sums over the whole vocabulary, and letter by letter."""
    docs = table(spark, DATA, "documents").filter("length(text) < 1500")
    model = lm.train(docs, lm.LMParams(classes=6, per_class=7, spelled=True))
    w = {n: x.astype(float) for n, x in model.weights.items()}
    ids = {word: i + 2 for i, word in enumerate(model.words)}
    grams = dict(model.trigrams)

    def letter(three, k=0):
        """Probability of the last character after the others, smoothed by shorter contexts."""
        if k == 3:
            return 1 / lm.CHARACTERS
        after = {}
        for gram, n in grams.items():
            if gram[k:2] == three[k:2]:
                after[gram[2]] = after.get(gram[2], 0) + n
        shorter = letter(three, k + 1)
        if not after:
            return shorter
        total = sum(after.values())
        return (after.get(three[2], 0) + len(after) * shorter) / (total + len(after))

    known, letters = {}, {}
    for r in sorted(lm.score(docs, model).collect(), key=lambda r: len(r["text"]))[:25]:
        words = r["text"].lower().split()
        tokens = [0, 0, *(ids.get(x, 1) for x in words), 0, 0]
        total = 0.0
        for i, word in enumerate(words, 2):
            sides = tuple(tokens[i + o] for o in lm.PLACES)
            if sides not in known:
                h = np.tanh(np.concatenate([w["embed"][t] for t in sides]) @ w["mix"] + w["bias"])
                outer = np.exp(h @ w["outer"] + w["outer_bias"])
                inner = np.exp(np.einsum("h,chm->cm", h, w["inner"]) + w["inner_bias"])
                full = (outer / outer.sum())[:, None] * inner / inner.sum(axis=1, keepdims=True)
                known[sides] = full.ravel()
                assert abs(full.sum() - 1) < 1e-9
            total += np.log(known[sides][tokens[i]])
            if tokens[i] == 1:
                own = "\n\n" + word + " "
                for j in range(len(own) - 2):
                    three = own[j : j + 3]
                    if three not in letters:
                        letters[three] = np.log(letter(three))
                    total += letters[three]
        assert abs(total - r["log_prob"]) < 1e-4 * max(1, abs(total))


def test_softmax_of_near_and_far_numbers():
    rng = np.random.default_rng(4)
    for scale in (1, 30, 1e4):
        for shape in ((7, 48), (1, 1), (5, 3)):
            z = (rng.normal(0, 1, shape) * scale).astype(np.float32)
            z[0] -= 2 * scale  # a row far below the others
            x = z.astype(float)
            logs = x - x.max(axis=1, keepdims=True)
            logs -= np.log(np.exp(logs).sum(axis=1, keepdims=True))
            assert np.allclose(lm._softmax(z.copy()), np.exp(logs), atol=1e-5)
            chosen = rng.integers(0, shape[1], shape[0])
            got = lm._log_chosen(np.ascontiguousarray(z.T), chosen)
            assert np.allclose(got, logs[np.arange(len(z)), chosen], rtol=1e-5, atol=1e-4)


def test_words_outside_are_numbered_once(monkeypatch):
    """Repeated words are not spelled again while they are kept, and what is kept is bounded."""
    texts = ["a B zz yy zz", "", "zz a xx", "yy yy ww vv", "zz"]
    spelling = lm.Spelling([("\n\nz", 3), ("\nzz", 2), ("zz ", 2), ("\n\ny", 1)])
    known = {w: i + 2 for i, w in enumerate(["a", "b"])}
    letters = {w: spelling[w] for w in ("zz", "yy", "xx", "ww", "vv")}
    asked, costs = [], spelling.costs
    monkeypatch.setattr(spelling, "costs", lambda words: asked.extend(words) or costs(words))
    for limit in (0, 1, 200_000):
        monkeypatch.setattr(lm, "COUNTED", limit)
        numbered = lm.Numbered(["a", "b"], spelling)
        asked.clear()
        for part in (texts[:3], texts[3:4], texts[4:], []):
            flat, counts, sums = numbered.cut(part)
            words = [t.lower().split() for t in part]
            assert flat.tolist() == [known.get(w, lm.UNKNOWN) for ws in words for w in ws]
            assert counts.tolist() == [len(ws) for ws in words]
            assert np.allclose(sums, [sum(letters.get(w, 0) for w in ws) for ws in words])
            assert len(numbered) <= 2 + limit + 4
        if limit > 9:
            assert sorted(asked) == sorted(letters)
