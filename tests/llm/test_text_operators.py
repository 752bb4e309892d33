"""Toxicity, language, scoring and mixing against brute force."""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import langid, logbilinear, mixing, toxicity
from strata.llm.common import fold
from tests.llm.data import empty, frame, prose, rows


def test_fold_is_crc32_of_the_id(spark):
    got = {r.i: r.f for r in spark.range(50).select(F.col("id").alias("i"), fold("id", 5).alias("f")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 for i in range(50)}


def test_identity_swaps_carry_no_weight():
    # feature 0 stands in more toxic rows: without the penalty it gets weight
    x, y = [[0, 2], [0, 2], [0], [1], [1], [1, 2]] * 20, [1, 1, 1, 0, 0, 0] * 20
    s = toxicity.sample_of([(l, dict.fromkeys(r, 1), 1.0) for r, l in zip(x, y)], [{0: -1, 1: 1}, {1: -1, 0: 1}], 3)
    plain, _ = toxicity.fit_weights(s, 0.002, counterfactual=0.0)
    fair, _ = toxicity.fit_weights(s, 0.002, counterfactual=100.0)
    assert abs(plain[0] - plain[1]) > 1 and abs(fair[0] - fair[1]) < 0.1
    assert toxicity.counterfactuals({"old", "x"}) == [("old", "young")]


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(3)
    rows_ = [(int(rng.integers(2)), {int(j): int(rng.integers(1, 3)) for j in rng.choice(6, 3, replace=False)}, 1.0)
             for _ in range(40)]
    s = toxicity.sample_of(rows_, [{0: -1, 1: 1, 2: 2}], 6)
    x = np.zeros((40, 6))
    x[s.row, s.col] = s.times

    def loss(w, bias):
        z = x @ w + bias
        change = -w[0] + w[1] + 2 * w[2]
        return np.mean(np.logaddexp(0, np.where(s.y > 0, -z, z))) + 0.01 * w @ w + 0.5 * change ** 2

    w, bias = toxicity.fit_weights(s, 0.01, counterfactual=0.5, epochs=3000)
    best = loss(w, bias)
    assert all(loss(w + d, bias) > best - 1e-7 for d in 0.05 * np.vstack([np.eye(6), -np.eye(6)]))
    assert loss(w, bias + 0.05) > best - 1e-7 and loss(w, bias - 0.05) > best - 1e-7


def test_best_cut_is_that_of_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(50):
        y, z, weight = rng.integers(0, 2, 30), np.round(rng.normal(size=30), 1), rng.integers(1, 4, 30).astype(float)
        if not y.any():
            continue

        def f1(cut):
            hit = (weight * y)[z >= cut].sum()
            return 2 * hit / (weight[z >= cut].sum() + (weight * y).sum())

        cut = toxicity.best_cut(z, y, weight)
        assert f1(cut) == pytest.approx(max(f1(c) for c in np.append(z, 9)))


def test_toxicity_of_held_out_documents(spark):
    """Words outside the sample count through their beginnings; 0.5 parts the classes."""
    from strata.llm import queries

    sf = "/root/testdata/sf0.1"
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [(r.predicted, toxic[r.doc_id]) for r in queries.op1_toxicity(spark, sf).where("held_out").collect()
           if r.doc_id in toxic]
    hits = sum(p and t for p, t in got)
    assert hits >= 0.88 * sum(t for _, t in got) and hits >= 0.95 * sum(p for p, _ in got)


def test_toxicity_learns_and_bears_odd_rows(spark):
    data = [(i, prose(i, 30) + (" idiot scum" if i % 4 == 0 else " muslim friends"), int(i % 4 == 0))
            for i in range(120)]
    model = toxicity.fit(spark.createDataFrame(data, "doc_id long, text string, toxic int"))
    assert model.score("you idiot") > 0.5 > model.score("muslim friends of " + prose(999, 10))
    scored = frame(spark).select(toxicity.score(model, F.col("text")).alias("s")).collect()
    assert len(scored) == len(rows()) and all(0 <= r.s <= 1 for r in scored)
    labels = spark.createDataFrame(data, "doc_id long, text string, toxic int")
    kept = toxicity.reject_toxic(frame(spark, [(1, "idiot scum idiot", None, None, 1, "a", "b")] + rows()), labels)
    assert kept.count() == len(rows()) and kept.columns == frame(spark).columns
    none = toxicity.fit(spark.createDataFrame([], "doc_id long, text string, toxic int"))
    assert none.score("anything") < 0.5


def segmentations(word, pieces, prob):
    if not word:
        return 1.0
    total = 0.0
    for n in range(1, len(word) + 1):
        k = pieces.get(word[:n], len(pieces) if n == 1 else None)
        if k is not None:
            total += prob[k] * segmentations(word[n:], pieces, prob)
    return total


def test_forward_sums_all_segmentations():
    pieces = {p: i for i, p in enumerate(["▁", "a", "b", "ab", "▁a", "ba", "aba"])}
    prob = np.random.default_rng(1).dirichlet(np.ones(len(pieces) + 1), size=2)
    words = ["a", "ab", "abab", "baba", "axb", "é"]
    got = langid.forward(words, pieces, prob)
    for i, w in enumerate(words):
        for lang in range(2):
            assert got[i, lang] == pytest.approx(math.log(segmentations("▁" + w, pieces, prob[lang])))
    counts = langid.expected_counts({"abab": 2.0}, pieces, prob[0])
    assert counts.sum() >= 2.0 and langid.forward(["a" * 64], pieces, prob * 1e-6).shape == (1, 2)


def test_pieces_are_found_in_many_words_at_once():
    pieces = langid.Pieces({"▁": 0, "a": 1, "ab": 2, "▁ab": 3, "abcde": 4, "é": 5})
    words = ["abcdex", "ab", "éa", "x" * 64, "aabcde", "zz"]
    for size in {len(w) for w in words}:
        same = [w for w in words if len(w) == size]
        got = [[] for _ in same]
        for i, j, rows, found in pieces.spans(same):
            for r, k in zip(rows.tolist(), found.tolist()):
                got[r].append((i, j, k if k < len(pieces) else -1))
        assert [sorted(g) for g in got] == [sorted(langid._spans(w, pieces)) for w in same]


def test_word_scores_are_kept_as_rows_of_one_array(monkeypatch):
    monkeypatch.setattr(langid, "_CACHE", 2)
    pieces = langid._parse(langid.vocabulary(None))
    prob = np.random.default_rng(2).dirichlet(np.ones(len(pieces) + 1), size=2)
    model = langid.LanguageModel(["a", "b"], np.ones(2) / 2, prob, langid.vocabulary(None))
    texts, cache = [["the house the", "a b c d", None, "house e f", "the " + "x" * 200][i % 5] for i in range(20)], model.no_words()
    got = [model.predict([t], cache)[0] for t in texts]
    assert got == model.predict(texts)
    assert len(cache.scores) == len(cache.row) <= 8


def test_language_learns_and_bears_odd_rows(spark):
    en = [(f"the house of {prose(i, 3)} and the garden", "en") for i in range(30)]
    de = [(f"das haus von {prose(i, 3)} und der garten", "de") for i in range(30)]
    model = langid.fit(spark.createDataFrame(en + de + [(None, "en"), ("x", None)], "text string, lang string"))
    got = {t: p for t, p in zip(["the garden", "der garten", "12 !", "", None],
                                model.predict(["the garden", "der garten", "12 !", "", None]))}
    assert got["the garden"][0] == "en" and got["der garten"][0] == "de"
    assert [got[t] for t in ("12 !", "", None)] == [("und", 0.0)] * 3
    out = frame(spark).select(langid.identify(model, F.col("text")).alias("x")).select("x.*").collect()
    assert len(out) == len(rows()) and all(0 <= r.score <= 1 for r in out)
    blank = langid.fit(spark.createDataFrame([], "text string, lang string"))
    assert blank.predict(["word"]) == [("und", 0.0)]


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def test_language_model_counts_and_normalises(spark):
    docs = frame(spark)
    train = docs.where("doc_id < 10")
    got = logbilinear.score_documents(docs, train).collect()
    toks = [(r[0], re.findall(r"[^\x20\x09-\x0D]+", lower(r[1])) + ["\n"]) for r in rows()]
    counts = {}
    for i, t in toks:
        for w in t if i is not None and i < 10 else ():
            counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(i), len(t), sum(w in counts for w in t), n, round(sum(math.log10(
        (counts.get(w, 0) + 0.5) / (n + 0.5 * (v + 1))) for w in t), 6)) for i, t in toks)
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)
    assert logbilinear.score_documents(docs, empty(spark)).count() == len(rows())
    assert logbilinear.score_documents(empty(spark), docs).count() == 0


def small_model(n=30, seed=1):
    rng = np.random.default_rng(seed)
    mass = np.sort(rng.integers(1, 900, n))[::-1].astype(float)
    return mass, logbilinear.started(mass, dim=6, positions=3, seed=seed)


def test_probabilities_are_normalised_over_all_symbols():
    mass, model = small_model()
    assert model.cuts[0] == 0 and model.cuts[-1] == 30 and len(model.cuts) > 3 and (np.diff(model.cuts) > 0).all()
    context = np.random.default_rng(2).integers(0, 30, (20, 3))
    total = sum(10 ** model.log10(context, np.full(20, s)) for s in range(30))
    assert total == pytest.approx(1.0, abs=1e-5)
    flat = model.filled(np.zeros_like(model.flat()))
    for part in ("group_bias", "bias"):
        getattr(flat, part)[:] = getattr(model, part)
    unigram = 10 ** flat.log10(np.zeros((30, 3), dtype=int), np.arange(30))     # without vectors: the unigrams
    assert unigram == pytest.approx((mass + 0.5) / (mass + 0.5).sum(), rel=1e-4)
    assert np.array_equal(model.filled(model.flat()).flat(), model.flat())


def test_noise_contrastive_gradient_is_that_of_the_objective():
    rng = np.random.default_rng(4)
    scores, noise, at = rng.normal(size=(5, 7)), rng.random(7) * 3 + 0.1, rng.integers(0, 7, 5)

    def loss(s):        # minus: the observed told from noise, and the expected draws told from observed
        p = 1 / (1 + np.exp(np.log(noise) - s))
        return -np.log(p[np.arange(5), at]).sum() - (noise * np.log(1 - p)).sum()

    got = logbilinear.Trainer._apart(scores.copy(), noise, at)
    for i in range(5):
        for j in range(7):
            step = np.zeros_like(scores)
            step[i, j] = 1e-6
            assert got[i, j] == pytest.approx((loss(scores + step) - loss(scores - step)) / 2e-6, abs=1e-5)


def test_what_follows_is_learned():
    words = logbilinear.vocabulary_of([(w, 100) for w in "abc"], [], (0, 0))
    of = words.symbols([b"a", b"b", b"c", b"\n"])
    text = np.array([of[k] for k in [0, 1, 2] * 30 + [3]])
    model, n = logbilinear.learn(logbilinear.started(words.mass, dim=8, positions=2), iter(
        [(text, np.array([91]))] * 20), words, 1, least_tokens=400_000, most_passes=300)
    assert n == 1820
    at = logbilinear.contexts(text, np.array([91]), words.end, 2)
    assert at[0].tolist() == [words.end] * 2 and at[2].tolist() == [of[1], of[0]]
    assert (10 ** model.log10(at[1:], text[1:])).min() > 0.01 and (10 ** model.log10(at[5:80], text[5:80])).min() > 0.9


def test_head_floor_and_shared_symbols():
    counts = [1] * 500 + [2] * 90 + [9] * 20 + [40] * 5
    buckets = {}
    for c in counts:
        b = math.floor(math.log2(c) * 8 + 1e-9)
        buckets[b] = buckets.get(b, 0) + 1
    for most in (0, 4, 5, 24, 25, 114, 115, 614, 615, 10_000):
        floor = logbilinear.head_floor(list(buckets.items()), most)
        assert sum(c >= floor for c in counts) == max(
            n for n in (0, 5, 25, 115, 615) if n <= most)
    words = logbilinear.vocabulary_of([("the", 50), ("é", 9)], [("ng", 70, 3)], (4, 2))
    said = [b"the", "é".encode(), b"sing", b"zzz", b"\n", b"g"]
    assert words.symbols(said).tolist() == [1, 2, 0, 3, 4, 3] and words.rest == 3 and words.end == 4
    assert words.mass.tolist() == [70, 50, 9, 4, 0] and words.types.tolist() == [3, 0, 0, 2, 0]


def test_held_out_documents_are_likelier_than_by_unigrams(spark):
    from strata.llm import queries

    got = (queries.op10_lm_scoring(spark, "/root/testdata/sf0.1").where("held_out")
           .agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens"), F.avg((F.col("score") > F.col("base_score")).cast("int"))).first())
    assert (got[0] - got[1]) / got[2] > 0.4 and got[3] > 0.95       # log10 per token; share of documents


def test_targets_share_by_weight_and_stop_at_three_times():
    assert mixing.targets([("a", 100), ("b", 100), ("c", 100)]) == pytest.approx(
        {"a": 187.5, "b": 75.0, "c": 37.5})
    got = mixing.targets([("a", 10), ("b", 100), ("c", 0), (None, 390)])
    assert got["a"] == 30 and got["c"] == 0 and sum(got.values()) == pytest.approx(500)


def test_pivotal_keeps_words_and_expectation():
    rng = np.random.default_rng(3)
    size, p = rng.integers(1, 400, 300).astype(float), rng.random(300)
    order = np.argsort(-size)
    size, p = size[order], p[order]
    mean = np.zeros(300)
    for k in range(400):
        f = p.copy()
        held = mixing.pivotal(f, size, np.random.default_rng(k).random(300))
        assert all(x in (0.0, 1.0) for i, x in enumerate(f) if i != held)
        assert (f * size).sum() == pytest.approx((p * size).sum())
        mean += f / 400
    assert abs(mean - p).max() < 0.13 and abs((mean - p).mean()) < 0.01


def test_mix_meets_targets_through_the_tree(spark):
    data = [(i, prose(i, 5 + i % 40), "en", f"s{i % 2}", None, None, None) for i in range(600)]
    out = mixing.mix(frame(spark, data), leaf_rows=50, fan_in=2).collect()
    again = mixing.mix(frame(spark, data), leaf_rows=50, fan_in=2).collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, again)) and len(out) == 600
    for s in ("s0", "s1"):
        mine = [r for r in out if r.source == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 45
    assert all(r.taken == r.copies * r.size and r.copies <= 3 for r in out)


def test_mix_bears_odd_rows(spark):
    out = mixing.mix(frame(spark)).collect()
    assert len(out) == len(rows()) and all(r.taken == 0 for r in out if r.size == 0)
    assert mixing.mix(empty(spark)).count() == 0
    applied = mixing.apply_mix(frame(spark))
    assert applied.columns == frame(spark).columns + ["copies", "taken"]
    assert applied.agg(F.sum("taken")).first()[0] == sum(r.taken for r in out)
    assert mixing.apply_mix(empty(spark)).count() == 0


def test_block_sums_are_those_of_brute_force(monkeypatch):
    rng = np.random.default_rng(1)
    for block in (1, 3, 1 << 17):
        monkeypatch.setattr(toxicity, "BLOCK", block)
        for n, entries in ((5, 0), (5, 1), (7, 50), (3, 100)):
            group, of = rng.integers(0, n, entries).astype(np.int32), rng.integers(0, 9, entries).astype(np.int32)
            values = rng.normal(size=9)
            for times in (np.ones(entries, dtype=np.int8), rng.integers(-2, 3, entries).astype(float)):
                assert np.allclose(toxicity._Sums(group, of, times, n)(values),
                                   np.bincount(group, values[of] * times, n))


def test_training_step_follows_the_gradient_of_its_scores(monkeypatch):
    """Flat sums over all classes equal the gradients taken token by token."""
    rng = np.random.default_rng(3)
    mass = np.sort(rng.integers(5, 900, 40))[::-1].astype(float)
    model = logbilinear.started(mass, dim=4, positions=2)
    trainer, got = logbilinear.Trainer(model, mass), {}
    monkeypatch.setattr(trainer, "_move", lambda part, g, rows=slice(None): got.update({part: (g, rows)}))
    symbol, context = rng.integers(0, 40, 300), rng.integers(0, 40, (300, 2))
    trainer.step(context, symbol)
    want = {p: np.zeros(getattr(model, p).shape) for p in model.PARTS}
    for c, w in zip(context, symbol):
        r = sum(model.context[c[k]].astype(float) * model.place[k] for k in range(2))
        g = int(np.searchsorted(model.cuts, w, side="right")) - 1
        a, b = model.cuts[g], model.cuts[g + 1]
        back = np.zeros(4)
        for vectors, biases, noise, at, rows in (("group", "group_bias", trainer.group_noise, g, slice(None)),
                                                 ("target", "bias", trainer.noise[a:b], w - a, slice(a, b))):
            if vectors == "target" and b - a == 1:
                continue
            s = getattr(model, vectors)[rows] @ r + getattr(model, biases)[rows]
            p = 1 / (1 + noise * np.exp(-s))
            d = p * noise
            d[at] -= 1 - p[at]
            d /= len(symbol)
            want[vectors][rows] += np.outer(d, r)
            want[biases][rows] += d
            back += d @ getattr(model, vectors)[rows]
        for k in range(2):
            want["place"][k] += back * model.context[c[k]]
            want["context"][c[k]] += back * model.place[k]
    for part, full in want.items():
        g, rows = got[part]
        mine = np.zeros_like(full)
        mine[rows] = g
        assert np.allclose(mine, full, atol=1e-6), part


def test_counts_are_taken_before_rows_leave_a_task(spark):
    texts = ["The the\u00a0x  THE\tend", None, "", "\x0bÄ ä\x0c A a", "the"] * 40
    corpus = logbilinear.gather(spark.createDataFrame([(t,) for t in texts], "text string"))
    want = {}
    for t in texts:
        for w in re.findall(r"[^\x20\x09-\x0D]+", lower(t or "")) + ["\n"]:
            want[w] = want.get(w, 0) + 1
    assert {r.token: r.c for r in corpus.counts.collect()} == want
    assert (corpus.tokens, corpus.distinct) == (sum(want.values()), len(want))
