"""Periodic runs, the rule cascade and embedding whitening against brute force."""

from __future__ import annotations

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import cascade, queries, runs, whitening
from tests.llm.data import empty, frame, prose, rows


# --- periodic runs ------------------------------------------------------------------

def brute_runs(c, least):
    n, out = len(c), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if c[i] != c[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and c[j] == c[j + q]:
                j += 1
            size, part = j - i + q, c[i:j + q]
            if size >= max(least, 2 * q) and not any(part[p:] == part[:-p] for p in range(1, q)):
                out.append((i, size, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def repeating(r, n, k):
    c = [r.randrange(k) for _ in range(n)]
    if n and r.random() < 0.6:
        a, p = r.randrange(n), r.randint(1, 9)
        for i in range(a + p, n):
            c[i] = c[i - p]
    return c


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_are_those_of_brute_force(least):
    r = random.Random(least)
    for _ in range(400):
        c = repeating(r, r.randint(0, 70), r.randint(1, 4))
        want = brute_runs(c, least)
        assert runs.runs_of(c, least) == want
        parts = [(a + s, n, q) for a, b in runs.repeating_stretches(np.array(c), np.array([len(c)]), least)
                 for s, n, q in runs.runs_of(c[a:b], least)]
        assert sorted(parts, key=lambda x: (x[0], x[2])) == want


def test_long_repetitions_take_no_square_time():
    assert runs.runs_of([7] * 100_000) == [(0, 100_000, 1)]
    block = list(range(9_000))
    assert runs.runs_of(block * 5 + block[:100]) == [(0, 45_100, 9_000)]


def kept_words(words, found):
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def test_find_runs_on_odd_rows(spark):
    r = random.Random(3)
    words = [["ab", "cd", "é"][k % 3] for k in range(40)]
    data = [(1, words, "a"), (1, words, "a"), (2, None, "b"), (3, [], None), (None, ["x"] * 12, "c"),
            (4, ["x"] * 11, "c"), (5, ["x y"] * 6 + ["x", "y"] * 6, "c")]
    data += [(10 + k, [str(x) for x in repeating(r, r.randint(0, 200), 3)], "z") for k in range(60)]
    docs = spark.createDataFrame(data, "doc_id long, words array<string>, runs_note string").repartition(3)
    got = collections.Counter((x.doc_id, tuple((q.start, q.length, q.period) for q in x.runs), x.collapsed)
                              for x in runs.find_runs(docs, rows_at_once=4).collect())
    want = collections.Counter()
    for i, w, _ in data:
        found = brute_runs(w or [], 12)
        want[i, tuple(found), kept_words(w or [], found)] += 1
    assert got == want
    assert runs.find_runs(docs).columns == ["doc_id", "runs_note", "runs", "collapsed"]
    assert runs.find_runs(docs.limit(0)).count() == 0


def test_runs_query_is_brute_force_over_the_planted_texts(spark, tmp_root):
    r = random.Random(8)
    texts = [(k, " ".join(r.choice("abc") for _ in range(r.randint(0, 90))) + "\n  x") for k in range(120)]
    data = texts + [(500, None), (501, ""), (502, " \t "), (503, "w " * 3000), (1, texts[1][1])]
    spark.createDataFrame(data, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_root}/documents.parquet")
    got = collections.Counter(tuple(x) for x in queries.op11_periodic_runs(spark, tmp_root).collect())
    want = collections.Counter()
    for i, t in data:
        w = [b.decode() for b in (t or "").encode().split()]
        h, n = zlib.crc32(str(i).encode()), len(w)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        found = brute_runs(w, 12)
        best = min(found, key=lambda x: (-x[1], x[0], x[2])) if found else None
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in found)
        want[(i, len(found), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
              hashlib.sha256(lines.encode()).hexdigest(),
              hashlib.sha256(kept_words(w, found).encode()).hexdigest())] += 1
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in data) > 3
    assert got == want


# --- the rule cascade -----------------------------------------------------------------

def brute_repeats(text):
    w = text.encode().split()
    n = collections.Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    return len({p for k in range(len(w) - 4) if n[tuple(w[k:k + 5])] > 1 for p in range(k, k + 5)})


def test_measures_are_those_of_brute_force():
    r = random.Random(2)
    texts = ["", " \n ", "é à b # <\n\nx |\nx |\n x |", "a " * 5000, "a b c d e"]
    texts += ["\n".join(" ".join(r.choice(["a", "bé", "#c", "d"]) for _ in range(r.randint(0, 6)))
                        for _ in range(r.randint(0, 20))) for _ in range(200)]
    raw = [t.encode() for t in texts]
    assert cascade.n_repeat_words(raw).tolist() == [brute_repeats(t) for t in texts]
    assert [cascade.n_repeat_words([b])[0] for b in raw] == [brute_repeats(t) for t in texts]
    assert cascade.word_chars(raw).tolist() == [sum(len(w.decode()) for w in b.split()) for b in raw]
    assert cascade.n_words(raw).tolist() == [len(b.split()) for b in raw]
    assert cascade.n_symbols(raw).tolist() == [sum(t.count(s) for s in "#*$%&|<>") for t in texts]
    for t, n in zip(texts, cascade.n_dup_lines(raw)):
        seen, dup = set(), 0
        for line in t.split("\n"):
            if line.encode().strip():
                dup += line in seen
                seen.add(line)
        assert n == dup


def test_cascade_shows_later_rules_only_what_is_left_and_keeps_the_same_texts():
    seen = collections.defaultdict(list)

    def rule(name, word):
        def rejects(texts):
            seen[name] += texts
            return np.array([word in t for t in texts])
        return cascade.Rule(name, rejects)

    texts = [b"a", b"a b", b"b", b"c", b""]
    a, b = rule("a", b"a"), rule("b", b"b")
    assert cascade.first_rejection(texts, [a, b]) == ["a", "a", "b", None, None]
    assert seen["a"] == texts and seen["b"] == [b"b", b"c", b""]
    one, two = cascade.first_rejection(texts, [a, b]), cascade.first_rejection(texts, [b, a])
    assert [x is None for x in one] == [x is None for x in two]
    # by rejection per cost: b rejects less, but costs a tenth
    got = cascade.ordered([a, b], [cascade.Estimate("a", 1.0, 0.5), cascade.Estimate("b", 0.1, 0.2)])
    assert [r.name for r in got] == ["b", "a"]
    tied = [cascade.Estimate("a", 1.0, 0.0), cascade.Estimate("b", 1.0, 0.0)]
    assert [r.name for r in cascade.ordered([b, a], tied)] == ["a", "b"]


def test_cascade_on_odd_rows_and_its_estimates(spark):
    docs = frame(spark).withColumn("kept", F.lit("clash")).withColumn("__note", F.lit(1))
    out = cascade.cascade(docs, measures=["n_words", "n_repeat_words"])
    assert out.columns == [*[c for c in docs.columns if c != "kept"], "rejected_by", "kept", "n_words", "n_repeat_words"]
    got = collections.Counter((r.doc_id, r.text, r.kept, r.n_words) for r in out.collect())
    want = collections.Counter()
    for r in rows():
        raw = [(r[1] or "").encode()]
        want[r[0], r[1], not any(q.rejects(raw)[0] for q in cascade.RULES), len(raw[0].split())] += 1
    assert got == want and any(k[2] for k in got) and any(not k[2] for k in got)
    estimates = cascade.estimate(frame(spark))
    share = {e.name: e.rejection for e in estimates}
    assert [e.name for e in estimates] == [r.name for r in cascade.RULES] and all(e.cost >= 0 for e in estimates)
    short = sum(len((r[1] or "").encode().split()) < 10 for r in rows())
    assert share["few_words"] == pytest.approx(short / len(rows()))
    assert all(e.cost == e.rejection == 0 for e in cascade.estimate(empty(spark)))
    assert cascade.cascade(empty(spark)).count() == 0


def test_rules_reject_what_they_are_for():
    texts = {"few_words": "too short", "repeated_words": "one two three four five " * 9,
             "symbols": " | ".join(prose(1, 30).split()), "word_length": "x" * 400 + " " + prose(2, 12),
             "repeated_lines": (prose(3, 14) + "\n") + (prose(4, 4) + "\n") * 3,
             "capitals": prose(5, 30).upper(), "exclamations": prose(6, 30).replace(" ", "! ")}
    for name, text in texts.items():
        rule = next(r for r in cascade.RULES if r.name == name)
        assert rule.rejects([text.encode(), prose(7, 60).encode()]).tolist() == [True, False], name


# --- whitening ----------------------------------------------------------------------------

@pytest.mark.parametrize("size", [1, 2, 7, 48])
def test_spectrum_is_that_of_the_matrix(size):
    rng = np.random.default_rng(size)
    a = rng.normal(size=(3 * size, size)) * np.exp(2 * rng.normal(size=size))
    a = a.T @ a
    values, vectors = whitening.spectrum(a)
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1]).max() < 1e-13 * values[0]
    assert np.abs(vectors.T @ vectors - np.eye(size)).max() < 1e-13
    assert np.abs(a @ vectors - vectors * values).max() < 1e-13 * values[0]


def test_spectrum_bears_ties_and_null_spaces():
    turn = np.linalg.qr(np.random.default_rng(4).normal(size=(6, 6)))[0]
    for want in ([1.0] * 6, [0.0] * 6, [3, 3, 3, 1, 1, 0], [5, 0, 0, 0, 0, 0], [1, 1e-9, 1e-9, 1e-12, 0, 0]):
        a = turn @ np.diag(want) @ turn.T
        values, vectors = whitening.spectrum(a)
        assert np.abs(values - want).max() < 1e-14 * max(1, want[0])
        assert np.abs(vectors.T @ vectors - np.eye(6)).max() < 1e-13
    orthogonal = whitening.polar(turn @ np.diag([1, 2, 3, -1, -2, 1e-6]) @ turn.T)
    assert np.abs(orthogonal @ orthogonal - np.eye(6)).max() < 1e-12
    assert np.trace(orthogonal) == pytest.approx(2)


def brute_whitening(data, components=16):
    """(id, component) -> (n, deviation, |whitened|, explained) by eigh of the distinct vectors."""
    x = {k: np.floor(64 * np.array(v, dtype=np.float32).astype(float)).astype(np.int64) + 1_000_000
         for k, v in data if v is not None and all(c is not None and np.isfinite(c) for c in v)}
    distinct = np.unique(np.array(list(x.values())), axis=0)
    n, sums = len(distinct), distinct.sum(axis=0)
    centred = (n * distinct - sums) / n
    cov = centred.T @ centred / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1], v[:, ::-1]
    keep = min(components, int((e > 1e-11 * e[0]).sum()))
    return {(k, c + 1): (n, int(sum(int(q) ** 2 for q in n * row - sums)),
                         abs((n * row - sums) / n @ v[:, c]) / np.sqrt(e[c]), e[c] / e.sum())
            for k, row in x.items() for c in range(keep)}


@pytest.mark.parametrize("dim", [3, 24])
def test_whitening_is_that_of_eigh(spark, dim):
    rng = np.random.default_rng(dim)
    base = rng.normal(size=(300, dim)) * (1 + np.arange(dim)[::-1])
    data = [(k, [float(c) for c in row]) for k, row in enumerate(base)]
    data += [(1000 + k, data[7][1]) for k in range(200)]                       # a hot vector counts once
    bad = [(2000, None), (2001, [None] + [0.0] * (dim - 1)), (2002, [float("nan")] * dim),
           (2003, [float("inf")] + [0.0] * (dim - 1))]
    table = spark.createDataFrame([(*r, 1) for r in data + bad], "vec_id long, embedding array<float>, component int").repartition(5)
    got = whitening.whitened_components(table).collect()
    want = brute_whitening(data + bad)
    assert {(r.vec_id, r.component) for r in got} == set(want) and len(got) == len(want)
    for r in got:
        n, deviation, whitened, explained = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(r.whitened) == pytest.approx(whitened, abs=1e-8) and r.explained == pytest.approx(explained, rel=1e-9)
        assert r.identity_error < 1e-9
    again = {(r.vec_id, r.component): r.whitened for r in whitening.whitened_components(table.repartition(2)).collect()}
    assert all(abs(again[r.vec_id, r.component] - r.whitened) < 1e-8 for r in got)     # the sign too


def test_whitening_of_odd_tables(spark):
    def run(data):
        return whitening.whitened_components(spark.createDataFrame(data, "vec_id long, embedding array<float>")).collect()

    assert run([]) == [] and run([(1, None), (2, [])]) == []
    assert run([(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []                       # one distinct vector
    # a constant entry has no component; NULL and repeated ids stay; each length is a space of its own
    got = run([(None, [1.0, 5.0]), (2, [3.0, 5.0]), (2, [3.0, 5.0]), (3, [1.0]), (4, [2.0]), (5, [4.0])])
    assert sorted((str(r.vec_id), r.component, r.n) for r in got) == [
        ("2", 1, 2), ("2", 1, 2), ("3", 1, 3), ("4", 1, 3), ("5", 1, 3), ("None", 1, 2)]
    assert {round(abs(r.whitened), 9) for r in got if r.n == 2} == {1.0}
