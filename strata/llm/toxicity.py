"""Toxicity: a counterfactual-regularised classifier.

A logistic regression on the distinct words of a text; a word weighs what its own
feature and those of its beginnings (4, 5 and 6 letters) weigh, so that inflected
and compound words share evidence.  Features are those whose use differs by class,
counted by Spark over all labelled rows; weights are fitted in numpy on a bounded
sample of rows per label.  Beside the class-balanced log loss and an L2
term the fit penalises the squared change of the logit when an identity term of a
labelled text is swapped for another of its group, so that naming a group carries
no weight by itself and neutral mentions are not flagged.  The strength of the L2
term and the intercept are set on a fold of the sample that the weights have not
seen, at the true rate of the labels.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace
from functools import lru_cache
from math import fsum

import numpy as np
import pandas as pd
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored, whole_text

# Terms that name groups of people; those of a line can stand for
# each other in a sentence.
IDENTITY_GROUPS = (
    ("women", "men", "girls", "boys", "nonbinary"),
    ("woman", "man", "girl", "boy"),
    ("female", "male", "transgender"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "indigenous"),
    ("gay", "straight", "lesbian", "bisexual"),
    ("african", "european", "american", "chinese", "mexican", "indian", "arab"),
    ("immigrants", "refugees", "citizens", "natives"),
    ("old", "young"),
    ("deaf", "blind", "disabled", "autistic"),
)

LETTERS = r"[\p{L}\p{M}]+"      # a word, for the fit and for scoring
WORD = regex.compile(LETTERS)
BEGINNINGS = (4, 5, 6)
FIT_ROWS = 20_000       # documented bound of the labelled sample: half of it per label
MIN_Z = 3.0             # a feature's class difference in standard errors
L2_GRID = (2e-3, 2e-4, 2e-5, 2e-6)
KEPT_WORDS = 1 << 16    # words whose weight a scoring task remembers


def words(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def features(word: str) -> list[str]:
    """The word's own feature and one per beginning shorter than the word."""
    return [word, *[f"^{word[:k]}" for k in BEGINNINGS if len(word) > k]]


def identity_terms() -> list[str]:
    return sorted({t for g in IDENTITY_GROUPS for t in g})


def counterfactuals(held: set[str]) -> list[tuple[str, str]]:
    """(term, substitute) for every identity term held and every other of its group."""
    return [(a, b) for g in IDENTITY_GROUPS for a in g if a in held for b in g if b != a]


@dataclass
class ToxicityModel:
    """Weights by feature; ``bias`` is the logit of a text without any known word."""

    bias: float
    weights: dict[str, float] = field(default_factory=dict)

    def of_word(self, word: str) -> float:
        """What a word weighs: its own feature and those of its beginnings."""
        return fsum(self.weights.get(f, 0.0) for f in features(word))

    def logit(self, held: set[str]) -> float:
        return self.bias + fsum(map(self.of_word, held))

    def score(self, text: str | None) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.logit(words(text)), -30, 30))))


@dataclass
class Sample:
    """Rows of a fit as (row, feature, times) triples with labels and weights, and
    the logit changes of all identity swaps as (swap, feature, times) triples."""

    row: np.ndarray
    col: np.ndarray
    times: np.ndarray
    y: np.ndarray
    weight: np.ndarray
    swap: tuple[np.ndarray, np.ndarray, np.ndarray]
    n_swaps: int
    n_features: int
    swap_row: np.ndarray | None = None      # the row that each swap is made in

    def part(self, keep: np.ndarray) -> Sample:
        """The rows that ``keep`` marks, weighed so that both labels count alike."""
        at, col, times = self.swap
        row, swaps = (np.cumsum(keep) - 1).astype(np.int32), keep[self.swap_row]
        mine, moved, y = keep[self.row], swaps[at], self.y[keep]
        return Sample(row[self.row[mine]], self.col[mine], self.times[mine], y, _balanced(y),
                      ((np.cumsum(swaps) - 1)[at[moved]], col[moved], times[moved]), int(swaps.sum()),
                      self.n_features, row[self.swap_row[swaps]])


def sample_of(rows: Sequence[tuple[int, dict[int, int], float]], swaps: Sequence[dict[int, int]], n_features: int) -> Sample:
    """``rows`` of (label, times by feature number, weight); ``swaps`` hold the
    times that a feature comes in or goes when a term is exchanged."""
    row, col, times = _triples([m for _, m, _ in rows])
    return Sample(row, col, times, np.array([y for y, _, _ in rows], dtype=float),
                  np.array([w for _, _, w in rows], dtype=float), _triples(swaps), len(swaps), n_features)


def _triples(maps: Sequence[dict[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at = np.repeat(np.arange(len(maps)), [len(m) for m in maps]).astype(np.int64)
    return (at, np.array([j for m in maps for j in m], dtype=np.int64),
            np.array([c for m in maps for c in m.values()], dtype=float))


BLOCK = 1 << 17         # entries summed at a time


class _Sums:
    """Sums by group: of ``values[of]`` times ``times`` over each group's entries,
    for groups 0 to ``n`` - 1.  Entries lie in order of their group, so that a sum
    is one run, and are taken a block at a time; only their numbers are kept."""

    def __init__(self, group: np.ndarray, of: np.ndarray, times: np.ndarray, n: int):
        if (group[1:] < group[:-1]).any():
            order = np.argsort(group, kind="stable")
            group, of, times = group[order], of[order], times[order]
        start = np.nonzero(np.diff(group, prepend=-1))[0]
        self.held, self.n, self.of = group[start], n, of
        self.times = None if (times == 1).all() else times
        # blocks end where groups do
        cuts = np.unique(np.searchsorted(start, np.arange(0, len(group), BLOCK))) if len(group) else []
        ends = np.append(start, len(group))
        self.blocks = [(i, j, ends[i], ends[j], start[i:j] - ends[i])
                       for i, j in zip(cuts, [*cuts[1:], len(start)], strict=True)] if len(start) else []

    def __call__(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(self.n)
        for i, j, a, b, start in self.blocks:
            if i == j:
                continue
            lined = values.take(self.of[a:b], mode="clip")      # all are in range; the fastest way to take
            out[self.held[i:j]] = np.add.reduceat(lined if self.times is None else lined * self.times[a:b], start)
        return out


def fit_weights(s: Sample, l2: float, counterfactual: float = 1.0, epochs: int = 300,
                rate: float = 0.05) -> tuple[np.ndarray, float]:
    """Adam on the weighted mean log loss + l2 |w|^2 + counterfactual * the mean
    squared logit change of a swap."""
    n, share = s.n_features, s.weight / s.weight.sum()
    theta = np.zeros(n + 1)                     # the last: bias
    rate_1 = float(share @ s.y)
    theta[-1] = np.log((rate_1 + 1e-3) / (1 - rate_1 + 1e-3))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    at, col, times = s.swap
    of_row, of_feature = _Sums(s.row, s.col, s.times, len(s.y)), _Sums(s.col, s.row, s.times, n)
    for step in range(1, epochs + 1):
        z = of_row(theta) + theta[-1]
        apart = share * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - s.y)
        g = np.empty_like(theta)
        g[:n] = of_feature(apart) + 2 * l2 * theta[:n]
        g[-1] = apart.sum()
        if s.n_swaps:
            change = np.bincount(at, theta[col] * times, s.n_swaps)
            g[:n] += 2 * counterfactual / s.n_swaps * np.bincount(col, change[at] * times, n)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return theta[:n], float(theta[-1])


def best_cut(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The logit that parts the classes best by F1 at the rows' weights: the
    middle of the widest of the best gaps between neighbouring logits."""
    order = np.argsort(-z, kind="stable")
    z, hit, all_ = z[order], np.cumsum((weight * y)[order]), np.cumsum(weight[order])
    f1 = 2 * hit / (all_ + (weight * y).sum())
    last = np.append(z[1:] < z[:-1], True)                      # equal logits fall on one side
    below = np.append(z[1:], z[-1] - 2.0)
    best = np.nonzero(last & (f1 >= f1[last].max() - 1e-12))[0]
    k = best[np.argmax((z - below)[best])]
    return float((z[k] + below[k]) / 2)


def _balanced(y: np.ndarray) -> np.ndarray:
    return np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y == 0).sum()))


def _chosen(rows: Sample, fold: np.ndarray, l2_grid: Sequence[float], **knobs: float) -> tuple[np.ndarray, float]:
    """Weights and intercept from ``rows``, weighed as they are in the labelled
    table.  The L2 strength is the one whose weights, learned off the ``fold``,
    part it with the least balanced log loss; its best cut becomes the intercept
    of the weights learned from all rows."""
    everything = replace(rows, weight=_balanced(rows.y))
    train, test = rows.part(~fold), rows.part(fold)
    if set(train.y) != {0, 1} or set(test.y) != {0, 1}:
        return fit_weights(everything, l2_grid[0], **knobs)     # too few rows to set anything on
    found = []
    for l2 in l2_grid:
        w, bias = fit_weights(train, l2, **knobs)
        z = np.bincount(test.row, w[test.col] * test.times, len(test.y)) + bias
        loss = float(test.weight @ np.logaddexp(0, np.where(test.y > 0, -z, z)))
        # a text without a known word stands among them as one clean row
        found.append((loss, l2, best_cut(np.append(z, bias), np.append(test.y, 0.0), np.append(rows.weight[fold], 1.0))))
    del train, test
    _, l2, cut = min(found)
    w, bias = fit_weights(everything, l2, **knobs)
    return w, bias - cut


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS, min_z: float = MIN_Z,
        l2_grid: Sequence[float] = L2_GRID, **knobs: float) -> ToxicityModel:
    """``labelled(doc_id, text, toxic)`` -> model.  Rows with a NULL label are
    left out; repeated rows count as often as they come.  Without rows of both
    classes the model is the constant rate of the labels (0 without any)."""
    rows = labelled.where("toxic is not null").select(
        F.xxhash64("doc_id", whole_text("text")).alias("id"), (F.col("toxic") > 0).cast("int").alias("y"),
        F.array_distinct(F.regexp_extract_all(F.lower(whole_text("text")), F.lit(LETTERS), F.lit(0))).alias("words"))
    rows = stored(rows, "toxicity-words")
    n = {r.y: r.n for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 2:
        rate = 0.999 if 1 in n else 0.001
        return ToxicityModel(float(np.log(rate / (1 - rate))))
    # over every labelled row: documents per word and class, added up before the
    # shuffle; a beginning counts once for each of a text's words that has it
    of_word = lambda w: F.concat(F.array(w), *[     # noqa: E731
        F.when(F.char_length(w) > k, F.array(F.concat(F.lit("^"), F.left(w, F.lit(k))))).otherwise(F.array().cast("array<string>"))
        for k in BEGINNINGS])
    of_words = (rows.select("y", F.explode("words").alias("word"))
                .groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("t")))
    counts = (of_words.select(F.explode(of_word(F.col("word"))).alias("feature"), "n", "t")
              .groupBy("feature").agg(F.sum("n").alias("n"), F.sum("t").alias("t")))
    often = F.col("n") / (n[0] + n[1])          # times a text, whose variance is the same as for rare words
    z = (F.col("t") / n[1] - (F.col("n") - F.col("t")) / n[0]) / F.sqrt(often * (1 / n[1] + 1 / n[0]))
    told = stored(counts.where(F.abs(z) >= min_z).select("feature"), "toxicity-features")
    # at most half of fit_rows per label, chosen by a hash of id and text
    keep = {y: min(1.0, fit_rows / 2 / n[y]) for y in n}
    chance = F.pmod(F.xxhash64("id", F.lit(20)), F.lit(1 << 30)) / (1 << 30)
    sample = stored(rows.where(chance < F.when(F.col("y") > 0, keep[1]).otherwise(keep[0])), "toxicity-sample")
    known = F.array(*[F.lit(w) for w in identity_terms()])
    # the driver gets the distinct features that texts of the sample hold, and for
    # each of its fit_rows rows their numbers, as often as its words have them
    of_sample = sample.select(F.explode("words").alias("word")).distinct()
    said = (of_sample.select(F.explode(of_word(F.col("word"))).alias("feature")).distinct()
            .join(told, "feature").toArrow()["feature"].to_pylist())
    vocab = sorted({*said, *(f for t in identity_terms() for f in features(t))})
    number = {f: i for i, f in enumerate(vocab)}

    @F.pandas_udf("array<int>")
    def numbers(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = lru_cache(KEPT_WORDS)(lambda word: [number[f] for f in features(word) if f in number])
        for s in batches:
            yield pd.Series([[f for w in held for f in of(w)] for held in s], dtype="object")

    data = (sample.select("id", "y", numbers("words").alias("f"), F.array_intersect("words", known).alias("terms"),
                          (F.pmod(F.xxhash64("words", F.lit(7)), F.lit(4)) == 0).alias("fold"))
            .toArrow().sort_by([("id", "ascending"), ("y", "ascending")]))    # sums in one order

    def change(a: str, b: str) -> dict[int, int]:
        out: dict[int, int] = {}
        for word, by in ((a, -1), (b, 1)):
            for f in features(word):
                out[number[f]] = out.get(number[f], 0) + by
        return {j: c for j, c in out.items() if c}

    row = np.repeat(np.arange(len(data), dtype=np.int32), pc.list_value_length(data["f"]).to_numpy())
    col = pc.list_flatten(data["f"]).to_numpy()
    data = data.drop_columns("f")
    swaps = [(i, change(a, b)) for i, t in enumerate(data["terms"].to_pylist()) for a, b in counterfactuals(set(t))]
    y = data["y"].to_numpy().astype(float)
    rows_of = Sample(row, col, np.ones(len(col), dtype=np.int8), y,
                     np.where(y > 0, 1 / keep[1], 1 / keep[0]), _triples([m for _, m in swaps]), len(swaps), len(vocab),
                     np.array([i for i, _ in swaps], dtype=np.int64))
    w, bias = _chosen(rows_of, data["fold"].to_numpy(zero_copy_only=False).astype(bool), l2_grid, **knobs)
    return ToxicityModel(bias, {f: float(w[i]) for f, i in number.items() if abs(w[i]) > 1e-9})


def score(model: ToxicityModel, text: Column) -> Column:
    """Probability of toxicity of each whole text, NULL and empty ones included."""

    @F.pandas_udf("double")
    def toxicity(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weight = lru_cache(KEPT_WORDS)(model.of_word)
        for s in batches:
            z = np.array([model.bias + fsum(map(weight, set(WORD.findall(t)))) for t in s], dtype=float)
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))), dtype="float64")

    return toxicity(F.lower(whole_text(text)))


def reject_toxic(docs: DataFrame, labelled: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows scored at or over ``threshold`` by a model
    learned from ``labelled(doc_id, text, toxic)``; columns stay as they are."""
    model = fit(labelled)
    return docs.where(score(model, F.col("text")) < threshold)
