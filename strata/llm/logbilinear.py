"""Language-model scoring with a log-bilinear neural model.

Every word above a count floor has a symbol of its own; the floor grows with the
square root of the corpus, and so does the vocabulary.  Words below it share a
symbol by their last two letters where the ending is frequent enough, else one
symbol for the rest.  The model predicts the next symbol's vector as a sum of the
context vectors of the symbols before it, weighed by position.  Symbols lie in
classes of neighbours in frequency, so that a probability, class times symbol
within its class, is normalised over all symbols by two short matrix products.

The model is trained in numpy with noise-contrastive estimation over all training
documents: in rounds, each over its share of the documents, every task starts
from the round's parameters, learns from its own texts in batches, and Spark
averages the tasks' parameters by the tokens they saw.  The noise enters by its
expectation over the class or the class's symbols, without sampling error.

A word's share within a shared symbol follows the corpus counts, so a token's
log-probability is normalised over all words and one unseen word per shared
symbol.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import one_blas_thread, stored, whole_text

DIM = 24
CONTEXT = 4             # symbols before a token that the model sees
FLOOR_SHARE = 2         # a symbol stands for sqrt(tokens) / 2 tokens at least
LEAST_COUNT = 5
ROUNDS = 3
BATCH = 4096            # tokens of a training step
LEAST_TOKENS = 200_000  # a task with fewer goes over them again,
MOST_PASSES = 30        # so many times at most
HEAD_WORDS = 200_000    # at most so many words, the most frequent, whose counts every task gets
BLOCK = 4096            # parameters averaged in one row
END = "\n"              # the end token; no word holds white space


# --- the vocabulary and the corpus counts ----------------------------------------------

@dataclass
class Vocabulary:
    """Symbols by falling training tokens: words of their own, endings shared by
    the words below the floor, and ``rest`` for all others.  ``mass`` has the
    tokens of each symbol, ``types`` the distinct words of a shared one (0: own)."""

    own: dict[bytes, int]
    endings: dict[bytes, int]
    rest: int
    mass: np.ndarray
    types: np.ndarray

    @property
    def end(self) -> int:
        return self.own[END.encode()]

    @cached_property
    def _keys(self) -> list[tuple[pa.Array, np.ndarray]]:
        """Words and their symbols, endings and theirs, each with ``rest`` for none."""
        return [(pa.array(list(d), pa.binary()), np.array([*d.values(), self.rest])) for d in (self.own, self.endings)]

    def symbols(self, words: pa.Array | list[bytes]) -> np.ndarray:
        """The symbol of each of ``words`` (UTF-8)."""
        words = pa.array(words, pa.binary()) if isinstance(words, list) else words
        (own, own_ids), (endings, ending_ids) = self._keys
        at = places(words, own)
        out = own_ids[at]
        away = np.nonzero(at < 0)[0]
        if len(away):
            last = pc.utf8_slice_codeunits(words.take(pa.array(away)).cast(pa.string()), -2)
            out[away] = ending_ids[places(last.cast(pa.binary()), endings)]
        return out


def places(words: pa.Array, among: pa.Array) -> np.ndarray:
    """Where each word lies in ``among``; -1: nowhere."""
    return pc.fill_null(pc.index_in(words, value_set=among), -1).to_numpy(zero_copy_only=False)


def vocabulary_of(own: list[tuple[str, int]], endings: list[tuple[str, int, int]], rest: tuple[int, int]) -> Vocabulary:
    """From ``(word, count)``, ``(ending, tokens, types)`` and the rest's ``(tokens, types)``."""
    if END not in dict(own):
        own = [*own, (END, 0)]
    rows = [(n, 0, w, 0) for w, n in own] + [(n, 1, e, t) for e, n, t in endings] + [(rest[0], 2, "", rest[1])]
    rows.sort(key=lambda r: (-r[0], r[1], r[2]))
    of = [{r[2].encode(): i for i, r in enumerate(rows) if r[1] == kind} for kind in (0, 1, 2)]
    return Vocabulary(of[0], of[1], of[2][b""], np.array([r[0] for r in rows], dtype=float),
                      np.array([r[3] for r in rows], dtype=float))


@dataclass
class Corpus:
    """What scoring needs of the training documents: ``counts(token, c)`` as a
    table, its most frequent words with their counts, totals and the vocabulary."""

    counts: DataFrame
    head: pa.Array
    head_counts: np.ndarray
    tokens: int
    distinct: int
    vocabulary: Vocabulary


def head_floor(histogram: list[tuple[int, int]], most: int) -> int:
    """The least count such that at most ``most`` words reach it, from ``(bucket,
    words)`` with eight buckets per doubling of the count."""
    total, floor = 0, None
    for bucket, words in sorted(histogram, reverse=True):
        total += words
        if total > most:
            break
        floor = bucket
    return int(np.ceil(2 ** (floor / 8) - 1e-9)) if floor is not None else 1 << 62


def gather(train_docs: DataFrame, head_words: int = HEAD_WORDS, floor_share: float = FLOOR_SHARE) -> Corpus:
    """Counts of every token of ``train_docs(text)``, added up before the shuffle.

    The driver gets the words over two floors and the frequent endings: a
    histogram of the counts says where the first floor lies, so that no more than
    ``head_words`` reach it; over the second, ``sqrt(tokens) / floor_share``, there
    are at most ``floor_share * sqrt(tokens)`` symbols.  Nothing is sorted.
    """
    def said(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, words, at, _ in _texts(batch):
                yield pa.record_batch({"token": words.cast(pa.string()), "c": np.bincount(at, minlength=len(words))})

    counts = stored(train_docs.select(whole_text("text").alias("text")).mapInArrow(said, "token string, c long")
                    .groupBy("token").agg(F.sum("c").alias("c")), "token-counts")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    buckets = (counts.groupBy(F.floor(F.log2("c") * 8 + 1e-9).cast("int").alias("b"))
               .agg(F.count(F.lit(1)).alias("n")).collect())
    least = head_floor([(r.b, r.n) for r in buckets], head_words)
    floor = max(LEAST_COUNT, total.n ** 0.5 / floor_share)
    head = counts.where(F.col("c") >= least).toArrow()
    own = counts.where((F.col("c") >= floor) | (F.col("token") == END)).toArrow()
    rest = counts.where((F.col("c") < floor) & (F.col("token") != END))
    shared = stored(rest.groupBy(F.right("token", F.lit(2)).alias("ending"))
                    .agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")), "endings")
    often = shared.where(F.col("n") >= floor).toArrow()
    other = shared.where(F.col("n") < floor).agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    words = vocabulary_of(list(zip(own["token"].to_pylist(), own["c"].to_pylist())),
                          list(zip(*(often[c].to_pylist() for c in ("ending", "n", "v")))), (other[0], other[1]))
    known = head["token"].cast(pa.binary()).combine_chunks()
    return Corpus(counts, known, head["c"].to_numpy(), total.n, total.v, words)


# --- the model ------------------------------------------------------------------------

def classes_of(mass: np.ndarray) -> np.ndarray:
    """First symbols of the classes, with the number of symbols at the end: about
    the square root of the symbols, each of an equal share of the roots of mass."""
    n = len(mass)
    k = int(np.ceil(np.sqrt(n)))
    share = np.cumsum(np.sqrt(mass + 0.5))
    of = np.minimum((k * (share - np.sqrt(mass + 0.5)) / share[-1]).astype(int), k - 1)
    return np.append(np.unique(of, return_index=True)[1], n)


@dataclass
class LogBilinear:
    """``context`` and ``target`` vectors (symbols x dim), ``place`` weights
    (positions x dim), class vectors ``group`` and the two biases."""

    cuts: np.ndarray            # classes are the symbols between two cuts
    context: np.ndarray
    place: np.ndarray
    group: np.ndarray
    group_bias: np.ndarray
    target: np.ndarray
    bias: np.ndarray

    PARTS = ("context", "place", "group", "group_bias", "target", "bias")

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, p).ravel() for p in self.PARTS])

    def filled(self, flat: np.ndarray) -> LogBilinear:
        out, at = {}, 0
        for p in self.PARTS:
            like = getattr(self, p)
            out[p] = flat[at:at + like.size].reshape(like.shape).astype(np.float32)
            at += like.size
        return LogBilinear(self.cuts, **out)

    def predicted(self, context: np.ndarray) -> np.ndarray:
        """Predicted vectors of ``context`` (tokens x positions)."""
        out = self.context[context[:, 0]] * self.place[0]
        for k in range(1, context.shape[1]):
            out += self.context[context[:, k]] * self.place[k]
        return out

    def log10(self, context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Normalised log10 probability of each symbol after its context."""
        order, of, spans = _by_class(self.cuts, symbol)
        r, symbol = self.predicted(context[order]), symbol[order]
        got = _normalised(r @ self.group.T + self.group_bias, of)
        for g, rows in spans:
            a, b = self.cuts[g], self.cuts[g + 1]
            if b - a > 1:
                got[rows] += _normalised(r[rows] @ self.target[a:b].T + self.bias[a:b], symbol[rows] - a)
        out = np.empty(len(got))
        out[order] = got
        return out / np.log(10)


def _normalised(scores: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log softmax of each row at ``at``; ``scores`` is overwritten."""
    rows, ones = np.arange(len(at)), np.ones(scores.shape[1], dtype=scores.dtype)
    top = scores.max(initial=0)
    if top > 60 or scores.min(initial=0) < -60:         # beyond what single precision can add up
        scores -= scores.max(axis=1, keepdims=True)
    seen = scores[rows, at].astype(float)
    np.exp(scores, out=scores)
    return seen - np.log(scores @ ones)


def _by_class(cuts: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, slice]]]:
    """An order of the symbols by class, their classes in that order, and where
    each class lies in it."""
    of = np.searchsorted(cuts, symbol, side="right") - 1
    order = np.argsort(of, kind="stable")
    of = of[order]
    groups, starts = np.unique(of, return_index=True)
    ends = [*starts[1:].tolist(), len(of)]
    return order, of, [(g, slice(a, b)) for g, a, b in zip(groups.tolist(), starts.tolist(), ends)]


def started(mass: np.ndarray, dim: int = DIM, positions: int = CONTEXT, seed: int = 5) -> LogBilinear:
    """The model before training: the unigram distribution, and small vectors."""
    rng, cuts, n = np.random.default_rng(seed), classes_of(mass), len(mass)
    p = mass + 0.5
    groups = np.add.reduceat(p, cuts[:-1])
    within = np.log(p / np.repeat(groups, np.diff(cuts)))

    def small(*shape: int) -> np.ndarray:
        return rng.normal(0, 0.1, shape).astype(np.float32)
    place = np.repeat(1.0 / (1 + np.arange(positions))[:, None] ** 0.5, dim, axis=1)
    return LogBilinear(cuts, small(n, dim), place.astype(np.float32), small(len(groups), dim),
                       np.log(groups / groups.sum()).astype(np.float32), small(n, dim), within.astype(np.float32))


class Trainer:
    """Noise-contrastive estimation by AdaGrad steps.

    On either level the observed symbol (or class) is told from ``noise`` draws of
    the unigram distribution of its level, which enter by their expectation:
    of the scores ``s`` less ``log(noise q)`` the sigmoid should be one at the
    symbol observed and nought, weighed by ``noise q``, at every one.
    """

    def __init__(self, model: LogBilinear, mass: np.ndarray, noise: float = 10.0, rate: float = 0.2):
        self.model, self.rate = model, rate
        p, cuts = mass + 0.5, model.cuts
        groups = np.add.reduceat(p, cuts[:-1])
        self.group_noise = (noise * groups / groups.sum()).astype(np.float32)
        self.noise = (noise * p / np.repeat(groups, np.diff(cuts))).astype(np.float32)
        self.log_noise = np.log(self.noise)
        self.square = {k: np.full_like(getattr(model, k), 1e-4) for k in model.PARTS}

    @staticmethod
    def _sigmoids(scores: np.ndarray) -> None:
        """``scores``, less the logs of their noise, become sigmoids in place."""
        np.negative(scores, out=scores)
        with np.errstate(over="ignore"):                # a sigmoid of nought
            np.exp(scores, out=scores)
        scores += 1
        np.reciprocal(scores, out=scores)

    @classmethod
    def _apart(cls, scores: np.ndarray, noise: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Gradient of minus the objective by the scores, which are overwritten:
        the sigmoids, weighed by the noise, less what is left to one at ``at``."""
        scores -= np.log(noise)
        cls._sigmoids(scores)
        rows = np.arange(len(at))
        left = 1 - scores[rows, at]
        scores *= noise
        scores[rows, at] -= left
        return scores

    def _move(self, part: str, g: np.ndarray, rows: slice | np.ndarray = slice(None)) -> None:
        self.square[part][rows] += g * g
        getattr(self.model, part)[rows] -= self.rate * g / np.sqrt(self.square[part][rows])

    def step(self, context: np.ndarray, symbol: np.ndarray) -> None:
        m, n = self.model, np.float32(1.0 / len(symbol))
        order, of, spans = _by_class(m.cuts, symbol)
        context, symbol = context[order], symbol[order]
        r = m.predicted(context)
        d = self._apart(r @ m.group.T + m.group_bias, self.group_noise, of) * n
        back = d @ m.group
        moves = [("group", d.T @ r, slice(None)), ("group_bias", d.sum(axis=0), slice(None))]
        # the scores of all classes lie in one array, class by class, and are told
        # apart as above
        widths = np.diff(m.cuts)[of]
        widths[widths == 1] = 0
        ends = np.cumsum(widths)
        flat, several = np.empty(int(ends[-1]), dtype=np.float32), widths > 0
        at = (ends - widths + symbol - m.cuts[of])[several]
        shift, parts = m.bias - self.log_noise, []
        for g, rows in spans:
            a, b = m.cuts[g], m.cuts[g + 1]
            if b - a > 1:
                d = flat[ends[rows.start] - widths[rows.start]:ends[rows.stop - 1]].reshape(-1, b - a)
                np.matmul(r[rows], m.target[a:b].T, out=d)
                d += shift[a:b]
                parts.append((a, b, rows, d))
        self._sigmoids(flat)
        left = 1 - flat[at]
        for a, b, _, d in parts:
            d *= self.noise[a:b]
        flat[at] -= left
        flat *= n
        held, vectors, biases = [], [], []
        for a, b, rows, d in parts:
            back[rows] += d @ m.target[a:b]
            held.append(np.arange(a, b))
            vectors.append(d.T @ r[rows])
            biases.append(d.sum(axis=0))
        if held:
            there = np.concatenate(held)
            moves += [("target", np.concatenate(vectors), there), ("bias", np.concatenate(biases), there)]
        # what comes back to each (position, symbol), from which both gradients
        # follow: symbols by the times they are there, summed dimension by dimension
        there = np.zeros(len(m.context), dtype=bool)
        there[context] = True
        held, where = np.nonzero(there)[0], (np.cumsum(there) - 1)[context]
        near = m.context[held]
        given, placed = np.zeros_like(near), np.empty_like(m.place)
        back = back.T.astype(float)
        for k in range(context.shape[1]):
            at = np.ascontiguousarray(where[:, k])
            sums = np.stack([np.bincount(at, x, len(held)) for x in back], axis=1).astype(np.float32)
            placed[k] = (sums * near).sum(axis=0)
            given += sums * m.place[k]
        moves += [("context", given, held), ("place", placed, slice(None))]
        for part, g, rows in moves:
            self._move(part, g, rows)


# --- texts in tasks --------------------------------------------------------------------

def contexts(symbols: np.ndarray, lengths: np.ndarray, end: int, positions: int) -> np.ndarray:
    """The symbols before each token, nearest first; the end symbol before a text."""
    place = np.arange(len(symbols)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out = np.full((len(symbols), positions), end, dtype=np.int64)
    for k in range(1, positions + 1):
        there = place >= k
        out[there, k - 1] = symbols[np.nonzero(there)[0] - k]
    return out


def _texts(batch: pa.RecordBatch, size: int = 1 << 21) -> Iterator[tuple[int, int, pa.Array, np.ndarray, np.ndarray]]:
    """(first row, rows, distinct words, the word of each token, tokens per row) of
    slices of a batch, each of about ``size`` bytes of text; a longer text is a
    slice of its own.  The text column has no NULL."""
    col = batch.column("text")
    ends = np.cumsum(pc.binary_length(col).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    at = 0
    while at < len(col):
        before = ends[at - 1] if at else 0
        rows = max(1, int(np.searchsorted(ends, before + size, side="right")) - at)
        # ASCII alone: A-Z and white space
        split = pc.ascii_split_whitespace(pc.ascii_lower(col.slice(at, rows)))
        said = split.flatten()
        real = pc.greater(pc.binary_length(said), 0)
        owner = np.repeat(np.arange(rows), pc.list_value_length(split).to_numpy(zero_copy_only=False))
        owner = owner[real.to_numpy(zero_copy_only=False)]
        coded = said.filter(real).dictionary_encode()
        lengths = np.bincount(owner, minlength=rows) + 1
        tokens = np.full(len(owner) + rows, len(coded.dictionary), dtype=np.int64)
        tokens[np.arange(len(owner)) + owner] = coded.indices.to_numpy(zero_copy_only=False)
        words = pa.concat_arrays([coded.dictionary.cast(pa.binary()), pa.array([END.encode()], pa.binary())])
        yield at, rows, words, tokens, lengths
        at += rows


def learn(model: LogBilinear, parts: Iterator[tuple[np.ndarray, np.ndarray]], words: Vocabulary, seed: int,
          least_tokens: int = LEAST_TOKENS, most_passes: int = MOST_PASSES, **knobs: float) -> tuple[LogBilinear, int]:
    """``parts`` of (symbols, tokens per text) -> the model after a pass over
    them, in shuffled batches, and the tokens seen.  Fewer than ``least_tokens``
    are gone over again, up to ``most_passes`` times."""
    rng, trainer, n = np.random.default_rng(seed), Trainer(model, words.mass, **knobs), 0
    waiting: list[tuple[np.ndarray, np.ndarray]] = []

    def turn() -> None:
        ctx, sym = (np.concatenate([w[k] for w in waiting]) for k in (0, 1))
        order = rng.permutation(len(sym))
        for i in range(0, len(order), BATCH):
            trainer.step(ctx[order[i:i + BATCH]], sym[order[i:i + BATCH]])

    size = 0
    for symbols, lengths in parts:
        waiting.append((contexts(symbols, lengths, words.end, len(model.place)), symbols))
        size += len(symbols)
        n += len(symbols)
        if size >= 16 * BATCH:
            if n >= least_tokens:
                turn()
                waiting.clear()
                size = 0
    if waiting:
        for _ in range(min(most_passes, max(1, -(-least_tokens // n)))):
            turn()
    return model, n


def fit(train_docs: DataFrame, corpus: Corpus, rounds: int = ROUNDS, dim: int = DIM, positions: int = CONTEXT,
        **knobs: float) -> LogBilinear:
    """The model of all of ``train_docs(text)``: every document is seen in one of
    the ``rounds``.  What comes back of a task is its parameters, in blocks that
    Spark adds up in two steps; the driver gets one set of parameters a round."""
    words = corpus.vocabulary
    model = started(words.mass, dim, positions)
    if not corpus.tokens:
        return model
    plain = [F.col(f"`{c}`") for c, t in train_docs.dtypes if not t.startswith(("map", "variant"))]
    texts = train_docs.select(whole_text("text").alias("text"), F.pmod(F.xxhash64(*plain), F.lit(rounds)).alias("round"))

    def task(turn: int, start: LogBilinear):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            one_blas_thread()
            part = TaskContext.get().partitionId()

            def symbols() -> Iterator[tuple[np.ndarray, np.ndarray]]:
                for batch in batches:
                    for _, _, said, at, lengths in _texts(batch):
                        yield words.symbols(said)[at], lengths

            own = start.filled(start.flat())
            learned, n = learn(own, symbols(), words, 1000 * turn + part, **knobs)
            if n:
                flat = learned.flat().astype(np.float64) * n
                starts = range(0, len(flat), BLOCK)
                yield pa.record_batch({
                    "block": pa.array([s // BLOCK for s in starts], pa.int32()),
                    "slot": pa.array([part % 32] * len(starts), pa.int32()),
                    "n": pa.array([float(n)] * len(starts)),
                    "sums": pa.array([flat[s:s + BLOCK].tobytes() for s in starts], pa.binary())})
        return run

    def added(group: pa.Table) -> pa.Table:
        total = np.zeros(len(group["sums"][0].as_py()) // 8)
        for s in group["sums"]:
            total += np.frombuffer(s.as_py())
        return pa.table({"block": group["block"][:1], "slot": group["slot"][:1],
                         "n": pa.array([float(np.sum(group["n"].to_numpy()))]), "sums": pa.array([total.tobytes()], pa.binary())})

    shape = "block int, slot int, n double, sums binary"
    for turn in range(rounds):
        parts = texts.where(F.col("round") == turn).select("text").mapInArrow(task(turn, model), shape)
        got = (parts.groupBy("block", "slot").applyInArrow(added, shape)
               .groupBy("block").applyInArrow(added, shape).toArrow().sort_by("block"))
        if len(got):
            model = model.filled(np.concatenate([np.frombuffer(s.as_py()) / n.as_py() for s, n in zip(got["sums"], got["n"])]))
    return model


def score(docs: DataFrame, corpus: Corpus, model: LogBilinear) -> DataFrame:
    """``docs(doc_id, text)`` -> ``doc_id, n_tokens, n_known, base_score,
    score``, one row per row.

    Tokens of the head are scored where they are; the others meet the full
    count table by token, added up per row and token before the shuffle, so no
    frequent token is ever shuffled.  Texts of NULL hold the end token alone.
    """
    words, head, counted = corpus.vocabulary, corpus.head, np.append(corpus.head_counts, -1)
    n, v = corpus.tokens, corpus.distinct
    # log10 of a shared symbol's mass: its counts and halves, one unseen word more
    mass = np.log10(words.mass + 0.5 * (words.types + 1))
    is_shared = np.ones(len(mass), dtype=bool)
    is_shared[list(words.own.values())] = False
    positions = len(model.place)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_blas_thread()
        for batch in batches:
            for first, rows, said, at, lengths in _texts(batch):
                c = counted[places(said, head)]
                of = words.symbols(said)
                symbols, text = of[at], np.repeat(np.arange(rows), lengths)
                model_part = np.empty(len(at))
                around = contexts(symbols, lengths, words.end, positions)
                for i in range(0, len(at), 16_384):
                    j = slice(i, i + 16_384)
                    model_part[j] = model.log10(around[j], symbols[j])
                log_c = np.where(c >= 0, np.log10(np.maximum(c, 0) + 0.5), 0.0)
                # within-symbol part: log10((c + 0.5) / mass); 0 for own symbols
                inside = np.where(is_shared[of], log_c - mass[of], 0.0)
                # tokens outside the head, once per row with their number
                away = np.nonzero((c < 0)[at])[0]
                pair, times = np.unique(text[away] * np.int64(len(said)) + at[away], return_counts=True)
                owner, word = pair // max(1, len(said)), pair % max(1, len(said))
                cuts = np.searchsorted(owner, np.arange(rows + 1)).astype(np.int32)
                yield pa.record_batch({
                    "row_id": batch.column("row_id").slice(first, rows),
                    "doc_id": batch.column("doc_id").slice(first, rows),
                    "n_tokens": lengths, "known": np.bincount(text, (c > 0)[at], rows).astype(np.int64),
                    "base": np.bincount(text, log_c[at], rows), "model": np.bincount(text, model_part + inside[at], rows),
                    "far": pa.ListArray.from_arrays(cuts, pa.StructArray.from_arrays(
                        [said.take(pa.array(word)).cast(pa.string()), pa.array(times.astype(np.int64))],
                        ["token", "times"])),
                })

    # rows are named where they are written, so repeated ids stay apart
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", whole_text("text").alias("text"))
    near_rows = stored(rows.mapInArrow(
        near, f"row_id long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, known long, "
              "base double, model double, far array<struct<token:string,times:long>>"), "lm-near")
    far_rows = near_rows.select("row_id", F.explode("far").alias("f")).select("row_id", "f.token", "f.times")
    c = F.coalesce("c", F.lit(0))
    add = F.col("times") * F.log10(c + 0.5)
    # words of the head are never far, so their counts need not travel
    far_sums = (far_rows.join(corpus.counts, "token", "left").groupBy("row_id")
                .agg(F.sum(add).alias("far_sum"), F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("far_known")))
    zero = F.lit(0.0)
    return (near_rows.drop("far").join(far_sums, "row_id", "left").select(
        "doc_id", "n_tokens",
        (F.col("known") + F.coalesce("far_known", F.lit(0))).alias("n_known"),
        (F.col("base") + F.coalesce("far_sum", zero)
         - F.col("n_tokens") * F.lit(float(np.log10(n + 0.5 * (v + 1))))).alias("base_score"),
        (F.col("model") + F.coalesce("far_sum", zero)).alias("score")))


def score_documents(docs: DataFrame, train_docs: DataFrame, **knobs: float) -> DataFrame:
    """``docs(doc_id, text)`` scored by a model of ``train_docs(text)`` ->
    ``doc_id, n_tokens, n_known, train_tokens, base_score, score``, one row per
    row of docs (repeated and NULL ids too).  Without training documents every
    count is 0 and the model is untrained."""
    corpus = gather(train_docs)
    model = fit(train_docs, corpus, **knobs)
    return score(docs, corpus, model).withColumn("train_tokens", F.lit(corpus.tokens).cast("long"))
