"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary (a
sentencepiece model file, given by path).  A word's probability in a language is
the sum over all its segmentations into pieces, computed by the forward
algorithm; a text's is the product over its words.  Piece probabilities are
learned by expectation-maximisation: forward and backward sums give the expected
count of each piece over all segmentations of the training words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import bounded_fit, stored, whole_text

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
WORD = re.compile(r"[^\W\d_]+")
FIT_ROWS = 20_000           # documented bound of the labelled sample
MAX_PIECE = 12              # characters; longer pieces are not used
EM_ROUNDS = 3
_MARK = "▁"            # starts a word in the vocabulary
_SMOOTH = 0.1               # added to every piece's expected count
_CACHE = 100_000            # word scores kept per Python worker
_LONG = 64                  # longer words are scored as pieces of this many characters


class Pieces(dict[str, int]):
    """Pieces by number, and the trie that finds them in many words at once."""

    @cached_property
    def trie(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Steps ``state * columns + column``, sorted, the state each leads to, the
        piece that ends in each state (-1: none) and the column of each code
        point; state 0 is the root, column 0 a character of no piece."""
        columns = {c: i for i, c in enumerate(sorted({c for p in self for c in p}), 1)}
        step: dict[tuple[int, int], int] = {}
        ends = [-1]
        for piece, k in self.items():
            state = 0
            for c in piece:
                to = step.setdefault((state, columns[c]), len(ends))
                if to == len(ends):
                    ends.append(-1)
                state = to
            ends[state] = k
        column = np.zeros(max(map(ord, columns), default=0) + 2, dtype=np.int64)
        column[[ord(c) for c in columns]] = [*columns.values()]
        width = len(columns) + 1
        steps = sorted((state * width + c, to) for (state, c), to in step.items())
        steps.append((len(ends) * width, 0))            # beyond every step
        return (np.array([k for k, _ in steps]), np.array([to for _, to in steps]), np.array(ends), column)

    def spans(self, words: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(start, end, rows, pieces) for every span of the marked ``words``, all
        of one length, by start: the words that have a piece
        there.  A single character outside the vocabulary is ``len(self)``."""
        steps, to, ends, column = self.trie
        code = np.frombuffer("".join(_MARK + w for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
        code = column[np.minimum(code, len(column) - 1)].reshape(len(words), -1).T
        width, size = int(steps[-1]) // len(ends), len(code)
        for i in range(size):
            rows, state = np.arange(len(words)), np.zeros(len(words), dtype=np.int64)
            for j in range(i + 1, min(size, i + MAX_PIECE) + 1):
                key = state * width + code[j - 1][rows]
                at = np.searchsorted(steps, key)
                there = steps[at] == key
                if j == i + 1:
                    found = np.where(there, ends[to[at]], -1)
                    yield i, j, rows, np.where(found < 0, len(self), found)
                rows, state = rows[there], to[at[there]]
                if not len(rows):
                    break
                if j > i + 1:
                    found = ends[state]
                    real = np.nonzero(found >= 0)[0]
                    if len(real):
                        yield i, j, rows[real], found[real]


def _of_one_length(words: list[str], most: int = 20_000) -> Iterator[np.ndarray]:
    """The places of words of the same length, at most ``most`` at a time."""
    lengths = np.array([len(w) for w in words])
    for size in np.unique(lengths):
        at = np.nonzero(lengths == size)[0]
        for k in range(0, len(at), most):
            yield at[k:k + most]


@lru_cache(maxsize=4)
def _parse(blob: bytes) -> Pieces:
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_proto=blob)
    out = Pieces()
    for i in range(sp.get_piece_size()):
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i):
            continue
        piece = sp.id_to_piece(i).lower()
        if len(piece) <= MAX_PIECE and all(c == _MARK or c.isalpha() for c in piece):
            out.setdefault(piece, len(out))
    return out


def vocabulary(spark: SparkSession, path: str = VOCABULARY) -> bytes:
    """The vocabulary file's bytes, read on the driver (a parameter of fixed size)."""
    with open(path, "rb") as f:
        return f.read()


def words_of(text: str | None) -> list[str]:
    """Lower-cased letter runs; very long runs in chunks, so that every letter counts."""
    words = WORD.findall((text or "").lower())
    if max(map(len, words), default=0) <= _LONG:
        return words
    return [w[i:i + _LONG] for w in words for i in range(0, len(w), _LONG)]


def _spans(word: str, pieces: dict[str, int]) -> list[tuple[int, int, int]]:
    """(start, end, piece) of every piece in the marked word; -1 is a single
    character outside the vocabulary."""
    w = _MARK + word
    out = []
    for i in range(len(w)):
        for j in range(i + 1, min(len(w), i + MAX_PIECE) + 1):
            k = pieces.get(w[i:j])
            if k is not None:
                out.append((i, j, k))
            elif j == i + 1:
                out.append((i, j, -1))
    return out


def _forward_logs(word: str, pieces: dict[str, int], log_prob: np.ndarray) -> np.ndarray:
    n = len(word) + 1
    logs = np.full((n + 1, log_prob.shape[0]), -np.inf)
    logs[0] = 0.0
    for i, j, k in _spans(word, pieces):
        logs[j] = np.logaddexp(logs[j], logs[i] + log_prob[:, k])
    return logs[n]


def forward(words: list[str], pieces: dict[str, int], prob: np.ndarray) -> np.ndarray:
    """Natural-log probability of each word by language, all segmentations
    summed.  ``prob`` is languages x (pieces + 1); its last column is a
    character outside the vocabulary.  Words of a length go through the sums
    together; where these leave the range of a double, they are taken in logs."""
    pieces = pieces if isinstance(pieces, Pieces) else Pieces(pieces)
    by_piece = np.ascontiguousarray(prob.T)
    out = np.empty((len(words), prob.shape[0]))
    for at in _of_one_length(words):
        same = [words[i] for i in at]
        alpha = [np.ones((len(at), prob.shape[0]))]
        alpha += [np.zeros((len(at), prob.shape[0])) for _ in range(len(same[0]) + 1)]
        for i, j, rows, found in pieces.spans(same):
            if len(rows) == len(at):
                alpha[j] += alpha[i] * by_piece.take(found, axis=0)
            else:
                alpha[j][rows] += alpha[i].take(rows, axis=0) * by_piece.take(found, axis=0)
        with np.errstate(divide="ignore"):
            out[at] = np.log(alpha[-1])
        for i in np.nonzero((alpha[-1] < 1e-250).any(axis=1))[0]:
            out[at[i]] = _forward_logs(same[i], pieces, np.log(prob))
    return out


def expected_counts(words: dict[str, float], pieces: dict[str, int], prob: np.ndarray) -> np.ndarray:
    """Expected pieces of the counted words under one language's ``prob``
    (words whose probability leaves the range of a double add nothing)."""
    pieces = pieces if isinstance(pieces, Pieces) else Pieces(pieces)
    out, listed, counts = np.zeros(len(pieces) + 1), list(words), np.array([*words.values()], dtype=float)
    for at in _of_one_length(listed):
        same = [listed[i] for i in at]
        spans = list(pieces.spans(same))
        a, b = (np.zeros((len(same[0]) + 2, len(at))) for _ in range(2))
        a[0] = b[-1] = 1.0
        for i, j, rows, found in spans:
            a[j, rows] += a[i, rows] * prob[found]
        for i, j, rows, found in reversed(spans):
            b[i, rows] += prob[found] * b[j, rows]
        real = a[-1] >= 1e-250
        share = np.where(real, counts[at] / np.where(real, a[-1], 1.0), 0.0)
        for i, j, rows, found in spans:
            out += np.bincount(found, share[rows] * a[i, rows] * prob[found] * b[j, rows], len(out))
    return out


@dataclass
class WordScores:
    """Scores of words met before: the row of each in ``scores``."""

    row: dict[str, int]
    scores: np.ndarray


@dataclass
class LanguageModel:
    languages: list[str]
    prior: np.ndarray           # by language
    prob: np.ndarray            # languages x (pieces + 1)
    vocabulary: bytes

    def pieces(self) -> Pieces:
        return _parse(self.vocabulary)

    def no_words(self) -> WordScores:
        return WordScores({}, np.empty((0, len(self.languages))))

    def word_scores(self, words: list[str], cache: WordScores) -> np.ndarray:
        """The row of each word in ``cache.scores``."""
        if len(cache.row) > _CACHE:
            cache.row, cache.scores = {}, cache.scores[:0].copy()
        new = [w for w in dict.fromkeys(words) if w not in cache.row]
        if new:
            cache.row.update(zip(new, range(len(cache.row), len(cache.row) + len(new))))
            cache.scores = np.concatenate([cache.scores, forward(new, self.pieces(), self.prob)])
        return np.fromiter(map(cache.row.__getitem__, words), np.int64, len(words))

    def predict(self, texts: list[str | None], cache: WordScores | None = None):
        """(language, score) per text: the most probable language and its
        posterior; ``und`` with 0 for texts without a letter."""
        cache = cache or self.no_words()
        split = [words_of(t) for t in texts]
        rows = self.word_scores([w for s in split for w in s], cache)
        out, at = [], 0
        for s in split:
            if not s or not self.languages:
                out.append(("und", 0.0))
            else:
                z = np.log(self.prior) + cache.scores[rows[at:at + len(s)]].sum(axis=0)
                p = np.exp(z - z.max())
                p /= p.sum()
                best = int(p.argmax())
                out.append((self.languages[best], float(p[best])))
            at += len(s)
        return out


def fit(labelled: DataFrame, path: str = VOCABULARY, fit_rows: int = FIT_ROWS,
        rounds: int = EM_ROUNDS) -> LanguageModel:
    """``labelled(text, lang)`` -> model.  Rows with a NULL language or text are
    left out; the fit takes at most about ``fit_rows`` rows, whole.  Word counts
    and expected piece counts are sums by (language, word) and (language,
    piece); the driver gets one row per language and piece."""
    rows = labelled.where("lang is not null and text is not null").select(
        "text", F.col("lang").cast("string").alias("lang"))
    spark = labelled.sparkSession
    blob = vocabulary(spark, path)
    pieces = _parse(blob)
    sample = bounded_fit(rows, rows.count(), fit_rows, key=F.xxhash64("text"))
    counted = stored(
        sample.select("lang", F.explode(F.regexp_extract_all(
            F.lower("text"), F.lit(r"[\p{L}\p{M}]+"), F.lit(0))).alias("word"))
        .groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")), "words")
    sizes = sorted((r.lang, r.n) for r in counted.groupBy("lang").agg(F.sum("n").alias("n")).collect())
    languages = [lang for lang, _ in sizes]
    if not languages:
        return LanguageModel([], np.ones(0), np.ones((0, len(pieces) + 1)), blob)
    # start: vocabulary order is by falling frequency
    start = 1.0 / (np.arange(len(pieces) + 1) + 50.0)
    prob = np.tile(start / start.sum(), (len(languages), 1))
    for _ in range(rounds):
        now = prob

        def expect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            table, sums = _parse(blob), {}
            for pdf in batches:
                for lang, part in pdf.groupby("lang"):
                    words: dict[str, float] = {}
                    for w, n in zip(part["word"], part["n"]):
                        for i in range(0, len(w), _LONG):
                            words[w[i:i + _LONG]] = words.get(w[i:i + _LONG], 0.0) + n
                    got = expected_counts(words, table, now[languages.index(lang)])
                    sums[lang] = sums.get(lang, 0.0) + got
            for lang, got in sums.items():
                at = np.nonzero(got)[0]
                yield pd.DataFrame({"lang": lang, "piece": at, "n": got[at]})

        got = (counted.mapInPandas(expect, "lang string, piece long, n double")
               .groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas())
        prob = np.full((len(languages), len(pieces) + 1), _SMOOTH)
        where = got["lang"].map(languages.index).to_numpy(dtype=int)
        prob[where, got["piece"].to_numpy(dtype=int)] += got["n"].to_numpy()
        prob /= prob.sum(axis=1, keepdims=True)
    n_words = np.array([n for _, n in sizes], dtype=float)
    return LanguageModel(languages, n_words / n_words.sum(), prob, blob)


def identify(model: LanguageModel, text: Column) -> Column:
    """Struct (lang_pred, score) per whole text."""

    @F.arrow_udf("lang_pred string, score double")
    def language(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cache = model.no_words()
        for texts in batches:
            found = []
            for i in range(0, len(texts), 256):
                found += model.predict(texts.slice(i, 256).to_pylist(), cache)
            yield pa.StructArray.from_arrays([pa.array([lang for lang, _ in found], pa.string()),
                                              pa.array([p for _, p in found], pa.float64())], ["lang_pred", "score"])

    return language(whole_text(text))
