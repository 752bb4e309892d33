"""Quality rules as a short-circuit cascade.

Every rule rejects or passes a whole text.  What a rule costs and what share it
rejects is measured on a bounded sample; rules then run by rejection per cost,
and a text that a rule rejects is not shown to the later ones.  The order changes
what a run costs, never which texts stay: a text stays if no rule rejects it.

Rules work on batches of texts as UTF-8 bytes, so that words (runs without ASCII
white space) come from ``bytes.split``, and counts from the interpreter's own
byte searches; repeated word windows are numbered with numpy, exactly, by sorting
pairs of numbers.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import bounded_fit, stored, whole_text

SAMPLE_ROWS = 2_000     # documented bound of the sample that costs are measured on
WINDOW = 5              # words of a repeated window
_SPACE = b" \t\n\v\f\r"
_SYMBOLS = b"#*$%&|<>"
_AFTER_FIRST = bytes(range(0x80, 0xC0))         # UTF-8 bytes that begin no character


# --- measures of texts ----------------------------------------------------------------

def n_words(texts: Sequence[bytes]) -> np.ndarray:
    return np.array([len(t.split()) for t in texts], dtype=np.int64)


def word_chars(texts: Sequence[bytes]) -> np.ndarray:
    """Code points in words: bytes that begin a character and are no white space."""
    drop = _AFTER_FIRST + _SPACE
    return np.array([len(t.translate(None, drop)) for t in texts], dtype=np.int64)


def n_symbols(texts: Sequence[bytes]) -> np.ndarray:
    return np.array([sum(t.count(s) for s in _SYMBOLS) for t in texts], dtype=np.int64)


def _worded_lines(text: bytes) -> list[bytes]:
    return [line for line in text.split(b"\n") if line.strip(_SPACE)]


def n_dup_lines(texts: Sequence[bytes]) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    lines = [_worded_lines(t) for t in texts]
    return np.array([len(x) - len(set(x)) for x in lines], dtype=np.int64)


def n_lines(texts: Sequence[bytes]) -> np.ndarray:
    return np.array([len(_worded_lines(t)) for t in texts], dtype=np.int64)


def n_repeat_words(texts: Sequence[bytes], window: int = WINDOW) -> np.ndarray:
    """Words inside windows that their text holds twice or more."""
    split = [t.split() for t in texts]
    lengths = np.array([len(w) for w in split], dtype=np.int64)
    n = int(lengths.sum())
    out = np.zeros(len(texts), dtype=np.int64)
    if n < window:
        return out
    coded = pa.array([w for words in split for w in words], pa.binary()).dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    text = np.repeat(np.arange(len(texts)), lengths)

    def pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """One number per distinct pair."""
        return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1] if len(a) else a

    # numbers of windows, one word longer at a time: equal exactly if the words are
    grams = pairs(text, codes)                  # a window counts within its text alone
    for k in range(1, window):
        grams = pairs(grams[:n - k], codes[k:])
    starts = np.nonzero(text[:n - window + 1] == text[window - 1:])[0]
    held = grams[starts]
    again = starts[np.bincount(held)[held] > 1] if len(held) else starts
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + window, -1)
    return np.bincount(text, np.cumsum(edge[:n]) > 0, len(texts)).astype(np.int64)


def n_capital_words(texts: Sequence[bytes]) -> np.ndarray:
    """Words with cased letters, all of them capitals."""
    return np.array([sum(w.isupper() for w in t.decode("utf-8", "replace").split()) for t in texts], dtype=np.int64)


# --- rules ------------------------------------------------------------------------------

@dataclass(frozen=True)
class Rule:
    """``rejects(texts)`` tells for a batch of texts which ones the rule rejects.
    All rules are whole-number comparisons, so they agree wherever they run."""

    name: str
    rejects: Callable[[Sequence[bytes]], np.ndarray]


RULES = (
    Rule("few_words", lambda t: n_words(t) < 10),
    Rule("repeated_words", lambda t: 100 * n_repeat_words(t) > 20 * n_words(t)),
    Rule("symbols", lambda t: 10 * n_symbols(t) > n_words(t)),
    Rule("word_length", lambda t: (word_chars(t) < 2 * n_words(t)) | (word_chars(t) > 15 * n_words(t))),
    Rule("repeated_lines", lambda t: 10 * n_dup_lines(t) > 3 * n_lines(t)),
    Rule("capitals", lambda t: 10 * n_capital_words(t) > 5 * n_words(t)),
    Rule("exclamations", lambda t: 10 * np.array([x.count(b"!") for x in t], dtype=np.int64) > 3 * n_words(t)),
)

MEASURES: dict[str, Callable[[Sequence[bytes]], np.ndarray]] = {
    "n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup_lines,
    "n_repeat_words": n_repeat_words,
}


@dataclass(frozen=True)
class Estimate:
    """Seconds per text and share of texts rejected, as seen on the sample."""

    name: str
    cost: float
    rejection: float


def _bytes(texts: pd.Series) -> list[bytes]:
    return [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]


def estimate(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS,
             column: str = "text") -> list[Estimate]:
    """Cost and rejection of each rule alone, over at most about ``sample_rows``
    texts chosen by a hash.  The sample stays in the tasks; one row per rule and
    task is added up.  No rows: nothing costs or rejects anything."""
    texts = docs.select(whole_text(column).alias("t"))
    n = texts.count()
    sample = stored(bounded_fit(texts, n, sample_rows, key=F.struct(F.xxhash64("t"), F.monotonically_increasing_id())),
                    "cascade-sample")

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            part, rows = _bytes(batch["t"]), []
            for rule in rules:
                begin = time.process_time()
                gone = int(np.count_nonzero(rule.rejects(part)))
                rows.append((rule.name, time.process_time() - begin, gone, len(part)))
            yield pd.DataFrame(rows, columns=["rule", "seconds", "rejected", "n"])

    got = {r.rule: r for r in sample.mapInPandas(measure, "rule string, seconds double, rejected long, n long")
           .groupBy("rule").agg(F.sum("seconds").alias("seconds"), F.sum("rejected").alias("rejected"),
                                F.sum("n").alias("n")).collect()}
    return [Estimate(r.name, got[r.name].seconds / got[r.name].n, got[r.name].rejected / got[r.name].n)
            if r.name in got and got[r.name].n else Estimate(r.name, 0.0, 0.0) for r in rules]


def ordered(rules: Sequence[Rule], estimates: Sequence[Estimate]) -> list[Rule]:
    """Rules by rejection per cost, highest first; of equal ones the cheaper, then by name."""
    by_name = {e.name: e for e in estimates}

    def rank(rule: Rule) -> tuple[float, float, str]:
        e = by_name.get(rule.name, Estimate(rule.name, 0.0, 0.0))
        return -e.rejection / max(e.cost, 1e-9), e.cost, rule.name

    return sorted(rules, key=rank)


def first_rejection(texts: Sequence[bytes], rules: Sequence[Rule]) -> list[str | None]:
    """The first rule that rejects each text; a rule sees only what came through the ones before."""
    out: list[str | None] = [None] * len(texts)
    left = np.arange(len(texts))
    for rule in rules:
        if not len(left):
            break
        gone = np.asarray(rule.rejects([texts[k] for k in left]), dtype=bool)
        for k in left[gone]:
            out[k] = rule.name
        left = left[~gone]
    return out


def cascade(docs: DataFrame, rules: Sequence[Rule] | None = None, measures: Sequence[str] = (),
            column: str = "text", rows_at_once: int = 256) -> DataFrame:
    """``docs`` with ``rejected_by`` (NULL: kept), ``kept`` and the named
    ``measures`` (longs, over every text).

    ``rules`` run in the order given; without them the default rules run in the
    order that :func:`estimate` gives for ``docs``.  Which rule is named depends
    on that order, ``kept`` does not.  Every row comes back once, repeated rows
    and NULL ids too; a NULL text reads as empty, which has no words.  Columns
    of ``docs`` named like a new one are replaced.
    """
    rules = ordered(RULES, estimate(docs, RULES, column=column)) if rules is None else list(rules)
    new = ["rejected_by", "kept", *measures]
    types = dict(docs.dtypes)
    # the text goes to the tasks once, under a name of its own
    passed = [c for c in docs.columns if c not in new]
    source = docs.select(*[F.col(f"`{c}`") for c in passed], whole_text(F.col(f"`{column}`")).alias("__text"))
    schema = ", ".join([*[f"`{c}` {types[c]}" for c in passed], "rejected_by string", "kept boolean",
                        *[f"`{m}` long" for m in measures]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, len(batch), rows_at_once):
                rows = batch.slice(first, rows_at_once)
                texts = rows.column("__text").cast(pa.binary()).to_pylist()
                verdict = first_rejection(texts, rules)
                yield pa.RecordBatch.from_arrays(
                    [*[rows.column(c) for c in passed], pa.array(verdict, pa.string()),
                     pa.array([v is None for v in verdict], pa.bool_()),
                     *[pa.array(MEASURES[m](texts), pa.int64()) for m in measures]],
                    [*passed, *new])

    return source.mapInArrow(run, schema)
