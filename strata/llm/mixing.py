"""Mixing sources to target weights by pivotal dependent rounding.

A document's expected number of copies is its source's target over the source's
size.  The whole part is taken as it is; the fractions are rounded dependently:
two documents at a time, words move from one to the other, by chance in either
direction, until one of the fractions is 0 or 1.  Every step keeps the source's
words in sum and each document's expectation, so a source misses its target by
less than one document.  Leaves of a reduction tree round bounded blocks of a
source; each passes on the one document that is still open, and further levels
combine those until one is left, so no source, however large, meets in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SPACED_WORD, stored, whole_text

WEIGHTS = (5.0, 2.0, 1.0)
MAX_TIMES = 3.0
LEAF_ROWS = 20_000      # documents rounded together in a leaf
FAN_IN = 64             # nodes combined at each further level
_EPS = 1e-9


def targets(sizes: Sequence[tuple[str | None, int]], weights: Sequence[float] = WEIGHTS,
            max_times: float = MAX_TIMES) -> dict[str | None, float]:
    """Target words by source: sources by code point, NULL last, weigh
    ``weights`` in turn and share all sizes; a target stops at ``max_times`` its
    source's size, and the excess goes to the others by weight."""
    order = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    w = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    size = dict(order)
    left, out, open_ = float(sum(size.values())), {}, {s for s in size if size[s] > 0}
    out.update({s: 0.0 for s in size if size[s] <= 0})
    while open_:
        total = sum(w[s] for s in sorted(open_, key=str))
        full = {s for s in open_ if left * w[s] / total >= max_times * size[s]}
        if not full:
            out.update({s: left * w[s] / total for s in open_})
            break
        for s in full:
            out[s] = max_times * size[s]
        left -= sum(out[s] for s in full)
        open_ -= full
    return out


def _uniforms(tag: str, n: int) -> np.ndarray:
    seed = int.from_bytes(hashlib.blake2b(tag.encode(), digest_size=8).digest(), "little")
    return np.random.default_rng(seed).random(n)


def _open(f: float) -> bool:
    return _EPS < f < 1 - _EPS


def pivotal(frac: np.ndarray, size: np.ndarray, coins: np.ndarray) -> int:
    """Round ``frac`` in place; returns the position still open, or -1.

    Documents come by falling size.  Each one's partner is the shortest run of
    open documents after it that can give or take all the words it needs, so
    the larger one is settled and what stays open in the end is small.  Where
    the rest cannot (the tail), partners are single documents.
    """
    f, s = frac.tolist(), size.tolist()
    todo = [i for i in range(len(f)) if _open(f[i])]
    pos = 0
    for pos, i in enumerate(todo):
        if not _open(f[i]):
            continue
        # the run moves along one line, in shares of its distances from 0 or 1, so
        # that chance leaves every document's expectation as it is
        up, down, room, k, run = (1 - f[i]) * s[i], f[i] * s[i], 0.0, pos + 1, []
        while k < len(todo) and room < max(up, down):
            j = todo[k]
            if _open(f[j]):
                share = min(f[j], 1 - f[j])
                room += share * s[j]
                run.append((j, share))
            k += 1
        if room < max(up, down):
            break
        up_now = coins[i] < f[i]
        f[i] = 1.0 if up_now else 0.0
        for j, share in run:
            f[j] += share * (-up if up_now else down) / room
    held = -1
    for i in todo[pos:]:
        if not _open(f[i]):
            continue
        if held < 0:
            held = i
            continue
        h = held
        up = min((1 - f[h]) * s[h], f[i] * s[i])        # words from i to h
        down = min(f[h] * s[h], (1 - f[i]) * s[i])      # words from h to i
        move = up if coins[i] * (up + down) < down else -down
        f[h] += move / s[h]
        f[i] -= move / s[i]
        held = h if _open(f[h]) else i if _open(f[i]) else -1
    frac[:] = [x if _open(x) else float(round(x)) for x in f]
    return held


def _node(level: int, seed: int, last: bool):
    def rounded(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "doc_id", "uid"], ascending=[False, True, True],
                              kind="stable", na_position="last").reset_index(drop=True)
        tag = f"{seed}/{level}/{pdf['source'].iloc[0]!r}/{pdf['node'].iloc[0]}"
        coins = _uniforms(tag, len(pdf) + 1)
        frac, size = pdf["frac"].to_numpy(dtype=float).copy(), pdf["size"].to_numpy(dtype=float)
        at = pivotal(frac, size, coins)
        if at >= 0 and last:
            frac[at], at = float(coins[-1] < frac[at]), -1
        pdf["frac"] = frac
        pdf["open"] = np.arange(len(pdf)) == at
        return pdf
    return rounded


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_times: float = MAX_TIMES,
        leaf_rows: int = LEAF_ROWS, fan_in: int = FAN_IN, seed: int = 11) -> DataFrame:
    """``docs(doc_id, text, source)`` -> ``doc_id, source, uid, size,
    source_size, target, copies, taken`` per row.

    ``size`` is the number of space-separated words (NULL and empty texts: 0,
    never copied), ``uid`` a hash of the text.  Repeated rows are rounded as
    rows of their own; a NULL source is a source; an empty table gives an empty
    result.  Driver data: one row per source and, per level, nothing.
    """
    rows = stored(docs.select(
        "doc_id", F.col("source").cast("string").alias("source"), F.xxhash64("text").alias("uid"),
        F.regexp_count(whole_text("text"), F.lit(SPACED_WORD)).cast("long").alias("size")), "mix-sizes")
    spark = docs.sparkSession
    got = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")).collect()
    goal = targets([(r.source, r.source_size) for r in got], weights, max_times)
    plan = spark.createDataFrame(
        [(r.source, r.source_size, goal[r.source], max(1, -(-r.n // leaf_rows))) for r in got],
        "source string, source_size long, target double, leaves int")
    # one row per source: a size the planner sees, so it broadcasts only if small
    rate = F.when(F.col("size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(max_times)))) \
            .otherwise(F.lit(0.0))
    cur = (rows.join(plan, rows["source"].eqNullSafe(plan["source"])).drop(plan["source"])
           .withColumn("rate", rate)
           .withColumn("whole", F.floor("rate").cast("long"))
           .withColumn("frac", F.col("rate") - F.col("whole"))
           .withColumn("node", F.pmod(F.xxhash64("doc_id", "uid"), F.col("leaves")).cast("long"))
           .select("doc_id", "source", "uid", "size", "source_size", "target", "whole", "frac", "node",
                   F.lit(False).alias("open")))
    nodes, level, done = max([-(-r.n // leaf_rows) for r in got] or [1]), 0, None
    while True:
        last = nodes <= 1
        out = stored(cur.groupBy("source", "node").applyInPandas(_node(level, seed, last), cur.schema),
                     f"mix-level{level}")
        closed = out.where("not open")
        done = closed if done is None else done.unionByName(closed)
        if last:
            break
        cur = out.where("open").withColumn("node", F.floor(F.col("node") / fan_in).cast("long"))
        nodes, level = -(-nodes // fan_in), level + 1
    copies = F.col("whole") + F.round("frac").cast("long")
    return done.select("doc_id", "source", "uid", "size", "source_size", "target",
                       copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def apply_mix(docs: DataFrame, **knobs) -> DataFrame:
    """``docs`` as the mix takes them: the rows taken at least once, with
    ``copies`` and ``taken`` added (replaced, if docs has such columns).  Rows
    alike in id, source and text come as one row with their copies in sum."""
    got = (mix(docs, **knobs).groupBy("doc_id", "source", "uid")
           .agg(F.sum("copies").alias("copies"), F.sum("taken").alias("taken"))
           .where("copies > 0")
           .select(F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("uid").alias("__uid"),
                   F.col("copies").alias("__copies"), F.col("taken").alias("__taken")))
    keep = [c for c in docs.columns if c not in ("copies", "taken")]
    left = docs.select(*[F.col(f"`{c}`") for c in keep]).withColumn("__key", F.xxhash64("text"))
    joined = left.join(got, left["doc_id"].eqNullSafe(got["__id"]) & (left["__key"] == got["__uid"])
                       & left["source"].cast("string").eqNullSafe(got["__source"]))
    return (joined.dropDuplicates(["__id", "__source", "__uid"])
            .select(*[F.col(f"`{c}`") for c in keep],
                    F.col("__copies").alias("copies"), F.col("__taken").alias("taken")))
