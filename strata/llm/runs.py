"""Periodic runs of words, by a suffix automaton with link-cut access.

A run is a stretch of words with a smallest period ``q``, at least twice as long
as ``q``, that no neighbouring word extends.  The states of the suffix automaton
of a stretch of words, hung up by their suffix links, form a tree in which the
path from the state of a prefix to the root holds all suffixes of that prefix.
Words are appended one by one; each recolours the path of its prefix with its own
position, so that a path falls into segments of one colour, the end of the last
occurrence.  Where a segment whose deepest state holds ``l`` words has colour
``j``, the words up to position ``i`` agree with those up to ``j`` over exactly
``l`` words; with ``i - j <= l`` these are squares of period ``i - j``, and the
stretch from ``j - l + 1`` to ``i`` has that smallest period.  It is reported
where the next word ends it.  Splay trees over the segments (link-cut access)
make recolouring logarithmic, also for texts that are one long repetition.

A run of at least ``m`` words repeats ``ceil(m / 2)`` consecutive words at its
period, all over its length.  So only stretches of words covered by windows of
that size which occur twice in the text are searched; a neighbouring word outside
such a stretch cannot extend a run, and nothing is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

MIN_LENGTH = 12


def suffix_automaton(codes: list[int]) -> tuple[list[int], list[int], list[int]]:
    """``(length, link, prefix)``: longest word count and suffix link of every
    state, and the state of every prefix.  The root is state 0.

    Most states have one transition; it lies in two flat lists, and only states
    with more get a dictionary.
    """
    length, link, prefix = [0], [0], []
    word, target, more = [-1], [0], {}
    last = 0
    for n, c in enumerate(codes, 1):
        new = len(length)
        length.append(n)
        link.append(0)
        word.append(-1)
        target.append(0)
        prefix.append(new)
        p, found = last, -1
        while True:
            if word[p] == c:
                found = target[p]
                break
            if word[p] == -1:
                word[p], target[p] = c, new
            else:
                others = more.get(p)
                if others is None:
                    more[p] = {c: new}
                elif c in others:
                    found = others[c]
                    break
                else:
                    others[c] = new
            if p == 0:
                break
            p = link[p]
        if found > 0:
            if length[p] + 1 == length[found]:
                link[new] = found
            else:
                copy = len(length)
                length.append(length[p] + 1)
                link.append(link[found])
                word.append(word[found])
                target.append(target[found])
                if found in more:
                    more[copy] = dict(more[found])
                while True:
                    if word[p] == c:
                        if target[p] != found:
                            break
                        target[p] = copy
                    else:
                        others = more.get(p)
                        if others is None or others.get(c) != found:
                            break
                        others[c] = copy
                    if p == 0:
                        break
                    p = link[p]
                link[found] = link[new] = copy
        last = new
    return length, link, prefix


def runs_of(codes: list[int], min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run of at least ``min_length`` of a
    sequence of word numbers, by start, then period."""
    n = len(codes)
    length, parent, prefix = suffix_automaton(codes)
    # splay trees over segments; a tree's colour is kept at its root alone, and the
    # parent of a root is the state above the segment (0: the automaton's root)
    left, right, colour = [0] * len(length), [0] * len(length), [-1] * len(length)
    out = []
    for i in range(n):
        x, below = prefix[i], 0
        while x:
            # splay x to the root of its segment's tree
            p = parent[x]
            while p and (left[p] == x or right[p] == x):
                g = parent[p]
                inner = g and (left[g] == p or right[g] == p)
                if not inner:
                    colour[x] = colour[p]
                    if left[p] == x:
                        b = right[x]
                        left[p], right[x] = b, p
                    else:
                        b = left[x]
                        right[p], left[x] = b, p
                    if b:
                        parent[b] = p
                    parent[p], parent[x] = x, g
                    break
                top = parent[g]
                if left[g] == p:
                    if left[p] == x:
                        b, c = right[p], right[x]
                        left[g], right[p], left[p], right[x] = b, g, c, p
                        if b:
                            parent[b] = g
                        if c:
                            parent[c] = p
                        parent[g], parent[p] = p, x
                    else:
                        b, c = left[x], right[x]
                        right[p], left[g], left[x], right[x] = b, c, p, g
                        if b:
                            parent[b] = p
                        if c:
                            parent[c] = g
                        parent[p] = parent[g] = x
                elif right[p] == x:
                    b, c = left[p], left[x]
                    right[g], left[p], right[p], left[x] = b, g, c, p
                    if b:
                        parent[b] = g
                    if c:
                        parent[c] = p
                    parent[g], parent[p] = p, x
                else:
                    b, c = right[x], left[x]
                    left[p], right[g], right[x], left[x] = b, c, p, g
                    if b:
                        parent[b] = p
                    if c:
                        parent[c] = g
                    parent[p] = parent[g] = x
                parent[x] = top
                if top:
                    if left[top] == g:
                        left[top] = x
                    elif right[top] == g:
                        right[top] = x
                    else:
                        colour[x] = colour[g]
                else:
                    colour[x] = colour[g]
                p = top
            j, deeper = colour[x], right[x]
            if deeper:
                colour[deeper] = j          # what lies below keeps its colour as a segment of its own
            right[x] = below
            if j >= 0:
                period, size = i - j, length[x] + i - j
                if period <= length[x] and size >= min_length and (i + 1 == n or codes[i + 1] != codes[i + 1 - period]):
                    out.append((i - size + 1, size, period))
            below, x = x, parent[x]
        colour[below] = i
    return sorted(out, key=lambda r: (r[0], r[2]))


def repeating_stretches(codes: np.ndarray, lengths: np.ndarray, min_length: int = MIN_LENGTH) -> list[tuple[int, int]]:
    """``(first, end)`` of the stretches of a batch's words that windows occurring
    twice in their text cover.  ``codes`` are the words of all texts one after
    another, ``lengths`` the words per text.  Windows are told apart by a hash:
    a collision only makes a stretch longer."""
    size = max(1, -(-min_length // 2))
    n = len(codes)
    if n < size + 1:
        return []
    text = np.repeat(np.arange(len(lengths)), lengths)
    mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    h = np.zeros(n - size + 1, dtype=np.uint64)
    for k in range(size):
        h = h * np.uint64(0xD6E8FEB86659FD93) + mixed[k:k + len(h)]
    whole = text[:len(h)] == text[size - 1:]
    at = np.nonzero(whole)[0]
    h = (h[at] ^ (h[at] >> np.uint64(32))) * np.uint64(0xFF51AFD7ED558CCD) + text[at].astype(np.uint64)
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    twice = np.zeros(len(order), dtype=bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    starts = at[twice]
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + size, -1)
    covered = np.cumsum(edge[:n]) > 0
    begin = covered & np.concatenate([[True], ~covered[:-1] | (text[1:] != text[:-1])])
    stop = covered & np.concatenate([~covered[1:] | (text[1:] != text[:-1]), [True]])
    return [(a, b) for a, b in zip(np.nonzero(begin)[0].tolist(), (np.nonzero(stop)[0] + 1).tolist())
            if b - a >= min_length]


def find_runs(docs: DataFrame, words: str = "words", min_length: int = MIN_LENGTH, rows_at_once: int = 256) -> DataFrame:
    """``docs(..., words array<string>)`` -> its rows without the words column,
    with ``runs`` (array of ``start, length, period``, by start, then period;
    words are numbered from 0) and ``collapsed`` (the words that no run holds
    after its first period, joined by one space).

    Every row comes back once, repeated rows and ids too; a NULL or empty array
    has no runs and an empty ``collapsed``.  Words are compared as they are; a
    NULL word reads as empty.  The other columns are passed through and never
    read.  A text is held by one task, at a few hundred bytes per word of its
    repeating stretches; nothing is shuffled.
    """
    kept = [c for c in docs.columns if c != words]
    types = dict(docs.dtypes)
    schema = ", ".join([*[f"`{c}` {types[c]}" for c in kept],
                        "runs array<struct<start:long,length:long,period:long>>", "collapsed string"])
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, len(batch), rows_at_once):
                rows = batch.slice(first, rows_at_once)
                lists = rows.column(words)
                lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(
                    zero_copy_only=False).astype(np.int64)
                coded = lists.flatten().fill_null("").dictionary_encode()
                codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                ends = np.cumsum(lengths)
                found = [[] for _ in range(len(rows))]
                dropped = np.zeros(len(codes), dtype=bool)
                for a, b in repeating_stretches(codes, lengths, min_length):
                    owner = int(np.searchsorted(ends, a, side="right"))
                    base = int(ends[owner] - lengths[owner])
                    for start, size, period in runs_of(codes[a:b].tolist(), min_length):
                        found[owner].append({"start": a - base + start, "length": size, "period": period})
                        dropped[a + start + period:a + start + size] = True
                stays = np.nonzero(~dropped)[0]
                left_of = np.concatenate([[0], np.cumsum(~dropped)])[np.concatenate([[0], ends])].astype(np.int32)
                collapsed = pc.binary_join(
                    pa.ListArray.from_arrays(left_of, coded.dictionary.take(pa.array(codes[stays]))), " ")
                yield pa.RecordBatch.from_arrays(
                    [*[rows.column(c) for c in kept], pa.array(found, run_type), collapsed],
                    [*kept, "runs", "collapsed"])

    return docs.mapInArrow(search, schema)
