"""SimHash near-duplicates by a segment-popcount embedding.

Fingerprints (64 bits, majority of the XXH64 values of word shingles) are
embedded as the numbers of set bits in 32 segments of two bits.  The Manhattan
distance of two embeddings never exceeds the Hamming distance, so fingerprints
within ``max_bits`` meet in a grid over the embedding: of ``max_bits // 2 + 1``
parts of the segments at least one differs by one step at most, that is, in one
coordinate of one grid cell.  Only distinct fingerprints are gridded (a copy
group is one point), one side visits its own cell and the cells one step up, and
what meets is verified exactly with ``bit_count(xor)``.

A cell of many distinct fingerprints would meet itself pair by pair.  Points of
such a cell are linked through midpoints instead, with no pairs and no cap: a
and b are within ``max_bits`` exactly if some value lies within half of it (up)
of one and half of it (down) of the other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import stored, whole_text
from strata.llm.components import connected_components

SEED = 42
CELL_POINTS = 256       # more distinct points than this: linked by midpoints
_BLOCK = 1 << 15        # shingles whose bits are counted at a time


def fingerprint_text(text: str | None, shingle: int = 3) -> int:
    """The signed 64-bit fingerprint of one text; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()    # bytes: A-Z only
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = [b" ".join(g) for g in zip(*(words[i:] for i in range(shingle)))]
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(grams), _BLOCK):
        h = np.array([xxhash.xxh64_intdigest(g, SEED) for g in grams[i:i + _BLOCK]], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(grams), bitorder="little").view("<i8")[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """Fingerprint column of a text column (batches of whole texts)."""

    @F.pandas_udf("long")
    def simhash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series([fingerprint_text(t, shingle) for t in s], dtype="int64")

    return simhash(whole_text(text))


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _parts(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of the parts; widths are even, so segments stay whole."""
    n = max_bits // 2 + 1
    cuts = [64 * i // n // 2 * 2 for i in range(n)] + [64]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _cell(fp: Column, first: int, width: int) -> Column:
    """The grid cell of a part: its segments' bit counts, two bits each.  Two
    halves, so that no arithmetic leaves the range of a long."""
    low_width = min(width, 32)
    out = F.lit(0).cast("long")
    for start, size in ((first, low_width), (first + low_width, width - low_width)):
        if size:
            x = F.shiftrightunsigned(fp, start).bitwiseAND(F.lit((1 << size) - 1).cast("long"))
            odd = F.shiftright(x, 1).bitwiseAND(F.lit(0x55555555).cast("long"))
            out = out.bitwiseOR(F.shiftleft(x - odd, start - first))
    return out


def _keys(points: DataFrame, parts: list[tuple[int, int]], steps: bool) -> DataFrame:
    """(part, cell, fp): the own cell of each part and, with ``steps``, the
    cells one step up in one segment."""
    fp, all_keys = F.col("fp"), []
    for p, (first, width) in enumerate(parts):
        cell = _cell(fp, first, width)
        cells = [cell]
        if steps:
            for s in range(0, width, 2):
                count = F.shiftrightunsigned(cell, s).bitwiseAND(F.lit(3).cast("long"))
                cells.append(F.when(count < 2, cell.bitwiseXOR(
                    F.shiftleft(count.bitwiseXOR(count + 1), s))))
        all_keys += [F.struct(F.lit(p).alias("part"), c.alias("cell")) for c in cells]
    return (points.select("fp", F.explode(F.array(*all_keys)).alias("key"))
            .where("key.cell is not null").select("key.part", "key.cell", "fp"))


def _flips(fp: Column, bits: int) -> Column:
    """All values within ``bits`` of ``fp``."""
    masks = [0]
    for k in range(1, bits + 1):
        masks += [sum(1 << i for i in c) for c in combinations(range(64), k)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    return F.transform(F.array(*[F.lit(m).cast("long") for m in signed]) if len(signed) < 200
                       else F.from_json(F.lit("[" + ",".join(map(str, signed)) + "]"), "array<bigint>"),
                       lambda m: m.bitwiseXOR(fp))


def _midpoint_links(points: DataFrame, max_bits: int) -> DataFrame:
    """Links among ``points`` that have the same components as all pairs within
    ``max_bits``: a midpoint has the points within the smaller half and those
    within the larger half of it; each of one side is linked to each of the
    other, so one of the smaller half stands for all."""
    near, far = max_bits // 2, max_bits - max_bits // 2
    a = points.select(F.explode(_flips(F.col("fp"), near)).alias("mid"), "fp")
    hubs = a.groupBy("mid").agg(F.min("fp").alias("hub"))
    b = points.select(F.explode(_flips(F.col("fp"), far)).alias("mid"), "fp")
    return b.join(hubs, "mid").select(F.col("fp").alias("u"), F.col("hub").alias("v")).where("u != v")


def links(points: DataFrame, max_bits: int = 3, cell_points: int = CELL_POINTS) -> DataFrame:
    """``points(fp)``, distinct -> ``(u, v)`` links whose components are those
    of all pairs within ``max_bits``.  Outside crowded cells these are the pairs."""
    parts = _parts(max_bits)
    own = _keys(points, parts, steps=False)
    crowded = stored(own.groupBy("part", "cell").agg(F.count(F.lit(1)).alias("n"))
                     .where(F.col("n") > cell_points).select("part", "cell"), "crowded")
    if crowded.isEmpty():
        dense, base = None, own
    else:
        # points of crowded cells meet each other through midpoints, and the
        # points of other cells through the grid: those cells are not crowded
        dense = stored(own.join(crowded, ["part", "cell"], "left_semi").select("fp").distinct(), "dense")
        base = own.join(crowded, ["part", "cell"], "left_anti")
    visits = _keys(points, parts, steps=True)
    a, b = base.withColumnRenamed("fp", "v"), visits.withColumnRenamed("fp", "u")
    pairs = (b.join(a, ["part", "cell"])
             .where((F.col("u") != F.col("v"))
                    & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits))
             .select("u", "v"))
    if dense is None:
        return pairs
    # a visit from an ordinary cell up into a crowded one: that side is the
    # point's own cell there, so the crowded point visits down instead
    return pairs.union(_midpoint_links(_around(dense, points, crowded, parts), max_bits))


def _around(dense: DataFrame, points: DataFrame, crowded: DataFrame,
            parts: list[tuple[int, int]]) -> DataFrame:
    """Points of crowded cells and those that would visit such a cell."""
    guests = _keys(points, parts, steps=True).join(crowded, ["part", "cell"], "left_semi").select("fp")
    return dense.union(guests).distinct()


def _components(marked: DataFrame, max_bits: int, cell_points: int) -> tuple[DataFrame, DataFrame]:
    """Of ``marked(doc_id, fp, ...)``: ``points(fp, first_id)``, the distinct
    fingerprints, and ``moved(fp, root, least_id)`` of those linked to another."""
    points = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "points")
    comp = connected_components(links(points.select("fp"), max_bits, cell_points))
    linked = points.join(comp, points.fp == comp.node)
    least = linked.groupBy("component").agg(F.min("first_id").alias("least_id"))
    return points, stored(comp.join(least, "component").select(
        F.col("node").alias("fp"), F.col("component").alias("root"), "least_id"), "moved")


def near_duplicates(docs: DataFrame, max_bits: int = 3, shingle: int = 3,
                    cell_points: int = CELL_POINTS) -> DataFrame:
    """``docs(doc_id, text)`` -> one row per row of docs: ``doc_id``, ``fp``
    (signed long) and ``component_id``, the smallest id reachable over links of
    at most ``max_bits`` differing bits.

    NULL and empty texts have fingerprint 0 and link like any other.  Repeated
    rows come back as often as they came.  A NULL id is never a component's
    id unless the component has no other.  An empty table gives an empty result.
    """
    marked = stored(docs.select(F.col("doc_id"), fingerprint(F.col("text"), shingle).alias("fp")), "simhash")
    points, moved = _components(marked, max_bits, cell_points)
    labels = points.join(moved, "fp", "left").select("fp", F.coalesce("least_id", "first_id").alias("component_id"))
    return marked.join(labels, "fp").select("doc_id", "fp", "component_id")


def _row_keys(docs: DataFrame) -> list[Column]:
    """Two hashes of a whole row, 128 bits in all; rows that agree in every
    column that can be hashed agree in both.  NULL is told from every value."""
    plain = [F.col(f"`{c}`") for c, t in docs.dtypes if not t.startswith(("map", "variant"))]
    nulls = F.concat(F.lit("n"), *[F.when(c.isNull(), "1").otherwise("0") for c in plain])
    return [F.xxhash64(F.lit(salt), nulls, *plain) for salt in ("first", "second")]


def deduplicate(docs: DataFrame, max_bits: int = 3, shingle: int = 3) -> DataFrame:
    """``docs`` with one row of each component: the one of the smallest id (rows
    without an id last; of rows that share it, the first by the hash of text and
    row).  Repeated and NULL ids follow the same rule, so that two unrelated texts
    under one id both stay and of two copies without an id one goes.

    Only ids and hashes are grouped; whole rows move once, to meet the kept keys.
    """
    one, two = _row_keys(docs)
    marked = stored(docs.select("doc_id", F.xxhash64(whole_text("text")).alias("text_hash"), one.alias("__one"),
                                two.alias("__two"), fingerprint(F.col("text"), shingle).alias("fp")), "simhash")
    _, moved = _components(marked, max_bits, CELL_POINTS)
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "__one", "__two")
    # the best row of each fingerprint before components are met: copies never travel
    best = marked.groupBy("fp").agg(F.min(rank).alias("best"))
    kept = stored(best.join(moved.select("fp", "root"), "fp", "left").groupBy(F.coalesce("root", "fp").alias("root"))
                  .agg(F.min("best").alias("best")).select("best.__one", "best.__two"), "kept")
    twice = stored(marked.groupBy("__one", "__two").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                   .select("__one", "__two").join(kept, ["__one", "__two"], "left_semi"), "kept-twice")
    keyed = docs.withColumns({"__one": one, "__two": two})
    out = keyed.join(kept, ["__one", "__two"], "left_semi")
    if not twice.isEmpty():             # whole rows that repeat: one of them
        again = out.join(twice, ["__one", "__two"], "left_semi")
        nth = F.row_number().over(Window.partitionBy("__one", "__two").orderBy(F.lit(1)))
        out = out.join(twice, ["__one", "__two"], "left_anti").unionByName(
            again.withColumn("__nth", nth).where("__nth = 1").drop("__nth"))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
