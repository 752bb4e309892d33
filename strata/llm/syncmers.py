"""Document fingerprints from closed syncmers.

A k-mer (k consecutive bytes of the UTF-8 text) is a closed syncmer if the
smallest hash among its inner s-mers is that of its first or its last one.
Whether a k-mer is chosen depends on its own bytes alone, so equal passages give
equal anchors wherever they stand.  The chosen k-mers' hashes are folded into
bins, each keeping its smallest: a fingerprint of bounded size, whose agreement
estimates the share of anchors that two texts have in common.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import stored, whole_text

K, S, BINS = 16, 8, 64
BUCKET_CHARS = 8 << 20          # text laid out in order in one bucket, about
MAX_BUCKETS = 20_000


def anchors(rows: DataFrame, k: int = K, s: int = S) -> DataFrame:
    """``rows(key..., bytes)``, ``bytes`` binary -> the other columns, ``pos``
    (first byte, from 1) and ``hash`` of each closed syncmer.  Bytes fewer than k
    are one anchor; none have none."""
    keys = [c for c in rows.columns if c != "bytes"]
    n = F.octet_length("bytes")
    at = (F.when(n >= k, F.sequence(F.lit(1), n - (k - 1)))
           .when(n > 0, F.array(F.lit(1))).otherwise(F.array().cast("array<int>")))
    each = rows.select(*keys, "bytes", F.explode(at).alias("pos"))

    def inner(i: int) -> Column:
        return F.xxhash64(F.substring("bytes", F.col("pos") + i, F.lit(s)))

    last = k - s
    chosen = F.least(inner(0), inner(last)) <= F.least(*[inner(i) for i in range(1, last)]) if last > 1 else F.lit(True)
    return (each.where((F.octet_length("bytes") < k) | chosen)
            .select(*keys, "pos", F.xxhash64(F.substring("bytes", F.col("pos"), F.lit(k))).alias("hash")))


def sketches(rows: DataFrame, bins: int = BINS, k: int = K, s: int = S) -> DataFrame:
    """``rows(key..., bytes)`` -> the keys and ``sketch``, a sorted array of
    (bin, low 16 bits of the bin's smallest hash) as numbers.  Bins are reduced
    before the shuffle.  Keys without an anchor are absent."""
    keys = [c for c in rows.columns if c != "bytes"]
    low = (anchors(rows, k, s)
           .select(*keys, F.pmod("hash", F.lit(bins)).cast("int").alias("bin"), "hash")
           .groupBy(*keys, "bin").agg(F.min("hash").alias("low")))
    code = F.col("bin") * 65536 + F.col("low").bitwiseAND(F.lit(65535).cast("long")).cast("int")
    return low.groupBy(*keys).agg(F.sort_array(F.collect_list(code)).alias("sketch"))


def as_text(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda x: F.lower(F.lpad(F.hex(x), 6, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Agreeing bins over bins used by either, 0 to 1; two empty sketches: 1."""
    def used(x: Column) -> Column:
        return F.transform(x, lambda v: F.shiftright(v, 16))

    either = F.size(F.array_union(used(a), used(b)))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / either)


def _bucket_of(doc_id: Column, bounds: list[int]) -> Column:
    """Index of the last bound not above the id, by two short lists; NULL ids
    are in the last bucket."""
    step = max(1, math.isqrt(len(bounds)))
    rows = [bounds[i:i + step] for i in range(0, len(bounds), step)]

    def longs(xs: list[int]) -> Column:
        return F.array(*[F.lit(x).cast("long") for x in xs])

    row = F.size(F.filter(longs([r[0] for r in rows]), lambda b: b <= doc_id))
    place = F.size(F.filter(F.element_at(F.array(*[longs(r) for r in rows]), row), lambda b: b <= doc_id))
    return F.when(doc_id.isNull(), F.lit(len(bounds) - 1)).otherwise((row - 1) * step + place - 1)


def with_next(docs: DataFrame, bucket_chars: int = BUCKET_CHARS) -> DataFrame:
    """``docs(doc_id, text)`` -> ``bucket, doc_id, text, next_text, rid, next_rid`` in
    ascending ids (NULL last, repeated ids by text); after the last comes the
    first.  Ids are cut into buckets of neighbouring ids at values that occur, so
    the row after a bucket's last is the bound's: those rows are laid out twice,
    nothing is ordered in one task and each text is shuffled once.  Rows stay
    dealt out by ``bucket``: what is grouped by it and more is not shuffled again."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text("text").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long")).alias("n"), F.min("doc_id").alias("low")).first()
    buckets = int(min(MAX_BUCKETS, max(1, (size.n or 0) // bucket_chars)))
    bounds = [size.low] if size.low is not None else [0]
    if buckets > 1 and size.low is not None:
        cuts = rows.agg(F.percentile_approx("doc_id", [i / buckets for i in range(1, buckets)],
                                            100 * buckets).alias("p")).first().p
        bounds = sorted({size.low, *cuts})
    last = len(bounds) - 1
    bucket = _bucket_of(F.col("doc_id"), bounds)
    placed = rows.withColumn("bucket", bucket)
    if len(bounds) > 1:
        firsts = F.transform(F.array(*[F.lit(b).cast("long") for b in bounds]), lambda b: b)
        leads = F.array_contains(firsts, F.col("doc_id"))
    else:
        leads = F.col("doc_id").eqNullSafe(F.lit(size.low).cast("long"))
    home = F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("guest"))
    guest = F.struct(F.when(F.col("bucket") == 0, last).otherwise(F.col("bucket") - 1).alias("bucket"),
                     F.lit(1).alias("guest"))
    both = placed.select("doc_id", "text", F.explode(
        F.when(F.coalesce(leads, F.lit(False)), F.array(home, guest)).otherwise(F.array(home))).alias("at"))
    order = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").asc_nulls_last(), "text")
    laid = both.select("doc_id", "text", "at.bucket", "at.guest").select(
        "*", F.row_number().over(order).alias("nth"), F.lead("text").over(order).alias("next_text"),
        F.lead("guest").over(order).alias("next_guest"))
    stride = F.lit(1 << 40)
    first_of_next = F.when(F.col("bucket") == last, 0).otherwise(F.col("bucket") + 1).cast("long") * stride + 1
    rid = F.col("bucket").cast("long") * stride + F.col("nth")
    return laid.where("guest = 0").select(
        "bucket", "doc_id", "text", "next_text", rid.alias("rid"),
        F.when(F.col("next_guest") == 0, rid + 1).otherwise(first_of_next).alias("next_rid"))


def edited(text: Column, other: Column) -> Column:
    """``text`` with its last quarter (rounded down) replaced by the first as
    many code points of ``other``, or all of it."""
    n = F.char_length(text)
    cut = F.floor(n / 4).cast("int")
    return F.concat(F.left(text, n - cut), F.when(cut > 0, F.left(other, cut)).otherwise(""))


def fingerprints(docs: DataFrame, bins: int = BINS, k: int = K, s: int = S,
                 bucket_chars: int = BUCKET_CHARS) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: ``doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next``.  NULL texts are
    empty: their fingerprint is '' and they are like other empty texts only."""
    rows = with_next(docs, bucket_chars).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    facts = rows.select("bucket", "doc_id", "rid", "next_rid", F.char_length("text").cast("long").alias("n_chars"),
                        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    both = rows.select("bucket", "rid", F.explode(F.array(
        F.struct(F.lit(0).alias("which"), F.col("text").cast("binary").alias("bytes")),
        F.struct(F.lit(1).alias("which"), F.col("edited").cast("binary").alias("bytes")))).alias("v"))
    sketch = sketches(both.select("bucket", "rid", "v.which", "v.bytes"), bins, k, s)
    pair = sketch.groupBy("bucket", "rid").agg(
        F.max(F.when(F.col("which") == 0, F.col("sketch"))).alias("sketch"),
        F.max(F.when(F.col("which") == 1, F.col("sketch"))).alias("edited_sketch"))
    none = F.array().cast("array<int>")
    out = stored(facts.join(pair, ["bucket", "rid"], "left").select(
        "doc_id", "rid", "next_rid", "n_chars", "edited_sha256",
        F.coalesce("sketch", none).alias("sketch"), F.coalesce("edited_sketch", none).alias("edited_sketch")), "sketches")
    following = out.select(F.col("rid").alias("next_rid"), F.col("sketch").alias("next_sketch"))
    return out.join(following, "next_rid").select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"))
