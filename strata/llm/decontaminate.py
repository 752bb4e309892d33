"""Benchmark decontamination by a positional inverted index.

The index stores postings (term, document, position).  A phrase occurs where the
postings of its terms, each shifted by the term's place in the phrase, meet.
The lists are taken from the rarest terms of every phrase window up: corpus
frequencies choose the two rarest places of each window (of equal windows of an
item, of the first), only their postings are stored and intersected (one
aggregate by document, item and shift).  What survives names blocks of positions;
the windows that begin in such a block are compared word by word.  A block is one
row whatever the number of shifts in it, so that a long repetition of an item's
words costs in proportion to its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import ANY_CASE_WORD, PLAIN_WORD, stored, whole_text, words_of

WINDOW = 10
SLOTS = 1 << 18                 # of text hashes, when texts are fetched for comparison
BLOCK = 64                      # positions compared in one row


def _hash(c: str = "text") -> Column:
    return F.xxhash64(whole_text(c))


def tokens(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> ``doc_id, text_hash, pos, term``.  A document is
    named by its id and its text's hash, so repeated ids stay apart."""
    words = words_of(whole_text("text"), PLAIN_WORD)
    return (docs.select("doc_id", _hash().alias("text_hash"), words.alias("words"))
            .select("doc_id", "text_hash", F.posexplode("words").alias("pos", "term")))


def build_postings(docs: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """The postings of ``docs``: all, or those of ``terms(term)``, distinct."""
    rows = tokens(docs)
    return rows if terms is None else rows.join(terms.select("term"), "term").select(*rows.columns)


def _items(benchmark: DataFrame) -> DataFrame:
    """``item_key, item_id, words`` of the items that have words; repeated rows once."""
    return (benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
                             words_of(whole_text("text"), PLAIN_WORD).alias("words"))
            .where(F.size("words") > 0)
            .withColumn("item_key", F.xxhash64("item_id", "words"))
            .dropDuplicates(["item_key"]))


def _grams(words: Column, starts: Column, length: Column | int) -> Column:
    """The windows of ``length`` words at 0-based ``starts``, space-joined."""
    length = length if isinstance(length, Column) else F.lit(length)
    return F.transform(starts, lambda s: F.array_join(F.slice(words, s + 1, length), " "))


def _anchors(docs: DataFrame, items: DataFrame, window: int) -> DataFrame:
    """``term, item_key, place, alone``: the two rarest places of every window
    of every item, by corpus frequency.  Items with a window of one word have
    ``alone`` set.  Windows with a word the corpus lacks cannot occur."""
    places = stored(items.select("item_key", F.posexplode("words").alias("place", "term")), "places")
    vocabulary = stored(places.select("term").distinct(), "vocabulary")
    frequency = build_postings(docs, vocabulary).groupBy("term").agg(F.count(F.lit(1)).alias("tf"))
    ranked = (places.join(frequency, "term", "left")
              .groupBy("item_key").agg(F.sort_array(F.collect_list(F.struct(
                  "place", F.coalesce("tf", F.lit(0)).alias("tf"), "term"))).alias("at")))
    length = F.least(F.size("at"), F.lit(window))
    # equal windows of an item occur where the first of them does, at another shift
    said = _grams(F.transform("at", lambda x: x["term"]), F.sequence(F.lit(0), F.size("at") - length), length)
    starts = F.flatten(F.transform(F.array(said), lambda w: F.filter(
        F.sequence(F.lit(1), F.size(w)), lambda s: F.array_position(w, F.element_at(w, s)) == s)))
    by_rarity = F.transform(starts, lambda s: F.sort_array(F.transform(
        F.slice("at", s, length), lambda x: F.struct(x["tf"].alias("tf"), x["place"].alias("place"),
                                                     x["term"].alias("term")))))
    rare = F.flatten(F.transform(F.filter(by_rarity, lambda w: w[0]["tf"] > 0), lambda w: F.slice(w, 1, 2)))
    return (ranked.select("item_key", (F.size("at") == 1).alias("alone"), F.explode(F.array_distinct(rare)).alias("a"))
            .select("a.term", "item_key", "a.place", "alone"))


def _aligned(docs: DataFrame, items: DataFrame, window: int) -> DataFrame:
    """``doc_id, text_hash, item_key, shift`` where two anchors of an item, or the
    one word of an item, lie in a document at the same shift."""
    anchors = stored(_anchors(docs, items, window), "anchors")
    postings = stored(build_postings(docs, anchors.select("term").distinct()), "postings")
    return (postings.join(anchors, "term")
            .groupBy("doc_id", "text_hash", "item_key", (F.col("pos") - F.col("place")).alias("shift"))
            .agg(F.min("place").alias("low"), F.max("place").alias("high"), F.max("alone").alias("alone"))
            .where("low < high or alone").select("doc_id", "text_hash", "item_key", "shift"))


def mark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs(doc_id, text, ...)`` with ``__words`` (number of words), ``__hits``
    (positions inside an occurrence of a window, ascending) and ``__items`` (ids
    of items with occurring windows, sorted as strings).

    A window is ``window`` consecutive words of an item, or all words of a
    shorter one; items without words have none, NULL texts no words.  Every row
    comes back once, repeated rows too.
    """
    items = stored(_items(benchmark), "items")
    hits = _hits(docs, items, window)
    _, asked, rest = _fetched(docs, hits)
    joined = asked.join(hits, asked["doc_id"].eqNullSafe(hits["__id"]) & (asked["__key"] == hits["__hash"]), "left")
    columns = [*[F.col(f"`{c}`") for c in docs.columns],
               F.regexp_count(whole_text("text"), F.lit(ANY_CASE_WORD)).cast("long").alias("__words")]
    no_hits, no_items = F.array().cast("array<int>"), F.array().cast("array<string>")
    return joined.select(*columns, F.coalesce("__hits", no_hits).alias("__hits"),
                         F.coalesce("__items", no_items).alias("__items")
                         ).unionByName(rest.select(*columns, no_hits.alias("__hits"), no_items.alias("__items")))


def _fetched(docs: DataFrame, named: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``docs`` with its text hash ``__key``: all rows, those that may be named
    by ``named(__id, __hash)``, and the rest.  A row may be named if the slot of
    its hash is; slots are a table of at most ``SLOTS`` numbers whatever the
    input, so texts are shuffled for the named documents and few more."""
    slots = stored(named.select(F.pmod("__hash", F.lit(SLOTS)).cast("int").alias("__slot")).distinct(), "slots")
    here = docs.withColumn("__key", _hash()).withColumn("__at", F.pmod("__key", F.lit(SLOTS)).cast("int"))
    match = here["__at"] == slots["__slot"]
    return (here, here.join(F.broadcast(slots), match, "left_semi"),
            here.join(F.broadcast(slots), match, "left_anti"))


def _hits(docs: DataFrame, items: DataFrame, window: int) -> DataFrame:
    """``__id, __hash, __hits, __items`` of the documents in which a window
    occurs: blocks of positions named by aligned candidates, their windows
    compared with the item's word by word."""
    length = F.least(F.size("words"), F.lit(window))
    shapes = stored(items.select("item_key", "item_id", F.size("words").alias("size"), length.alias("length"),
                                 F.array_distinct(_grams(F.col("words"), F.sequence(F.lit(0), F.size("words") - length),
                                                         length)).alias("grams")), "shapes")
    # blocks in which a window of the item may begin, each once however many shifts name it
    first, last = F.greatest(F.lit(0), F.col("shift")), F.col("shift") + F.col("size") - F.col("length")
    blocks = (_aligned(docs, items, window).join(shapes.select("item_key", "size", "length"), "item_key")
              .where(last >= first)
              .select("doc_id", "text_hash", "item_key", F.explode(F.sequence(
                  F.floor(first / BLOCK).cast("int"), F.floor(last / BLOCK).cast("int"))).alias("block")).distinct())
    found = stored(blocks.groupBy("doc_id", "text_hash")
                   .agg(F.collect_list(F.struct("block", "item_key")).alias("named"))
                   .withColumnRenamed("doc_id", "__id").withColumnRenamed("text_hash", "__hash"), "aligned")
    _, asked, _ = _fetched(docs.select("doc_id", "text"), found)
    read = (asked.join(found, asked["doc_id"].eqNullSafe(found["__id"]) & (asked["__key"] == found["__hash"]))
            .dropDuplicates(["__id", "__hash"]))
    # a block's words are cut out beside the document's, which are made once and go no further
    near = F.flatten(F.transform(F.array(words_of(whole_text("text"), PLAIN_WORD)), lambda words: F.transform(
        "named", lambda c: F.struct(c["block"].alias("block"), c["item_key"].alias("item_key"), F.slice(
            words, c["block"] * BLOCK + 1, F.lit(BLOCK + window - 1)).alias("near")))))
    each = stored(read.select("__id", "__hash", F.explode(near).alias("b")).select("__id", "__hash", "b.*"), "blocks")
    cut = each.join(shapes.select("item_key", "item_id", "length", "grams"), "item_key")
    starts = F.when(F.size("near") >= F.col("length"), F.sequence(
        F.lit(0), F.least(F.lit(BLOCK - 1), F.size("near") - F.col("length")))).otherwise(F.array().cast("array<int>"))
    at = cut.withColumn("starts", F.filter(starts, lambda s: F.array_contains(
        "grams", F.array_join(F.slice("near", s + 1, F.col("length")), " "))))
    spans = F.flatten(F.transform("starts", lambda s: F.sequence(
        F.col("block") * BLOCK + s, F.col("block") * BLOCK + s + F.col("length") - 1)))
    return stored(at.where(F.size("starts") > 0).select("__id", "__hash", "item_id", F.explode(
        F.array_distinct(spans)).alias("p"))
        .groupBy("__id", "__hash").agg(F.sort_array(F.collect_set("p")).alias("__hits"),
                                       F.sort_array(F.collect_set("item_id")).alias("__items")), "hits")


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of docs: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    n_hit = F.size("__hits").cast("long")
    return mark(docs.select("doc_id", "text"), benchmark, window).select(
        "doc_id", F.col("__words").alias("n_words"), n_hit.alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.array_join("__items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the rows that hold a window of the benchmark."""
    return (mark(docs, benchmark, window).where(F.size("__hits") == 0)
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def proximity_matches(docs: DataFrame, queries: DataFrame, span: int) -> DataFrame:
    """``queries(item_id, text)`` -> ``doc_id, item_id, first, last``: places
    where all distinct terms of an item lie within ``span`` words, in any order;
    a match ends at its last word.  Items without words match nothing."""
    items = stored(_items(queries).select(
        "item_id", F.array_distinct("words").alias("terms")), "proximity-items")
    wanted = items.select("item_id", F.size("terms").alias("n_terms"), F.explode("terms").alias("term"))
    postings = stored(build_postings(docs, wanted.select("term").distinct()), "proximity-postings")
    at = postings.join(wanted, "term").distinct()
    near = (Window.partitionBy("doc_id", "text_hash", "item_id").orderBy("pos")
            .rangeBetween(-(span - 1), Window.currentRow))
    return (at.withColumn("terms", F.collect_set("term").over(near)).withColumn("first", F.min("pos").over(near))
            .where(F.size("terms") == F.col("n_terms"))
            .select("doc_id", "item_id", "first", F.col("pos").alias("last")))
