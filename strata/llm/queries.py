"""Registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import (
    cascade,
    decontaminate,
    langid,
    licenses,
    logbilinear,
    mixing,
    pii,
    runs,
    simhash,
    syncmers,
    toxicity,
    warc,
    whitening,
)
from strata.llm.common import SPACED_WORD, fold, table, whole_text
from strata.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def labelled_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Labels grow with the documents: a merge join at every size."""
    labels = table(spark, sf, "labels").select("doc_id", "toxic").hint("merge")
    return table(spark, sf, "documents").select("doc_id", "text").join(labels, "doc_id")


def op1_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    model = toxicity.fit(labelled_documents(spark, sf).where(fold("doc_id", 5) != 0))
    scored = table(spark, sf, "documents").select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), toxicity.score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op2_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(table(spark, sf, "documents"))


def op3_pii_pseudonyms(spark: SparkSession, sf: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf, "documents").select("doc_id", "text"), counts="n_replaced")


def op4_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents")).drop("uid")


def op5_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.report(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op6_syncmer_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return syncmers.fingerprints(table(spark, sf, "documents"))


def op7_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(fold("doc_id", 4) != 2))
    found = langid.identify(model, F.col("text"))
    return (docs.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), found.alias("found"))
            .select("doc_id", "held_out", "found.lang_pred", "found.score"))


def op8_simhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents"), max_bits=3, shingle=3).select(
        "doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op9_warc_revisits(spark: SparkSession, sf: str) -> DataFrame:
    return warc.deduplicated_archive(table(spark, sf, "pages"), scratch_path(spark, "warc"))


def op10_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    scored = logbilinear.score_documents(docs, docs.where(fold("doc_id", 5) != 1))
    return scored.select("doc_id", (fold("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known",
                         "train_tokens", "base_score", "score")


def op11_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", F.regexp_extract_all(
        whole_text("text"), F.lit(SPACED_WORD), F.lit(0)).alias("words"))
    # the contract's texts: in one document of ten the words from the a-th on repeat with period p
    h, n = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.size("words")
    g = F.floor(h / 10)
    a = F.col("g") % F.col("n")
    p = F.lit(1) + F.floor((F.col("n") - F.col("a")) / (F.lit(3) + F.col("g") % 8))
    rest = F.col("n") - F.col("a")
    copies = F.flatten(F.array_repeat(F.slice("words", (F.col("a") + 1).cast("int"), F.col("p").cast("int")),
                                      F.ceil(rest / F.col("p")).cast("int")))
    planted = F.concat(F.slice("words", F.lit(1), F.col("a").cast("int")),
                       F.slice(copies, F.lit(1), rest.cast("int")))
    docs = (docs.withColumns({"h": h, "g": g, "n": n.cast("long")})
            .withColumn("a", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), a))
            .withColumn("p", F.when(F.col("a").isNotNull(), p))
            .select("doc_id", F.when(F.col("a").isNotNull(), planted).otherwise(F.col("words")).alias("words")))
    found = runs.find_runs(docs)
    # greatest length, then smallest start, then smallest period
    best = F.element_at(F.sort_array(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period"),
        r["length"].alias("length")))), 1)
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(
        ",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit(""))
    return found.withColumn("best", F.when(F.size("runs") > 0, best)).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op12_quality_cascade(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    rules = cascade.ordered(cascade.RULES, cascade.estimate(docs))
    judged = cascade.cascade(docs, rules, measures=list(cascade.MEASURES))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return judged.select("doc_id", *cascade.MEASURES, failed.alias("base_failed"),
                         (F.col("kept") & ~failed).alias("kept"))


def op13_embedding_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whitened_components(table(spark, sf, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_license_scan": op2_license_scan,
    "op3_pii_pseudonyms": op3_pii_pseudonyms,
    "op4_mixing": op4_mixing,
    "op5_decontamination": op5_decontamination,
    "op6_syncmer_fingerprints": op6_syncmer_fingerprints,
    "op7_language_id": op7_language_id,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_warc_revisits": op9_warc_revisits,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_quality_cascade": op12_quality_cascade,
    "op13_embedding_whitening": op13_embedding_whitening,
    "pipeline": corpus_pipeline.run,
}

# Queries that SQL can express; the others are tested by brute force.
_WORDS = r"regexp_extract_all(coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_TYPE = "octet_length(encode(html)) >= 100 AND page_id <> first_id"

ORACLE: dict[str, str] = {
    "op5_decontamination": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS gram
        FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
phrases AS (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS gram
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, item_id, s, p.n FROM phrases p JOIN win USING (gram) WHERE p.n = win.n),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
        FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)""",
    "op9_warc_revisits": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first_id FROM p)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest,
       CASE WHEN {_TYPE} THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN {_TYPE} THEN first_id END AS refers_to
FROM f""",
    # every rule of the cascade, as its order does not change what is kept
    "op12_quality_cascade": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
           FROM documents),
k AS (SELECT row_number() OVER () AS k, * FROM d),
win AS (SELECT k, s, array_to_string(w[s:s + 4], ' ') AS gram
        FROM (SELECT k, w, unnest(range(1, len(w) - 3)) AS s FROM k WHERE len(w) >= 5)),
twice AS (SELECT k, s FROM (SELECT k, s, count(*) OVER (PARTITION BY k, gram) AS c FROM win) WHERE c > 1),
rep AS (SELECT k, count(DISTINCT p) AS n FROM (SELECT k, unnest(range(s, s + 5)) AS p FROM twice) GROUP BY k),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
        CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
        len(list_filter(w, lambda x: regexp_matches(x, '\p{Lu}') AND NOT regexp_matches(x, '\p{Ll}'))) AS capitals,
        length(t) - length(replace(t, '!', '')) AS marks
      FROM k LEFT JOIN rep USING (k)),
v AS (SELECT *, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
       OR 10 * n_dup_lines > 3 * len(lines) OR 10 * capitals > 5 * n_words OR 10 * marks > 3 * n_words) AS kept
FROM v""",
}
