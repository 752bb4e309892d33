"""The corpus pipeline: documents from raw to mixed, five stages in order.

Every stage is a function of (spark, docs, sf_dir).  A stage's result is written
as Parquet to the shared folder and read again as the next one's ``docs``, so a
lost executor costs at most the stage at work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontaminate, mixing, pii, simhash, toxicity
from strata.llm.common import fold, stored, table

SHINGLE, MAX_BITS = 3, 3        # of the near-duplicate operator's contract


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.  It learns from labelled rows
    of `documents` as its own query does, whatever ``docs`` holds."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").hint("merge")    # grows with the documents
    labelled = (table(spark, sf_dir, "documents").select("doc_id", "text").join(labels, "doc_id")
                .where(fold("doc_id", 5) != 0))
    return toxicity.reject_toxic(docs, labelled)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash.deduplicate(docs, max_bits=MAX_BITS, shingle=SHINGLE)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes pseudonyms; ``n_chars`` follows the text where it changed."""
    out = pii.pseudonymise(docs, counts="__replaced")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__replaced") > 0, F.char_length("text").cast("long"))
                             .otherwise(F.col("n_chars")))
    return out.drop("__replaced")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, with ``copies`` and ``taken`` words."""
    return mixing.apply_mix(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("mixing", mixing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


ORACLE_SQL = None       # fingerprints and the classifier are beyond SQL; tested by brute force
