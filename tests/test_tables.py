"""Dated table layout: typed reads, one-date overwrites, rerun safety."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from strata.sources.commits import latest
from strata.sources.schemas import GOLD, QUARANTINE, without
from strata.sources.tables import partition_path, read_table, write_partition
from tests.plans import plan

D1, D2 = dt.date(2024, 11, 27), dt.date(2024, 11, 28)


def gold_rows(spark, rows):
    return spark.createDataFrame(rows, without(GOLD, "date"))


def test_missing_table_reads_empty_and_typed(spark, tmp_root):
    df = read_table(spark, f"{tmp_root}/never", GOLD, D1)
    assert df.count() == 0 and df.schema["date"].dataType.typeName() == "date"


def test_write_replaces_one_date_only(spark, tmp_root):
    root = f"{tmp_root}/gold"
    write_partition(gold_rows(spark, [("micro", "A", 1)]), root, D1)
    write_partition(gold_rows(spark, [("micro", "B", 2), ("bar", "C", 3)]), root, D2)
    write_partition(gold_rows(spark, [("micro", "B", 5)]), root, D2)   # rerun of D2
    write_partition(gold_rows(spark, [("micro", "B", 5)]), root, D2)   # and again
    got = sorted(tuple(r) for r in read_table(spark, root, GOLD).collect())
    assert got == [("micro", "A", 1, D1), ("micro", "B", 5, D2)]
    assert os.path.isdir(partition_path(root, D1).replace("file:", ""))


def test_empty_write_clears_a_date(spark, tmp_root):
    root = f"{tmp_root}/q"
    schema = without(QUARANTINE, "date")
    row = ["x"] * 13 + [["t"], False]
    write_partition(spark.createDataFrame([row], schema), root, D1, fmt="json")
    write_partition(spark.createDataFrame([row], schema), root, D2, fmt="json")
    write_partition(spark.createDataFrame([], schema), root, D2, fmt="json")
    df = read_table(spark, root, QUARANTINE, fmt="json")
    assert [r.date for r in df.collect()] == [D1]


def test_numeric_looking_values_stay_text(spark, tmp_root):
    root = f"{tmp_root}/g"
    write_partition(gold_rows(spark, [("micro", "007", 1), ("micro", "", 1)]), root, D1)
    got = sorted(r.localizacao for r in read_table(spark, root, GOLD, D1).collect())
    assert got == ["", "007"]


def test_date_predicate_prunes_partitions(spark, tmp_root):
    root = f"{tmp_root}/g"
    write_partition(gold_rows(spark, [("micro", "A", 1)]), root, D1)
    write_partition(gold_rows(spark, [("micro", "A", 1)]), root, D2)
    df = read_table(spark, root, GOLD, D2).select("brewery_type")
    text = plan(df)
    assert "PartitionFilters: [isnotnull(date" in text and "2024-11-28" in text
    # only the date's folder is listed, not the table root
    assert "InMemoryFileIndex [" in text and "/g/date=2024-11-28/_v-" in text
    assert "ReadSchema: struct<brewery_type:string>" in text
    assert df.count() == 1


def test_sort_within_keeps_rows(spark, tmp_root):
    root = f"{tmp_root}/s"
    df = spark.range(1000).select(F.col("id").cast("string").alias("localizacao"))
    write_partition(df, root, D1, sort_within=["localizacao"], max_records_per_file=300)
    path = latest(spark, root, D1).path
    back = spark.read.parquet(path)
    assert back.count() == 1000 and len([f for f in os.listdir(path)
                                          if f.endswith(".parquet")]) >= 4
