"""Dedupe, group count, quality metrics, quarantine split, report, sample."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import (
    DataQualityError,
    check_null_rates,
    dedupe_by_key,
    gold_report,
    group_count,
    invalid_count,
    null_audit,
    quarantine_of,
    require_columns,
    sample_rows,
)
from strata.operators.quarantine import flag_validity
from tests.plans import plan


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_dedupe_keeps_newest_and_collapses_null_keys(spark):
    df = spark.createDataFrame([
        ("a", "2024-01-01", "old"), ("a", "2024-02-01", "new"), ("a", None, "none"),
        (None, "2024-01-01", "n1"), (None, "2024-03-01", "n2"), ("b", "2024-01-01", "only"),
    ], "id string, updated_at string, payload string")
    out = dedupe_by_key(df, ["id"], [F.col("updated_at").desc_nulls_last()])
    assert rows(out.select("id", "payload").fillna("~", ["id"])) == [
        ("a", "new"), ("b", "only"), ("~", "n2")]


def test_dedupe_is_deterministic_on_full_ties(spark):
    df = spark.createDataFrame([("k", 2, "y"), ("k", 2, "x"), ("k", 1, "z")],
                               "k string, v int, w string")
    out = dedupe_by_key(df.repartition(3), ["k"], [F.col("v").desc()])
    assert rows(out) == [("k", 2, "x")]


def test_dedupe_idempotent(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    keys = ["l_orderkey", "l_linenumber"]
    once = dedupe_by_key(li, keys, [F.col("l_shipdate").desc_nulls_last()])
    twice = dedupe_by_key(once, keys, [F.col("l_shipdate").desc_nulls_last()])
    assert once.count() == twice.count() == li.select(*keys).distinct().count()
    assert once.exceptAll(twice).count() == 0


def test_dedupe_plan_limits_before_shuffle(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    lines = plan(dedupe_by_key(li, ["l_orderkey"], []), "simple").splitlines()
    at = {k: next(i for i, ln in enumerate(lines) if k in ln)
          for k in ("WindowGroupLimit", "Exchange", "Partial")}
    final = next(i for i, ln in enumerate(lines) if "WindowGroupLimit" in ln and "Final" in ln)
    # tree order, top-down: Final limit above the exchange, partial limit below it
    assert final < at["Exchange"] < at["Partial"]


def test_dedupe_rejects_missing_key(spark):
    with pytest.raises(ValueError):
        dedupe_by_key(spark.range(1), ["nope"])


def test_group_count_null_is_a_group(spark):
    df = spark.createDataFrame([("micro", "A"), ("micro", "A"), (None, "A"), ("closed", None)],
                               "brewery_type string, localizacao string")
    out = group_count(df)
    assert out.schema["quantity_of_breweries"].dataType.typeName() == "long"
    assert sorted(out.collect(), key=str) == sorted(
        [("micro", "A", 2), (None, "A", 1), ("closed", None, 1)], key=str)
    text = plan(out)
    assert text.count("HashAggregate") >= 2 and "partial_count" in text


def test_require_columns(spark):
    with pytest.raises(ValueError, match="localizacao"):
        require_columns(spark.range(1), ["localizacao"])
    with pytest.raises(ValueError):
        group_count(spark.range(1).withColumnRenamed("id", "brewery_type"))


def test_null_audit_one_pass(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    r = null_audit(df, ["a", "b"]).first().asDict()
    assert r == {"n_rows": 3, "nulls_a": 1, "nulls_b": 2}
    assert check_null_rates(r, ["a", "b"]) == []
    with pytest.raises(DataQualityError):
        check_null_rates(r, ["a", "b"], max_null_fraction=0.5)


def test_quarantine_is_a_copy(spark):
    df = spark.createDataFrame([("1", "1.5"), ("2", "abc"), ("3", None), ("4", "-97.4")],
                               "id string, longitude string")
    bad = quarantine_of(df)
    assert rows(bad.select("id")) == [("2",), ("3",)]
    assert set(bad.columns) == {"id", "longitude", "is_valid_longitude"}
    flagged = flag_validity(df)
    assert flagged.where("is_valid_longitude").count() + bad.count() == df.count()
    r = invalid_count(df, F.col("longitude").rlike("^[0-9.-]+$")).first()
    assert (r.n_rows, r.n_invalid) == (4, 2)


def test_report_orders_and_filters_by_date(spark):
    gold = spark.createDataFrame([
        ("micro", "B", 3, dt.date(2024, 11, 28)), ("brewpub", "Z", 1, dt.date(2024, 11, 28)),
        ("micro", "A", 2, dt.date(2024, 11, 28)), ("micro", "A", 9, dt.date(2024, 11, 27)),
    ], "brewery_type string, localizacao string, quantity_of_breweries long, date date")
    out = gold_report(spark, gold, "2024-11-28").collect()
    assert [tuple(r) for r in out] == [("brewpub", "Z", 1), ("micro", "A", 2), ("micro", "B", 3)]
    s = sample_rows(gold, ["brewery_type", "localizacao"], 2).collect()
    assert [(r.brewery_type, r.localizacao) for r in s] == [("brewpub", "Z"), ("micro", "A")]
