"""Plan checks over every registered query (sf0.001): the shapes that matter
at scale, asserted on the plans Spark actually picks."""

from __future__ import annotations

import pytest

from strata.plans.catalog import QUERIES
from tests.conftest import SF001
from tests.plans import plan

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct",
             "BroadcastNestedLoopJoin")


@pytest.fixture(scope="module")
def plans(spark):
    out = {}
    for name, q in QUERIES.items():
        df = q(spark, SF001)
        df.write.format("noop").mode("overwrite").save()    # final adaptive plan
        out[name] = plan(df, "formatted") + plan(df, "simple")
    return out


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_python_no_cross_join(plans, name):
    for bad in FORBIDDEN:
        assert bad not in plans[name], (name, bad)


def test_scans_are_pruned(plans):
    assert "ReadSchema: struct<p_brand:string,p_type:string,p_size:int>" in plans["group_count"]
    assert "ReadSchema: struct<doc_id:bigint>" in plans["null_audit"]
    assert "ReadSchema: struct<url:string>" in plans["invalid_count"]


def test_report_reads_its_date_only(plans):
    p = plans["dated_report"]
    assert "PartitionFilters: [isnotnull(date" in p and "2024-01-10" in p


def test_date_reads_prune_partitions(plans):
    for name in ("sink_round_trip", "medallion_end_to_end", "bronze_quarantine"):
        assert "PartitionFilters: [isnotnull(date" in plans[name], name


def test_aggregates_are_partial_before_the_shuffle(plans):
    for name in ("group_count", "null_audit", "invalid_count"):
        p = plans[name]
        assert "partial_count" in p and "HashAggregate" in p, name


def test_dedupes_limit_before_the_shuffle(plans):
    for name in ("dedupe_by_key", "dedupe_text", "silver_layer"):
        assert "WindowGroupLimit" in plans[name] and "Partial" in plans[name], name


def test_sample_is_take_ordered(plans):
    assert "TakeOrderedAndProject" in plans["sample_rows"]


def test_one_shuffle_per_layer(spark):
    from strata.plans.layers import to_gold, to_silver
    from strata.plans.shapes import pages_as_records, part_as_entities, table

    silver = to_silver(pages_as_records(table(spark, SF001, "pages")).drop("page"), "2024-11-28")
    gold = to_gold(part_as_entities(table(spark, SF001, "part")), "2024-11-28")
    for df in (silver, gold):
        text = plan(df, "simple")
        assert text.count("Exchange ") == 1, text
