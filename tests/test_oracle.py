"""Every registered query against its DuckDB SQL on sf0.01 (the driver's
correctness gate, run locally), plus the entry smoke check."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from strata.plans.catalog import QUERIES
from tests.conftest import SF01
from tests.oracle import compare, duck


@pytest.fixture(scope="module")
def results(spark):
    return compare(spark, SF01, list(QUERIES), con=duck(SF01))


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(results, name):
    r = results[name]
    assert name in E.oracle_sql(), "every query has an oracle"
    assert r["rows"] == r["oracle_rows"] and r["cols_match"] and r["values_match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["brewery_type", "localizacao", "quantity_of_breweries"]
    assert df.count() > 0


def test_report_is_ordered(spark):
    rows = [(r[0], r[1]) for r in E.queries()["dated_report"](spark, SF01).collect()]
    assert rows == sorted(rows)
    rows = [(r[0], r[1]) for r in E.queries()["medallion_end_to_end"](spark, SF01).collect()]
    assert rows == sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or ""))
