"""The gold report and ordered samples."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from strata.functions.dates import run_date as _run_date
from strata.sources.schemas import COUNT_COL, DATE_COL, LOCATION_COL, TYPE_COL

REPORT_SQL = (
    "SELECT {keys}, {measure} FROM {{gold}} "
    "WHERE {date} = :run_date ORDER BY {keys}"
)


def gold_report(spark: SparkSession, gold: DataFrame, run_date: str | dt.date,
                keys: Sequence[str] = (TYPE_COL, LOCATION_COL),
                measure: str = COUNT_COL, date_col: str = DATE_COL) -> DataFrame:
    """``SELECT keys, measure FROM gold WHERE date = :run_date ORDER BY keys``.

    Run through Spark SQL with a bound parameter; over a date-partitioned table
    the date predicate becomes a partition filter.
    """
    text = REPORT_SQL.format(keys=", ".join(f"`{k}`" for k in keys),
                             measure=f"`{measure}`", date=f"`{date_col}`")
    return spark.sql(text, args={"run_date": _run_date(run_date)}, gold=gold)


def sample_rows(df: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows by ``keys`` (a ``TakeOrderedAndProject``: each task
    keeps its own top ``n``, so the driver merges ``n`` rows per task)."""
    return df.orderBy(*keys).limit(n)
