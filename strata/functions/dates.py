"""Run dates: parsing the job argument, stamping it on rows, formatting it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.sources.schemas import DATE_COL

DATE_FORMAT = "yyyy-MM-dd"


def run_date(value: str | dt.date | dt.datetime) -> dt.date:
    """Normalise a run date argument; a datetime keeps only its day."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    if isinstance(value, str):
        return dt.date.fromisoformat(value.strip()[:10])
    raise ValueError(f"not a run date: {value!r}")


def date_literal(value: str | dt.date | dt.datetime) -> Column:
    return F.lit(run_date(value))


def stamp_date(df: DataFrame, value: str | dt.date | dt.datetime,
               column: str = DATE_COL) -> DataFrame:
    """Set ``column`` to the run date (DateType) on every row, once."""
    return df.withColumn(column, date_literal(value))


def day_label(c: Column | str) -> Column:
    """A date or timestamp as 'yyyy-MM-dd' text (the layout's path segment)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, DATE_FORMAT)
