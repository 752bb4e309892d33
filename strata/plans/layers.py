"""Pure layer transforms: DataFrame in, DataFrame out, no I/O, no actions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.dates import stamp_date
from strata.functions.numeric import lenient_float
from strata.functions.text import empty_to_null, fill_null, location_label
from strata.operators.aggregate import group_count
from strata.operators.dedupe import dedupe_by_key
from strata.operators.quality import require_columns
from strata.sources.schemas import (
    COUNT_COL,
    KEY,
    LOCATION_COL,
    RECORD_FIELDS,
    TYPE_COL,
)


def to_silver(bronze: DataFrame, run_date: str | dt.date | None = None) -> DataFrame:
    """Dedupe on ``id`` keeping the newest ``updated_at``; phone NULL -> 'N/A';
    coordinates text -> float (unparsable -> NULL); ``localizacao`` =
    'city, state' unless the input already has one; stamp the run date."""
    require_columns(bronze, [KEY, "updated_at", "phone", "longitude", "latitude", "city", "state"])
    df = bronze.drop("date") if "date" in bronze.columns else bronze
    df = dedupe_by_key(df, [KEY], [F.col("updated_at").desc_nulls_last()], ordered=["updated_at"])
    derived = {"phone": fill_null("phone"),
               **{c: lenient_float(c) for c in ("longitude", "latitude")}}
    if LOCATION_COL not in df.columns:
        derived[LOCATION_COL] = location_label("city", "state")
    df = df.withColumns(derived)
    ordered = [c for c in RECORD_FIELDS if c in df.columns]
    df = df.select(*ordered, *[c for c in df.columns if c not in ordered])
    return stamp_date(df, run_date) if run_date is not None else df


def to_gold(silver: DataFrame, run_date: str | dt.date | None = None,
            type_col: str = TYPE_COL, location_col: str = LOCATION_COL) -> DataFrame:
    """Rows per (type, location); an empty location counts as NULL."""
    require_columns(silver, [type_col, location_col])
    gold = group_count(
        silver.select(type_col, empty_to_null(location_col).alias(location_col)),
        [type_col, location_col], COUNT_COL)
    return stamp_date(gold, run_date) if run_date is not None else gold
