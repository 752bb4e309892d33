"""Quarantine: a *copy* of the rows whose coordinate text is not numeric.

The flag is never NULL, so valid and invalid rows partition the input exactly;
invalid rows stay in bronze as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.numeric import is_float_text
from strata.sources.schemas import VALID_FLAG


def flag_validity(df: DataFrame, column: str = "longitude", flag: str = VALID_FLAG) -> DataFrame:
    return df.withColumn(flag, is_float_text(column))


def invalid_rows(flagged: DataFrame, flag: str = VALID_FLAG) -> DataFrame:
    return flagged.where(~F.col(flag))


def quarantine_of(df: DataFrame, column: str = "longitude", flag: str = VALID_FLAG) -> DataFrame:
    """Rows of ``df`` whose ``column`` is not numeric text, with ``flag`` = false."""
    return invalid_rows(flag_validity(df, column, flag), flag)
