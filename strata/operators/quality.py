"""Data-quality contracts: required columns, NULL audits, invalid-row counts.

All counts of one table are taken in a single aggregate pass (``count_if`` per
column), never one job per column.  Metrics that should cost nothing extra ride
on a write through :func:`observed`.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

ROWS = "n_rows"
INVALID = "n_invalid"
NULLS_PREFIX = "nulls_"


class DataQualityError(ValueError):
    """A run breaks a data-quality threshold."""


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    """Plan-time check; a missing column raises ``ValueError``."""
    present = set(df.columns)
    for c in columns:
        if c not in present:
            raise ValueError(f"required column missing: {c}")


def null_count_exprs(columns: Sequence[str], prefix: str = NULLS_PREFIX) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(f"{prefix}{c}") for c in columns]


def null_audit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: ``n_rows`` and ``nulls_<col>`` for every column, one pass."""
    require_columns(df, columns)
    return df.agg(F.count(F.lit(1)).alias(ROWS), *null_count_exprs(columns))


def invalid_count(df: DataFrame, valid: Column) -> DataFrame:
    """One row: ``n_rows`` and ``n_invalid`` (rows where ``valid`` is false;
    a NULL verdict counts as invalid)."""
    return df.agg(F.count(F.lit(1)).alias(ROWS),
                  F.count_if(~F.coalesce(valid, F.lit(False))).alias(INVALID))


def observed(df: DataFrame, name: str, metrics: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """Attach metrics that are filled in by the next action on the result.

    Place it where the rows are final (above the last shuffle): metrics of a
    result stage are merged once per partition, even when tasks are retried.
    """
    obs = Observation(name)
    return df.observe(obs, *[expr.alias(key) for key, expr in metrics.items()]), obs


def check_null_rates(metrics: Mapping[str, int], columns: Sequence[str],
                     max_null_fraction: float | None = None,
                     rows_key: str = ROWS, prefix: str = NULLS_PREFIX) -> list[str]:
    """Log NULLs per column; raise when a fraction exceeds the threshold.

    ``max_null_fraction=None`` only warns (the historical behaviour).
    """
    total = int(metrics.get(rows_key) or 0)
    problems = []
    for c in columns:
        n = int(metrics.get(f"{prefix}{c}") or 0)
        if n:
            msg = f"{c}: {n} of {total} rows are NULL"
            log.warning(msg)
            if max_null_fraction is not None and total and n / total > max_null_fraction:
                problems.append(msg)
    if problems:
        raise DataQualityError("; ".join(problems))
    return problems
