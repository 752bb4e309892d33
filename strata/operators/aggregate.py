"""Row count per group (the gold measure).

Planned as a partial ``HashAggregate`` on every map task, a hash exchange on the
group keys and a final ``HashAggregate``: each map task ships one bigint per
group it saw, so neither data volume nor a hot group reaches the shuffle whole.
NULL is a group of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.quality import require_columns
from strata.sources.schemas import COUNT_COL, LOCATION_COL, TYPE_COL


def group_count(df: DataFrame, keys: Sequence[str] = (TYPE_COL, LOCATION_COL),
                count_col: str = COUNT_COL) -> DataFrame:
    """``keys`` + ``count_col`` (bigint, not null), one row per key tuple."""
    keys = list(keys)
    require_columns(df, keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
