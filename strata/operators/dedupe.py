"""Keyed dedupe that is deterministic and skew-safe.

``dropDuplicates(keys)`` keeps an arbitrary row per key.  Here the kept row is
the first by an explicit order, ties broken by every remaining column, so a
rerun writes the same table.

Plan: ``row_number() over (partition by keys order by ...) = 1``.  Catalyst turns
the rank filter into a *partial* ``WindowGroupLimit`` before the shuffle and a
final one after it, so each map task forwards at most one row per key.  A key
that holds a third of all rows therefore reaches its reducer as one row per map
task, never as the whole group.  The price is one local sort per map task,
paid even when duplicates are rare; Spark has no hash-based partial form of
"first row by an order" over string columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

_RANK = "__strata_rank"


def _orderable(t: DataType) -> bool:
    if isinstance(t, (MapType, VariantType)):
        return False
    if isinstance(t, ArrayType):
        return _orderable(t.elementType)
    if isinstance(t, StructType):
        return all(_orderable(f.dataType) for f in t.fields)
    return True


def tiebreak_columns(df: DataFrame, exclude: Iterable[str]) -> list[Column]:
    """Every orderable column not in ``exclude``, ascending, NULLs first."""
    skip = set(exclude)
    return [F.col(f.name).asc_nulls_first() for f in df.schema.fields
            if f.name not in skip and _orderable(f.dataType)]


def dedupe_by_key(df: DataFrame, keys: Sequence[str],
                  order: Sequence[Column | str] = (), ordered: Sequence[str] = (),
                  hash_first: bool = False) -> DataFrame:
    """One row per distinct ``keys`` value (all-NULL keys form one group).

    The row kept is the first by ``order`` (Column sort expressions, e.g.
    ``F.col('updated_at').desc_nulls_last()``), then by every other column
    ascending with NULLs first; ``ordered`` names columns that ``order`` already
    settles.  With ``hash_first`` rows are partitioned by (hash of the keys,
    keys): as exact, and long texts are compared by eight bytes first.  Map and variant columns cannot be ordered and
    take no part in the tie-break.
    """
    keys = list(keys)
    if not keys:
        raise ValueError("dedupe needs at least one key column")
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"key columns not found: {missing}")
    sort = [F.col(o) if isinstance(o, str) else o for o in order]
    named = [o for o in order if isinstance(o, str)]
    sort += tiebreak_columns(df, [*keys, *named, *ordered])
    parts = [F.xxhash64(*keys), *keys] if hash_first else keys
    w = Window.partitionBy(*parts).orderBy(*sort)
    return (df.withColumn(_RANK, F.row_number().over(w))
              .where(F.col(_RANK) == 1)
              .drop(_RANK))

