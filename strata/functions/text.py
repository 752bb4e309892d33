"""String expressions of the silver layer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.sources.schemas import LOCATION_SEP, PHONE_FILL


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fill_null(c: Column | str, value: str = PHONE_FILL) -> Column:
    """Replace NULL by ``value``; an empty string is kept as it is."""
    return F.coalesce(_col(c), F.lit(value))


def location_label(*parts: Column | str, sep: str = LOCATION_SEP) -> Column:
    """Join the non-NULL parts with ``sep``.  Never NULL: all parts NULL gives ''."""
    return F.concat_ws(sep, *[_col(p).cast("string") for p in parts])


def empty_to_null(c: Column | str) -> Column:
    """'' -> NULL (the gold layer reports a missing location as NULL)."""
    return F.nullif(_col(c), F.lit(""))
