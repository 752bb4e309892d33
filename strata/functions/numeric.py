"""Numeric text: the validity test used to quarantine rows, and the lenient cast
used by silver.  Both are native Catalyst expressions (no Python UDF), so they
stay inside whole-stage codegen and do not block predicate pushdown.

The two rules differ on purpose: validity follows what a Python ``float()``
accepts, the cast follows Spark's own string-to-float rules.  For example
``'1_000'`` is valid but casts to NULL, and ``'1.5f'`` is invalid but casts to 1.5.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, FloatType

# The language of Python float() literals as a Java regex.
# (?U) makes \s and \d Unicode-aware, as float() is; letter classes are spelled
# out because a case-insensitive flag under (?U) would also accept dotless i.
# Decimal digits that Unicode 14/15 added (Kawi, Tangsa, Nag Mundari) are
# listed explicitly, so the rule does not depend on the JVM's Unicode version.
DIGIT = r"[\d\x{11F50}-\x{11F59}\x{16AC0}-\x{16AC9}\x{1E4F0}-\x{1E4F9}]"
_RUN = rf"{DIGIT}(?:_?{DIGIT})*"                 # digits, single '_' between
FLOAT_TEXT = (
    rf"(?U)^\s*[+-]?(?:(?:{_RUN}\.?(?:{_RUN})?|\.{_RUN})(?:[eE][+-]?{_RUN})?"
    r"|[iI][nN][fF](?:[iI][nN][iI][tT][yY])?|[nN][aA][nN])\s*$"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_float_text(c: Column | str) -> Column:
    """True iff the text parses as a Python float; NULL input gives False
    (never NULL, so valid/invalid partition the rows exactly)."""
    return F.coalesce(_col(c).rlike(FLOAT_TEXT), F.lit(False))


def lenient_float(c: Column | str, to: DataType | None = None) -> Column:
    """Cast text to a 32-bit float; unparsable text becomes NULL instead of
    failing the job (plain ``cast`` raises under ANSI mode)."""
    return _col(c).try_cast(to or FloatType())
