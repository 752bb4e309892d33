"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path


def _all_but(excluded: str) -> str:
    """Pattern of runs without the ``excluded`` characters, each listed on its
    own: Java tests listed characters by one table lookup, ranges one by one
    (13 times the seconds on the test documents)."""
    return "[^" + "".join(f"\\x{ord(c):02X}" for c in excluded) + "]+"


_ASCII = [chr(c) for c in range(128)]

# Word patterns of the contracts: runs without ASCII white space; runs of ASCII
# lower-case letters, digits and every non-ASCII character; the same with capitals.
SPACED_WORD = _all_but(" \t\n\v\f\r")
PLAIN_WORD = _all_but("".join(c for c in _ASCII if not (c.isdigit() or c.islower())))
ANY_CASE_WORD = _all_but("".join(c for c in _ASCII if not c.isalnum()))


def whole_text(c: str | Column = "text") -> Column:
    """The text as a string; NULL reads as empty."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """``c`` with A-Z lower-cased and every other character as it is.  All-ASCII
    texts take the fast ``lower``; the rest goes through ``translate``."""
    return (F.when(F.octet_length(c) == F.char_length(c), F.lower(c))
             .otherwise(F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def words_of(c: Column, pattern: str) -> Column:
    """All matches of ``pattern`` in the ASCII-lower-cased text, in order."""
    return F.regexp_extract_all(ascii_lower(c), F.lit(pattern), F.lit(0))


def fold(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus`` (a NULL id folds as '')."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(F.encode(F.coalesce(c.cast("string"), F.lit("")), "UTF-8")), F.lit(modulus))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: its lineage
    ends there (lost executors re-read files), and the planner knows its true
    size, so that Spark's own size check decides about broadcasts."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bounded_fit(rows: DataFrame, n_rows: int, bound: int, key: str | Column = "doc_id",
                seed: int = 20) -> DataFrame:
    """At most about ``bound`` of the ``n_rows`` labelled rows, chosen by a hash
    of their key, so that reruns and any partitioning choose the same rows."""
    if n_rows <= bound:
        return rows
    key = F.col(key) if isinstance(key, str) else key
    return rows.where(F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 30)) < int((1 << 30) * bound / n_rows))


def one_blas_thread() -> None:
    """Let numpy's matrix products in this process run on one thread.  A task has
    one core; threads that wait for each other over small products only burn CPU
    (twice the seconds with two).  Where no OpenBLAS is found, nothing happens."""
    try:
        with open("/proc/self/maps") as f:
            found = set(re.findall(r"/\S*openblas\S*", f.read()))
    except OSError:
        return
    for path in found:
        lib = ctypes.CDLL(path)
        for name in ("scipy_openblas_set_num_threads64_", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            if hasattr(lib, name):
                getattr(lib, name)(1)
                break
