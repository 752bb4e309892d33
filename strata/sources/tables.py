"""Dated tables: ``<root>/date=YYYY-MM-DD/`` with one current version each.

* Reads always declare the schema (no inference from footers or directory
  names), so an empty or missing table still reads typed, a partition value such
  as ``007`` stays text, and a ``date`` predicate prunes partitions.
* A write makes a new version of exactly one date and publishes it when it is
  complete (:mod:`strata.sources.commits`): reruns of a date are idempotent,
  other dates are never touched, and a write that dies leaves the date as it was.
  Writing an empty frame empties the date (which is how a stale quarantine is
  cleared).  ``date`` is the only partition column; every other column, location
  and type included, stays a data column.
* Folders without a commit record (landed files, tables laid down by others) are
  read as they are.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.functions.dates import run_date as _run_date
from strata.sources.commits import (
    Commit,
    commits_of,
    current_versions,
    new_version,
    partition_path,
    path_exists,
    publish,
)
from strata.sources.schemas import DATE_COL


class MissingInputError(FileNotFoundError):
    """A job's input was never written, or its last write did not finish."""


def _missing_path(e: AnalysisException) -> bool:
    cond = getattr(e, "getCondition", None) or getattr(e, "getErrorClass", None)
    return (cond() if cond else None) == "PATH_NOT_FOUND"


def read_table(spark: SparkSession, root: str, schema: StructType,
               run_date: str | dt.date | None = None, fmt: str = "parquet",
               must_exist: bool = False) -> DataFrame:
    """The current versions of the table at ``root`` under ``schema`` (which
    includes ``date``), optionally pruned to one date.  A table or date never
    written reads as empty; with ``must_exist``, a date without a published
    version (or, where files lie without records, without ``_SUCCESS``) raises
    :class:`MissingInputError` instead.

    With a date, only that date's version is listed (``basePath`` keeps ``date``
    a partition column): on an object store holding years of daily partitions, a
    run never lists the other dates.
    """
    if run_date is not None:
        found = commits_of(spark, root, run_date)
        paths = [found[-1].path if found else partition_path(root, run_date)]
        known = bool(found)
    else:
        versions = current_versions(spark, root)
        known = any(versions.values())
        paths = [c.path if c else partition_path(root, d) for d, c in sorted(versions.items())] if known else [root]
    if must_exist and not known and not path_exists(spark, f"{paths[0].rstrip('/')}/_SUCCESS"):
        raise MissingInputError(f"no finished write found: {paths[0]}")
    reader = spark.read.schema(schema).format(fmt)
    try:
        df = reader.load(root) if paths == [root] else reader.option("basePath", root).load(paths)
    except AnalysisException as e:
        if not _missing_path(e):
            raise
        df = spark.createDataFrame([], schema)
    if run_date is not None:
        df = df.where(F.col(DATE_COL) == F.lit(_run_date(run_date)))
    return df


def stage_partition(df: DataFrame, root: str, run_date: str | dt.date, fmt: str = "parquet",
                    sort_within: Sequence[str] = (), max_records_per_file: int | None = None) -> str:
    """Write ``df`` as a new version of the ``run_date`` partition and return the
    version's name; nobody reads it before it is published.

    ``sort_within`` sorts rows inside each output file (row-group statistics
    then skip on those columns) without another shuffle.
    """
    version = new_version()
    out = df.drop(DATE_COL) if DATE_COL in df.columns else df
    if sort_within:
        out = out.sortWithinPartitions(*sort_within)
    writer = out.write.mode("errorifexists").format(fmt)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.save(f"{partition_path(root, run_date)}/{version}")
    return version


def write_partition(df: DataFrame, root: str, run_date: str | dt.date, fmt: str = "parquet",
                    sort_within: Sequence[str] = (), max_records_per_file: int | None = None,
                    record: dict | None = None) -> Commit:
    """Replace the ``run_date`` partition of the table at ``root`` with ``df``:
    a new version, published with ``record`` once it is complete."""
    version = stage_partition(df, root, run_date, fmt, sort_within, max_records_per_file)
    return publish(df.sparkSession, root, run_date, version, record or {})
