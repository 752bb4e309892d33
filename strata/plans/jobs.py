"""The jobs: load bronze, transform silver, transform gold, and the chain.

Each job writes one date of a table and returns its metrics as a dict; a job
whose input date is not there, or was published by a run that failed its checks,
raises and changes nothing.  A table's commit record carries the metrics, whether
the landing was complete, and the version it was made from.  Metrics are collected
by the write itself (``observe`` in the result stage), or from Parquet footers, so
no job runs an extra pass just to count; a write that breaks a threshold is not
published.
"""

from __future__ import annotations

import datetime as dt
import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.dates import run_date as _run_date
from strata.operators.quality import check_null_rates, observed
from strata.operators.quarantine import flag_validity, invalid_rows
from strata.operators.report import gold_report, sample_rows
from strata.plans.layers import to_gold, to_silver
from strata.session import shared_dir
from strata.sources.commits import (
    FAILED,
    INCOMPLETE,
    OK,
    Commit,
    publish,
    require_input,
)
from strata.sources.landing import (
    LANDED_TABLE,
    page_counts,
    page_gap_ranges,
    page_report,
    read_landed,
)
from strata.sources.schemas import (
    BRONZE,
    CORRUPT,
    CORRUPT_COL,
    COUNT_COL,
    DATE_COL,
    FAULTS_COL,
    FAULTY,
    GAPS,
    GOLD,
    LOCATION_COL,
    PAGE_COL,
    QUARANTINE,
    SILVER,
    TYPE_COL,
    VALID_FLAG,
    without,
)
from strata.sources.tables import read_table, stage_partition, write_partition

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Layout:
    """Table roots; any Hadoop URI the session can write (``s3a://``, ``hdfs://``, ``file:``)."""

    landing: str
    bronze: str
    quarantine: str
    silver: str
    gold: str

    @property
    def corrupt_root(self) -> str:
        """Landed lines that hold no record."""
        return f"{self.quarantine.rstrip('/')}_lines"

    @property
    def faulty_root(self) -> str:
        """Records with a field that did not fit its declared type."""
        return f"{self.quarantine.rstrip('/')}_fields"

    @property
    def gaps_root(self) -> str:
        """Ranges of pages that did not land."""
        return f"{self.quarantine.rstrip('/')}_pages"

    @classmethod
    def under(cls, base: str) -> Layout:
        base = base.rstrip("/")
        return cls(*(f"{base}/{name}" for name in
                     ("landing", "bronze", "quarantine", "silver", "gold")))


class IncompleteLandingError(RuntimeError):
    """A landing with gaps, rows without a page, corrupt lines, fields that do not
    fit or too few pages."""


def _require(**settings: object) -> None:
    missing = [k for k, v in settings.items() if not v]
    if missing:
        raise ValueError(f"Required settings not set: {', '.join(missing)}")


def load_bronze(spark: SparkSession, layout: Layout, run_date: str | dt.date,
                on_gap: str = "report", expected_pages: int | None = None) -> dict:
    """Landed rows of ``run_date`` -> bronze (every record) + quarantine (copy of
    the rows whose longitude is not numeric) + corrupt (lines without a record)
    + faulty (copy of the records with a field that did not fit) + gaps (ranges
    of pages that did not land).

    The landing is parsed once, into bronze with its page numbers; pages, gaps
    and the quarantine are read from that Parquet, and only a landing with
    corrupt lines or faulty fields is parsed again, for those.  A page missing
    below the last one, rows without a page number, corrupt lines, faulty fields
    or fewer pages than ``expected_pages`` make the landing incomplete:
    ``metrics["complete"]`` is false and bronze's commit record says so.  With
    ``on_gap="fail"`` the record says that the run failed, which keeps silver from
    reading this date until a later run mends it, and
    :class:`IncompleteLandingError` is raised.  Nothing is ever left out.

    Bronze is published last, after the tables beside it.  Nothing is written when
    nothing landed.  The tables beside bronze are replaced even when empty, so a
    rerun never leaves stale rows.
    """
    _require(landing=layout.landing, bronze=layout.bronze, quarantine=layout.quarantine)
    if on_gap not in ("report", "fail"):
        raise ValueError(f"on_gap is 'report' or 'fail', not {on_gap!r}")
    d = _run_date(run_date)
    landed = read_landed(spark, layout.landing, d)
    metrics = {"date": d.isoformat()}
    if landed.isEmpty():
        log.warning("nothing landed for %s; bronze left as it is", d)
        return {**metrics, "rows": 0, "invalid": 0, "corrupt": 0, "faulty": 0, "written": False, "complete": False}

    bad_line, bad_field = F.col(CORRUPT_COL).isNotNull(), F.col(FAULTS_COL).isNotNull()
    seen, landed_obs = observed(landed, "landed", {
        "landed": F.count(F.lit(1)), "corrupt": F.count_if(bad_line), "faulty": F.count_if(bad_field)})
    records = seen.where(~bad_line).drop(CORRUPT_COL, FAULTS_COL, DATE_COL)
    flagged, obs = observed(flag_validity(records), "bronze", {
        "rows": F.count(F.lit(1)),
        "invalid": F.count_if(~F.col(VALID_FLAG)),
    })
    version = stage_partition(flagged.drop(VALID_FLAG), layout.bronze, d)
    metrics.update(obs.get, **landed_obs.get, written=True)
    staged = Commit(layout.bronze, d, 0, version)
    bronze = spark.read.schema(without(BRONZE, DATE_COL)).parquet(staged.path)

    if metrics["invalid"]:
        log.error("%s rows have a non-numeric longitude; copied to quarantine", metrics["invalid"])
        # few invalid rows spread over many bronze files: files of the advisory size
        bad = invalid_rows(flag_validity(bronze.drop(PAGE_COL))).hint("rebalance")
    else:
        bad = spark.createDataFrame([], without(QUARANTINE, DATE_COL))
    write_partition(bad, layout.quarantine, d, fmt="json")
    if metrics["corrupt"]:
        log.error("%s landed lines hold no record; kept under %s", metrics["corrupt"], layout.corrupt_root)
        lines = landed.where(bad_line).select(F.col(CORRUPT_COL).alias("line"))
    else:
        lines = spark.createDataFrame([], without(CORRUPT, DATE_COL))
    write_partition(lines, layout.corrupt_root, d)
    if metrics["faulty"]:
        log.error("%s records have fields that do not fit; kept under %s", metrics["faulty"], layout.faulty_root)
        faulty = landed.where(bad_field).drop(CORRUPT_COL, DATE_COL)
    else:
        faulty = spark.createDataFrame([], without(FAULTY, DATE_COL))
    write_partition(faulty, layout.faulty_root, d)

    shared_dir(spark)                  # checkpoint() below needs the shared folder
    counts = page_counts(bronze.select(PAGE_COL)).checkpoint()
    metrics.update(page_report(counts).first().asDict())
    short = metrics["last_page"] < (expected_pages or 0)
    if metrics["pages_missing"] or short:
        gaps = page_gap_ranges(counts, expected_pages if short else None)
    else:
        gaps = spark.createDataFrame([], without(GAPS, DATE_COL))
    write_partition(gaps, layout.gaps_root, d)
    metrics["complete"] = not (metrics["pages_missing"] or metrics["rows_without_page"] or metrics["corrupt"]
                               or metrics["faulty"] or short)
    failed = not metrics["complete"] and on_gap == "fail"
    reason = None if metrics["complete"] else f"landing of {d} is incomplete: {metrics}"
    publish(spark, layout.bronze, d, version, {
        "status": OK if metrics["complete"] else FAILED if failed else INCOMPLETE, "reason": reason, "metrics": metrics})
    if reason:
        log.error(reason)
    if failed:
        raise IncompleteLandingError(reason)
    return metrics


def _made_from(c: Commit | None) -> dict:
    """What a commit record says about its input: version and whether it was whole."""
    return {"input": c.version if c else None, "status": c.status if c else OK}


def transform_silver(spark: SparkSession, layout: Layout, run_date: str | dt.date) -> dict:
    """Bronze of ``run_date`` -> silver of ``run_date``.  A bronze date that was
    never finished, or whose run failed, raises, and silver stays as it is."""
    _require(bronze=layout.bronze, silver=layout.silver)
    d = _run_date(run_date)
    source = require_input(spark, layout.bronze, d)
    bronze = read_table(spark, layout.bronze, BRONZE, d, must_exist=True).drop(PAGE_COL)
    rows_in = bronze.count()          # answered from Parquet footers
    silver, obs = observed(to_silver(bronze, d), "silver", {"rows": F.count(F.lit(1))})
    version = stage_partition(silver, layout.silver, d, sort_within=[LOCATION_COL])
    metrics = {"date": d.isoformat(), "rows_in": rows_in, "rows_out": obs.get["rows"],
               "schema": silver.schema.simpleString()}
    publish(spark, layout.silver, d, version, {**_made_from(source), "metrics": metrics})
    return metrics


def transform_gold(spark: SparkSession, layout: Layout, run_date: str | dt.date,
                   max_null_fraction: float | None = None, sample: int = 5) -> dict:
    """Silver of ``run_date`` -> gold of ``run_date``.  A silver date that was
    never finished raises, and gold stays as it is.  The metrics carry the first
    ``sample`` rows of the written partition (0: none, and no read back).

    The NULL audit of the two keys is read off the groups themselves (NULL is
    a group of its own), inside the write: no separate pass.  With
    ``max_null_fraction`` set, a version that breaks the threshold is written, but
    not published: the run fails and the date's gold stays as it was.
    """
    _require(silver=layout.silver, gold=layout.gold)
    d = _run_date(run_date)
    source = require_input(spark, layout.silver, d)
    silver = read_table(spark, layout.silver, SILVER, d, must_exist=True)
    keys = [TYPE_COL, LOCATION_COL]
    n = F.col(COUNT_COL)
    gold, obs = observed(to_gold(silver, d), "gold", {
        "groups": F.count(F.lit(1)),
        "n_rows": F.coalesce(F.sum(n), F.lit(0)),
        f"nulls_{TYPE_COL}": F.coalesce(F.sum(F.when(F.col(TYPE_COL).isNull(), n)), F.lit(0)),
        f"nulls_{LOCATION_COL}": F.coalesce(F.sum(F.when(F.col(LOCATION_COL).isNull(), n)), F.lit(0)),
    })
    version = stage_partition(gold, layout.gold, d)
    metrics = {"date": d.isoformat(), **obs.get, "schema": gold.schema.simpleString()}
    check_null_rates(metrics, keys, max_null_fraction)      # raises before anything is published
    publish(spark, layout.gold, d, version, {**_made_from(source), "metrics": metrics})
    if sample:
        rows = sample_rows(read_gold(spark, layout, d).drop(DATE_COL), keys, sample)
        metrics["sample"] = [r.asDict() for r in rows.collect()]
    return metrics


def read_gold(spark: SparkSession, layout: Layout,
              run_date: str | dt.date | None = None) -> DataFrame:
    return read_table(spark, layout.gold, GOLD, run_date)


def register_views(spark: SparkSession, layout: Layout) -> list[str]:
    """Temp views ``landing``, ``bronze``, ``quarantine``, ``silver`` and ``gold``
    over all dates, under their declared schemas, for ad-hoc SQL; a ``date``
    predicate prunes partitions."""
    tables = {
        "landing": (layout.landing, LANDED_TABLE, "json"),
        "bronze": (layout.bronze, BRONZE, "parquet"),
        "quarantine": (layout.quarantine, QUARANTINE, "json"),
        "silver": (layout.silver, SILVER, "parquet"),
        "gold": (layout.gold, GOLD, "parquet"),
    }
    for name, (root, schema, fmt) in tables.items():
        read_table(spark, root, schema, fmt=fmt).createOrReplaceTempView(name)
    return list(tables)


def run(spark: SparkSession, layout: Layout, run_date: str | dt.date,
        max_null_fraction: float | None = None, on_gap: str = "report",
        expected_pages: int | None = None) -> tuple[DataFrame | None, dict]:
    """extract >> bronze >> silver >> gold for one date, then the report.

    Rerunning a date rewrites the same partitions and nothing else.  Returns the
    report DataFrame (lazy) and the metrics of every step; when nothing landed
    there is no report: the date's older gold is not this run's.
    """
    d = _run_date(run_date)
    metrics = {"bronze": load_bronze(spark, layout, d, on_gap, expected_pages)}
    if not metrics["bronze"]["written"]:
        return None, metrics
    metrics["silver"] = transform_silver(spark, layout, d)
    metrics["gold"] = transform_gold(spark, layout, d, max_null_fraction)
    return gold_report(spark, read_gold(spark, layout, d), d), metrics


__all__ = ["IncompleteLandingError", "Layout", "load_bronze", "read_gold", "register_views", "run",
           "transform_gold", "transform_silver"]
