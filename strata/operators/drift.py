"""Metrics as a table, and drift against the dates before.

A metric is a whole number of one table, date and run; all sources of metrics
share the long shape ``table, metric, date, run, value``:

* :func:`date_metrics` counts many dates of a table in one grouped pass;
* ``strata.sources.metrics`` keeps such counts, a folder per run, and reads the
  metrics that the jobs leave in their commit records.

:func:`metric_drift` compares each date's newest run with the dates before it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

METRICS = StructType([
    StructField("table", StringType(), True),
    StructField("metric", StringType(), True),
    StructField("date", DateType(), True),
    StructField("run", LongType(), True),
    StructField("value", LongType(), True),
])

WINDOW = 7          # dates before that a value is compared with
LEAST = 3           # fewer than this say nothing
TOLERANCE = 3.0     # standard deviations
SLACK = 0.01        # of the mean: smaller changes are no drift, however even the dates before


def date_metrics(df: DataFrame, table: str, date: Column, checks: Mapping[str, Column], run: int = 1) -> DataFrame:
    """``rows`` of each date and, per check, the rows for which it holds (NULL:
    does not hold).  One partial/final aggregate for all dates and checks: one
    row per date and map task is shuffled.  Rows without a date form one of NULL."""
    names = ["rows", *checks]
    if len(set(names)) < len(names):
        raise ValueError(f"metric names repeat: {names}")
    counts = df.select(date.cast("date").alias("date"), *[c.alias(f"check_{i}") for i, c in enumerate(checks.values())])
    wide = counts.groupBy("date").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(f"check_{i}")).alias(f"n_{i}") for i in range(len(checks))])
    values = ["n", *[f"n_{i}" for i in range(len(checks))]]
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(v).alias("value"))
                                for m, v in zip(names, values)]))
    return wide.select("date", pairs.alias("m")).select(
        F.lit(table).alias("table"), "m.metric", "date", F.lit(run).cast("long").alias("run"), "m.value")


def newest_runs(metrics: DataFrame) -> DataFrame:
    """The value of the highest run of each table, metric and date; rows that a
    retried write repeats count once."""
    return (metrics.groupBy("table", "metric", "date")
            .agg(F.max(F.struct("run", "value")).alias("m"))
            .select("table", "metric", "date", "m.run", "m.value"))


def metric_drift(metrics: DataFrame, window: int = WINDOW, least: int = LEAST, tolerance: float = TOLERANCE,
                 slack: float = SLACK) -> DataFrame:
    """Each date's newest value beside the ``window`` dates of the same metric
    before it (dates that exist, not calendar days): ``table, metric, date, run,
    value, n_before, mean_before, drifted``.

    A value drifted if it lies more than ``tolerance`` standard deviations and
    more than ``slack`` of the mean from the mean before; ``drifted`` is NULL
    where fewer than ``least`` dates come before.  Sums are exact (decimals), so
    the verdict depends on no order of addition.  A window group is one metric's
    dates, a row each; metrics without a date or a value are left out.
    """
    w = Window.partitionBy("table", "metric").orderBy("date").rowsBetween(-window, -1)
    known = newest_runs(metrics.where(F.col("date").isNotNull() & F.col("value").isNotNull()))
    exact = F.col("value").cast("decimal(18,0)")
    seen = known.select("*", F.count(F.lit(1)).over(w).alias("n_before"),
                        F.sum(exact).over(w).alias("s"), F.sum(exact * exact).over(w).alias("q"))
    n, s, q, v = (F.col(c).cast("decimal(38,0)") for c in ("n_before", "s", "q", "value"))
    off = F.abs(n * v - s).cast("double")
    spread = F.sqrt(F.greatest(n * q - s * s, F.lit(0).cast("decimal(38,0)")).cast("double"))
    drifted = (off > F.lit(tolerance) * spread) & (off > F.lit(slack) * F.abs(s).cast("double"))
    return seen.select(
        "table", "metric", "date", "run", "value", "n_before",
        F.when(F.col("n_before") > 0, s.cast("double") / F.col("n_before").cast("double")).alias("mean_before"),
        F.when(F.col("n_before") >= least, drifted).alias("drifted"))
