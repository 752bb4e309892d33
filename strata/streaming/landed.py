"""Run the chain for every date that received new landed pages.

The original pipeline runs once a day on a timer.  Here the trigger is the
data: a file stream over the landing root (``availableNow``: process what
has landed, then stop, like a scheduled run) tracks in its checkpoint which
files were already seen.  Each micro-batch only contributes the *dates* its
new files belong to; every such date is rebuilt from its whole landing by the
batch jobs, which replace one date each.  A batch that is retried after a
failure rebuilds the same dates to the same result, so the output is
exactly-once even though the sink is plain files.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.plans import jobs
from strata.sources.landing import LANDED_TABLE
from strata.sources.schemas import DATE_COL

log = logging.getLogger(__name__)


def landed_dates(batch: DataFrame) -> list:
    """The distinct dates in a micro-batch (one row per calendar day)."""
    return sorted(r[0] for r in batch.select(DATE_COL).where(F.col(DATE_COL).isNotNull())
                  .distinct().collect())


def chain_for_new_pages(spark: SparkSession, layout: jobs.Layout, checkpoint: str,
                        max_null_fraction: float | None = None,
                        on_date: Callable[[object, dict], None] | None = None,
                        on_gap: str = "report") -> StreamingQuery:
    """Start the stream; returns the query (``awaitTermination()`` to wait).

    ``checkpoint`` must be a folder shared by the cluster (e.g. under
    ``spark.checkpoint.dir``); ``on_date(date, metrics)`` is called after each
    rebuilt date.  All that landed since the last run is one micro-batch, so
    each of its dates is rebuilt once.
    """
    pages = spark.readStream.schema(LANDED_TABLE).json(layout.landing).select(DATE_COL)

    def rebuild(batch: DataFrame, epoch: int) -> None:
        for d in landed_dates(batch):
            _, metrics = jobs.run(spark, layout, d, max_null_fraction, on_gap)
            log.info("epoch %s rebuilt %s: %s", epoch, d, metrics)
            if on_date:
                on_date(d, metrics)

    return (pages.writeStream.foreachBatch(rebuild)
                 .option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True)
                 .start())
