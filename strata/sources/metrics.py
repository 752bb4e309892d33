"""Where metrics lie: a table with one folder per run, and the commit records.

``<root>/run=<n>/`` holds what one run measured.  A run writes its folder whole, so
a rerun replaces its own rows and adds no duplicates; other runs are not touched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.drift import METRICS
from strata.sources.commits import COMMITS, current_versions
from strata.sources.schemas import DATE_COL, without


def append_metrics(metrics: DataFrame, root: str, run: int) -> None:
    """Write ``metrics`` (any columns of :data:`METRICS`) as those of ``run``."""
    (metrics.select(*without(METRICS, "run").names).write.mode("overwrite")
     .option("partitionOverwriteMode", "static").parquet(f"{root.rstrip('/')}/run={int(run)}"))


def read_metrics(spark: SparkSession, root: str) -> DataFrame:
    """The metrics of all runs."""
    return spark.read.schema(METRICS).parquet(root).select(*METRICS.names)


def commit_metrics(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The whole-number metrics in a table's commit records, a row per date, run
    (the commit's number) and metric.  Records are only ever added, so this is
    the history of the jobs; they are read by tasks, not on the driver.  A table
    without records has none."""
    if not any(current_versions(spark, root).values()):
        return spark.createDataFrame([], METRICS)
    records = spark.read.text(f"{root.rstrip('/')}/{DATE_COL}=*/{COMMITS}/*.json", wholetext=True)
    value = F.col("value")
    fields = records.select(
        F.get_json_object("value", "$.date").try_cast("date").alias("date"),
        F.get_json_object("value", "$.number").cast("long").alias("run"),
        F.explode(F.from_json(F.get_json_object("value", "$.metrics"), "map<string,string>")).alias("metric", "value"))
    # a date or a schema among the metrics is no number, and a truth value is none either
    return fields.select(F.lit(table).alias("table"), "metric", "date", "run", value.try_cast("bigint").alias("value")).where(
        value.rlike(r"^-?\d{1,18}$"))
