"""Run in a subprocess by ``test_skew.py``: dedupe and group count over data in
which one key holds a third of all rows, with an uncompressed event log."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from strata.operators import dedupe_by_key, group_count  # noqa: E402

ROWS, MAPS = 240_000, 8


def main(log_dir: str) -> None:
    spark = (SparkSession.builder.master("local[4]").appName("skew")
             .config("spark.ui.enabled", "false")
             .config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", log_dir)
             .config("spark.eventLog.compress", "false")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.adaptive.enabled", "false")
             .getOrCreate())
    # key 0 holds a third of all rows; the rest are spread over 20k keys
    df = (spark.range(0, ROWS, 1, MAPS)
          .withColumn("k", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 20_000 + 1))
          .withColumn("v", F.col("id") * 7 % 1000)
          .withColumn("brewery_type", F.col("k").cast("string"))
          .withColumn("localizacao", F.lit("x")))
    spark.sparkContext.setJobGroup("dedupe", "dedupe")
    dedupe_by_key(df, ["k"], [F.col("v").desc()]).write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobGroup("count", "count")
    group_count(df).write.format("noop").mode("overwrite").save()
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])
