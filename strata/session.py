"""Session helpers: a local session for tests and the benchmark, and the shared
folder that writes of intermediate tables go to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session used by this library should carry.  The pipeline is
# rerun per date, so partition overwrite is dynamic by default; timestamps in
# the inputs are zone-less, so the session zone is pinned to UTC.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # partition values such as '007' must stay strings
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # the dedupe's pre-shuffle limit (WindowGroupLimit) needs this above 1;
    # it is what keeps a hot key from reaching one task whole
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
}


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app_name: str = "strata") -> SparkSession:
    """A local-mode session for tests and benchmarks (no UI, UTC, AQE on)."""
    cores = str(cores)
    parts = shuffle_partitions or (int(cores) if cores.isdigit() else os.cpu_count() or 8)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings of ``SESSION_DEFAULTS`` to a session
    built by someone else (a cluster launcher, the test driver)."""
    for key, value in SESSION_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def cluster_settings(input_bytes: int, total_cores: int,
                     shuffle_partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Launch settings for a cluster run over ``input_bytes`` of landed data.

    Shuffle partitions are sized so the largest stage (the silver dedupe,
    which shuffles about one copy of the records) gets ~128 MB per partition,
    never fewer than two waves of the cluster's cores; AQE then coalesces the
    small stages (gold, page counts) down to its advisory size.
    """
    parts = max(2 * total_cores, -(-input_bytes // shuffle_partition_bytes))
    return {
        **SESSION_DEFAULTS,
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(shuffle_partition_bytes),
        # coalesce to the advisory size, not to the cluster's parallelism
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        # the size check behind every broadcast: only sides estimated below it
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors and the driver can see.

    On a cluster this is ``spark.checkpoint.dir`` and must be set by whoever
    launches the job (an object-store or HDFS URI).  Only in local mode, when it
    is unset, a private temporary folder is created and registered as the
    checkpoint folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:          # a remote (Connect) session has no local context
        sc = None
    found = (sc.getCheckpointDir() if sc is not None else None) or \
        spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not master.startswith("local") or sc is None:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder shared by the cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="strata-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused sub-folder of :func:`shared_dir`."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
