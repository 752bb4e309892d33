"""A key holding a third of all rows reaches its reducer pre-reduced.

The job runs in its own Spark process with an uncompressed event log; the
shuffle records read by each reduce task are taken from that log."""

from __future__ import annotations

import glob
import json
import os
import subprocess
import sys
import tempfile

from tests.skew_job import MAPS, ROWS

HERE = os.path.dirname(os.path.abspath(__file__))


def reduce_reads(log_dir: str) -> dict[str, list[int]]:
    """Shuffle records read per task, by job group, for stages that read a shuffle."""
    stage_group, reads = {}, {}
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if os.path.isdir(path) or path.endswith(".crc") or "appstatus" in path:
            continue
        for line in open(path, encoding="utf-8"):
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                g = e.get("Properties", {}).get("spark.jobGroup.id")
                for s in e["Stage IDs"]:
                    stage_group[s] = g
            elif e["Event"] == "SparkListenerTaskEnd":
                m = e.get("Task Metrics") or {}
                n = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                if n:
                    reads.setdefault(stage_group.get(e["Stage ID"]), []).append(n)
    return reads


def test_hot_key_is_reduced_before_the_shuffle():
    log_dir = tempfile.mkdtemp(prefix="strata-skew-")
    subprocess.run([sys.executable, os.path.join(HERE, "skew_job.py"), log_dir],
                   check=True, timeout=600, capture_output=True)
    reads = reduce_reads(log_dir)
    hot = ROWS // 3
    for group in ("dedupe", "count"):
        r = reads[group]
        # each map task forwards one row per key it saw (20,001 keys) ...
        assert sum(r) <= MAPS * 20_001, group
        # ... so the hot key's reducer reads about what the others read, far
        # below the 80,000 rows the hot key alone would bring unreduced
        assert max(r) < 1.3 * sum(r) / len(r), (group, r)
        assert max(r) < hot / 3, (group, r)
