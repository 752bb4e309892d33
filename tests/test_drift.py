"""Metrics as a table: counts by date, runs, commit records, drift."""

from __future__ import annotations

import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from strata.operators.drift import METRICS, date_metrics, metric_drift, newest_runs
from strata.plans import jobs
from strata.plans.shapes import events_as_user_records, table
from strata.sources.landing import land_pages
from strata.sources.metrics import append_metrics, commit_metrics, read_metrics
from tests.conftest import SF01

D0 = dt.date(2024, 1, 1)


def day(i):
    return D0 + dt.timedelta(days=i)


def frame(spark, values, metric="rows", run=1, name="t"):
    return spark.createDataFrame([(name, metric, day(i), run, v) for i, v in enumerate(values)], METRICS)


def test_counts_by_date_count_every_row_once(spark):
    rows = [(day(0), 1), (day(0), None), (day(1), 5), (None, 7)]
    df = spark.createDataFrame(rows, "d date, x int")
    got = {(r.date, r.metric): r.value for r in date_metrics(
        df, "t", F.col("d"), {"big": F.col("x") > 2, "x_null": F.col("x").isNull()}).collect()}
    assert got == {(day(0), "rows"): 2, (day(0), "big"): 0, (day(0), "x_null"): 1,
                   (day(1), "rows"): 1, (day(1), "big"): 1, (day(1), "x_null"): 0,
                   (None, "rows"): 1, (None, "big"): 1, (None, "x_null"): 0}
    assert date_metrics(df.limit(0), "t", F.col("d"), {}).count() == 0
    with pytest.raises(ValueError, match="repeat"):
        date_metrics(df, "t", F.col("d"), {"rows": F.lit(True)})


def test_drift_is_that_of_the_statistics(spark):
    values = [100, 101, 99, 100, 102, 300, 100, 98, 0, 10**17, 100]
    got = {r.date: r for r in metric_drift(frame(spark, values), window=4, least=3, tolerance=2.0).collect()}
    assert len(got) == len(values)
    for i, v in enumerate(values):
        before, r = values[max(0, i - 4):i], got[day(i)]
        assert r.n_before == len(before)
        if not before:
            assert r.mean_before is None
        else:
            assert r.mean_before == pytest.approx(statistics.fmean(before))
        if len(before) < 3:
            assert r.drifted is None
        else:
            off = abs(v - statistics.fmean(before))
            assert r.drifted == (off > 2 * statistics.pstdev(before) and off > 0.01 * statistics.fmean(before)), i


def test_a_small_change_after_even_dates_is_no_drift(spark):
    got = {r.date: r.drifted for r in metric_drift(frame(spark, [1000, 1000, 1000, 1009, 1000, 1200])).collect()}
    assert got[day(3)] is False and got[day(5)] is True


def test_metrics_do_not_mix_and_nulls_are_left_out(spark):
    a, b = frame(spark, [5, 5, 5, 5]), frame(spark, [9, 9, 9, 90], metric="other")
    odd = spark.createDataFrame([("t", "rows", None, 1, 3), ("t", "rows", day(9), 1, None)], METRICS)
    got = {(r.metric, r.date): r.drifted for r in metric_drift(a.unionByName(b).unionByName(odd)).collect()}
    assert len(got) == 8 and got["rows", day(3)] is False and got["other", day(3)] is True
    assert metric_drift(spark.createDataFrame([], METRICS)).count() == 0


def test_a_rerun_replaces_its_own_rows_and_the_newest_run_counts(spark, tmp_path):
    root = f"file:{tmp_path}/metrics"
    append_metrics(frame(spark, [1, 2, 3]), root, 1)
    append_metrics(frame(spark, [1, 2, 3]), root, 1)
    assert read_metrics(spark, root).count() == 3
    append_metrics(frame(spark, [7, 8], run=99), root, 2)       # the folder says which run it is
    assert read_metrics(spark, root).count() == 5
    got = sorted((r.date, r.run, r.value) for r in newest_runs(read_metrics(spark, root)).collect())
    assert got == [(day(0), 2, 7), (day(1), 2, 8), (day(2), 1, 3)]


def test_commit_records_are_the_history_of_the_jobs(spark, tmp_path):
    layout = jobs.Layout.under(f"file:{tmp_path}/lake")
    assert commit_metrics(spark, layout.bronze, "bronze").count() == 0
    records = events_as_user_records(table(spark, SF01, "events"))
    said = {}
    for i, keep in ((0, 10), (1, 20), (0, 30)):
        land_pages(records.where(F.col("page") <= keep), layout.landing, day(i))
        said[day(i)] = jobs.load_bronze(spark, layout, day(i))
    got = commit_metrics(spark, layout.bronze, "bronze")
    assert got.schema.names == METRICS.names
    rows = {(r.date, r.run): r.value for r in got.where("metric = 'rows'").collect()}
    assert rows == {(day(0), 1): 500, (day(0), 2): said[day(0)]["rows"], (day(1), 1): said[day(1)]["rows"]}
    assert {r.metric for r in got.select("metric").distinct().collect()} >= {"rows", "invalid", "corrupt", "faulty", "landed"}
    assert got.where("metric in ('date', 'complete', 'written') or value is null").count() == 0
    drift = metric_drift(got.where("metric = 'rows'"), least=1).collect()
    assert sorted((r.date, r.run, r.n_before) for r in drift) == [(day(0), 2, 0), (day(1), 1, 1)]
