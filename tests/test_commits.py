"""Versions, commit records, the gate between the jobs, faulty fields, gap ranges."""

from __future__ import annotations

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from strata.plans import jobs
from strata.sources import commits
from strata.sources.landing import page_counts, page_gap_ranges, read_landed
from strata.sources.schemas import BRONZE, FAULTY, GAPS, GOLD, LANDED, SILVER, without
from strata.sources.tables import partition_path, read_table, stage_partition, write_partition
from tests.test_jobs import RECORDS, land

D1, D2 = dt.date(2024, 11, 27), dt.date(2024, 11, 28)


def gold(spark, *rows):
    return spark.createDataFrame(list(rows), without(GOLD, "date"))


def held(spark, root, day=None):
    return sorted(tuple(r) for r in read_table(spark, root, GOLD, day).collect())


def test_a_write_that_dies_leaves_the_old_date(spark, tmp_root):
    root = f"{tmp_root}/gold"
    write_partition(gold(spark, ("a", "x", 1), ("b", "y", 2)), root, D2)
    before = held(spark, root, D2)
    dies = spark.range(0, 4000, 1, 8).select(
        F.lit("c").alias("brewery_type"), F.col("id").cast("string").alias("localizacao"),
        F.when(F.col("id") == 3999, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("quantity_of_breweries"))
    with pytest.raises(Exception, match="lost"):
        write_partition(dies, root, D2)
    folder = partition_path(root, D2)
    assert sum(f.startswith("_v-") for f in os.listdir(folder)) == 2        # what it left behind
    assert held(spark, root, D2) == held(spark, root) == before
    # complete, but never published: not read either, and removed only when old
    stage_partition(gold(spark, ("z", "z", 9)), root, D2)
    assert held(spark, root, D2) == before
    assert commits.remove_orphans(spark, root, D2) == []
    assert len(commits.remove_orphans(spark, root, D2, older_than_hours=-1)) == 2
    assert held(spark, root, D2) == before
    write_partition(gold(spark, ("d", "q", 7)), root, D2)
    assert held(spark, root, D2) == [("d", "q", 7, D2)]


def test_dates_versions_and_foreign_files(spark, tmp_root):
    root = f"{tmp_root}/gold"
    for n in range(4):
        c = write_partition(gold(spark, ("a", "x", n)), root, D1, record={"metrics": {"n": n}})
        assert c.number == n + 1
    # a date laid down without records, as files
    gold(spark, ("f", "x", 5)).write.parquet(partition_path(root, D2))
    assert held(spark, root) == [("a", "x", 3, D1), ("f", "x", 5, D2)]
    assert held(spark, root, D2) == [("f", "x", 5, D2)]
    newest = commits.latest(spark, root, D1)
    assert newest.record["metrics"] == {"n": 3} and newest.status == commits.OK
    data = [f for f in os.listdir(partition_path(root, D1)) if f.startswith("_v-")]
    assert len(data) == commits.KEEP and newest.version in data
    assert len(commits.commits_of(spark, root, D1)) == 4                    # the records stay
    assert {d: c and c.number for d, c in commits.current_versions(spark, root).items()} == {D1: 4, D2: None}
    assert commits.latest(spark, root, D2) is None and commits.current_versions(spark, f"{root}/no") == {}
    df = read_table(spark, root, GOLD).where(F.col("date") == D1)
    assert df.count() == 1 and "PartitionFilters: [isnotnull(date" in df._jdf.queryExecution().toString()


def test_of_two_writers_one_wins_and_one_raises(spark, tmp_root, monkeypatch):
    root = f"{tmp_root}/gold"
    write_partition(gold(spark, ("a", "x", 0)), root, D1)
    early, late = (stage_partition(gold(spark, ("w", "x", k)), root, D1) for k in (1, 2))
    real, early, late = commits.commits_of, *sorted((early, late))
    stale = real(spark, root, D1)
    commits.publish(spark, root, D1, late, {})
    calls = []
    monkeypatch.setattr(commits, "commits_of", lambda *a: calls.append(1) or (stale if len(calls) == 1 else real(*a)))
    with pytest.raises(commits.ConcurrentPublishError):
        commits.publish(spark, root, D1, early, {})
    monkeypatch.undo()
    assert commits.commits_of(spark, root, D1)[-1].version == late


def test_a_failed_bronze_stops_silver_until_it_is_mended(spark, tmp_root):
    layout = jobs.Layout.under(tmp_root)
    land(spark, layout, D2, [r if r["page"] == 1 else {**r, "page": 3} for r in RECORDS])    # page 2 lost
    with pytest.raises(jobs.IncompleteLandingError):
        jobs.load_bronze(spark, layout, D2, on_gap="fail")
    assert read_table(spark, layout.bronze, BRONZE, D2).count() == len(RECORDS)    # nothing is left out
    record = commits.latest(spark, layout.bronze, D2).record
    assert record["status"] == commits.FAILED and record["metrics"]["first_gap"] == 2
    with pytest.raises(commits.FailedInputError, match="incomplete"):
        jobs.transform_silver(spark, layout, D2)
    assert read_table(spark, layout.silver, SILVER, D2).count() == 0
    gaps = read_table(spark, layout.gaps_root, GAPS, D2).collect()
    assert [tuple(r)[:3] for r in gaps] == [(2, 2, 1)]
    # reported, not failed: silver goes on and says what it was made from
    jobs.load_bronze(spark, layout, D2)
    jobs.transform_silver(spark, layout, D2)
    silver = commits.latest(spark, layout.silver, D2).record
    assert silver["status"] == commits.INCOMPLETE
    assert silver["input"] == commits.latest(spark, layout.bronze, D2).version
    land(spark, layout, D2, RECORDS)
    assert jobs.load_bronze(spark, layout, D2, on_gap="fail")["complete"]
    jobs.transform_silver(spark, layout, D2)
    jobs.transform_gold(spark, layout, D2)
    assert commits.latest(spark, layout.gold, D2).status == commits.OK
    assert read_table(spark, layout.gaps_root, GAPS, D2).count() == 0


def test_fields_that_do_not_fit_are_kept_with_their_text(spark, tmp_root):
    layout = jobs.Layout.under(tmp_root)
    path = partition_path(layout.landing, D2)
    os.makedirs(path)
    base = {k: v for k, v in RECORDS[0].items() if k != "tag_list"}
    given = {"text": "oops", "json text": '["a"]', "number": 5, "map": {"k": [1]}, "yes": True, "empty": "",
             "list": ["a", None, "b"], "mixed": [1, "a", 2.5], "none": None, "nothing": []}
    lines = [json.dumps({**base, "id": k, "tag_list": v}) for k, v in given.items()]
    lines += [json.dumps({**base, "id": "absent"}), json.dumps({**base, "id": "page", "page": "two"}),
              json.dumps({**base, "id": "scalars", "name": 5, "city": True, "state": 1.5}), json.dumps({"tag_list": "alone"}), "{broken"]
    with open(f"{path}/landed.json", "w") as f:
        f.write("\n".join(lines))
    rows = read_landed(spark, layout.landing, D2).collect()
    faults = {r.id: [tuple(x) for x in r.field_faults] for r in rows if r.field_faults}
    assert faults == {"text": [("tag_list", "oops")], "json text": [("tag_list", '["a"]')], "number": [("tag_list", "5")],
                      "map": [("tag_list", '{"k":[1]}')], "yes": [("tag_list", "true")], "empty": [("tag_list", "")],
                      "page": [("page", "two")], None: [("tag_list", "alone")]}
    tags = {r.id: r.tag_list for r in rows if r._corrupt_record is None}
    assert tags["list"] == ["a", None, "b"] and tags["mixed"] == ["1", "a", "2.5"]
    assert tags["none"] is None and tags["nothing"] == [] and tags["text"] is None and tags["absent"] is None
    scalars = next(r for r in rows if r.id == "scalars")
    assert (scalars.name, scalars.city, scalars.state) == ("5", "true", "1.5")
    m = jobs.load_bronze(spark, layout, D2)
    assert (m["landed"], m["rows"], m["faulty"], m["corrupt"], m["complete"]) == (15, 14, 8, 1, False)
    kept = read_table(spark, layout.faulty_root, FAULTY, D2)
    assert kept.count() == 8 and kept.where("id = 'map'").first().name == RECORDS[0]["name"]
    with pytest.raises(jobs.IncompleteLandingError):
        jobs.load_bronze(spark, layout, D2, on_gap="fail")
    land(spark, layout, D2, RECORDS)                     # a mended rerun clears the table
    assert jobs.load_bronze(spark, layout, D2)["faulty"] == 0
    assert read_table(spark, layout.faulty_root, FAULTY, D2).count() == 0


def brute_gaps(pages, expected=None):
    pages = sorted({p for p in pages if p is not None and p >= 1})
    ends = [0, *pages] + ([expected + 1] if expected is not None and (not pages or expected >= pages[-1]) else [])
    return [(a + 1, b - 1, b - a - 1) for a, b in zip(ends, ends[1:]) if b > a + 1]


SMALL = [([], None), ([], 7), ([1, 2, 3], 3), ([3], 9), ([None, 0, -4, 2], None), ([5, 5, 6], 6)]
WIDE = [(random.Random(1).sample(range(1, 1500), 900), 1700),
        ([1, 2, 2 ** 40, 2 ** 40 + 1, 2 ** 62 - 1, 70_000, 65_536, 65_535], None)]


@pytest.mark.parametrize("bits,cases", [(16, SMALL + WIDE), (8, WIDE)])
def test_all_ranges_of_missing_pages(spark, bits, cases):
    for pages, expected in cases:
        counts = page_counts(spark.createDataFrame([(p,) for p in pages], "page long"))
        got = page_gap_ranges(counts, expected, bits=bits)
        assert sorted(tuple(x) for x in got.collect()) == brute_gaps(pages, expected), (pages, expected)


def test_gap_ranges_take_no_window_over_all_pages(spark):
    counts = page_counts(spark.range(1, 5000).where("id % 9 != 4").select(F.col("id").alias("page")))
    plan = page_gap_ranges(counts)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" in plan
    assert LANDED.fieldNames()[-1] == "page"
