"""Landed pages: declared-schema parsing, page numbers, gaps, broken lines."""

from __future__ import annotations

import datetime as dt
import json
import os

from pyspark.sql.types import LongType, StructField, StructType

from strata.sources.landing import PACKS, land_packed, page_counts, page_report, read_landed
from strata.sources.schemas import RECORD
from strata.sources.tables import partition_path

D = dt.date(2024, 11, 28)


def land_raw(root, pages: dict[int, list[dict]]):
    path = partition_path(root, D)
    os.makedirs(path, exist_ok=True)
    for n, recs in pages.items():
        with open(f"{path}/page-{n:05d}.json", "w") as f:
            for r in recs:
                f.write(json.dumps({**r, "page": n}) + "\n")


def rec(i, **kw):
    return {"id": str(i), "name": f"n{i}", "longitude": "1.5", **kw}


def test_gap_is_reported_and_drops_nothing(spark, tmp_root):
    land_raw(tmp_root, {1: [rec(1), rec(2)], 2: [rec(3)], 4: [rec(4), rec(5), rec(6)],
                        5: [rec(7)]})
    landed = read_landed(spark, tmp_root, D)
    assert sorted(r.id for r in landed.collect()) == list("1234567")
    r = page_report(page_counts(landed)).first().asDict()
    assert r == {"first_gap": 3, "pages_present": 4, "pages_missing": 1, "last_page": 5,
                 "rows_total": 7, "rows_without_page": 0}


def test_missing_first_page(spark, tmp_root):
    land_raw(tmp_root, {2: [rec(1)], 3: [rec(2)]})
    landed = read_landed(spark, tmp_root, D)
    r = page_report(page_counts(landed)).first()
    assert (r.first_gap, r.pages_missing, r.rows_total) == (1, 1, 2)


def test_page_numbers_of_any_form(spark, tmp_root):
    path = partition_path(tmp_root, D)
    os.makedirs(path)
    with open(f"{path}/records.json", "w") as f:
        for i, page in enumerate([3000000000, "2", 2.0, None, "two", 1.5]):
            f.write(json.dumps({**rec(i), "page": page}) + "\n")
        f.write(json.dumps(rec(6)) + "\n{broken\n")
    rows = read_landed(spark, tmp_root, D).collect()
    assert len(rows) == 8
    pages = {r.id: r.page for r in rows if r.id}
    assert pages == {"0": 3000000000, "1": 2, "2": 2, "3": None, "4": None, "5": None, "6": None}
    assert [r._corrupt_record for r in rows if r.id is None] == ["{broken"]


def test_raw_pages_take_their_number_from_the_path(spark, tmp_root):
    for root, names in ((f"{tmp_root}/files", ("page-0001.json", "page-2.json", "page-4.json")),
                        (f"{tmp_root}/folders", ("page=1/part-0.json", "page=2/part-0.json", "page=4/p.json"))):
        path = partition_path(root, D)
        for name, recs in zip(names, ([rec(1), rec(2)], [rec(3)], [])):
            os.makedirs(os.path.dirname(f"{path}/{name}"), exist_ok=True)
            with open(f"{path}/{name}", "w") as f:
                f.write(json.dumps(recs))
        rows = read_landed(spark, root, D).collect()
        assert sorted((r.id, r.page) for r in rows) == [("1", 1), ("2", 1), ("3", 2)]


def test_packed_pages_read_as_the_folders_they_stand_for(spark, tmp_root):
    recs = [(rec(i), i // 3 + 1) for i in range(600)] + [(rec(600, tag_list=["a", None]), None), ({}, 7)]
    rows = spark.createDataFrame([{**r, "page": p} for r, p in recs], StructType([*RECORD.fields, StructField("page", LongType())]))
    packs = land_packed(rows, tmp_root, D)
    files = [f for _, _, names in os.walk(packs) for f in names if f.endswith(".json")]
    assert packs.endswith(PACKS) and len(files) <= 8        # not one for each of 201 pages
    got = read_landed(spark, tmp_root, D).collect()
    assert sorted((r.id or "", r.page or 0) for r in got) == sorted((r.get("id") or "", p or 0) for r, p in recs)
    assert all(r._corrupt_record is None and r.field_faults is None and r.date == D for r in got)
    assert [r.tag_list for r in got if r.id == "600"] == [["a", None]]
    # raw files beside the packs, and odd lines in one
    land_raw(tmp_root, {300: [rec(1000)]})
    with open(f"{packs}/more.json", "w") as f:
        f.write('{"path":"page=301/p.json","records":[]}\n{"path":"page=302/p.json","records":[{"id":"2000","tag_list":"x"}]}\n{broken\n')
    more = read_landed(spark, tmp_root, D).collect()
    assert len(more) == len(got) + 3
    assert {r.id: r.page for r in more if r.id in ("1000", "2000")} == {"1000": 300, "2000": 302}
    assert [r.field_faults[0].raw for r in more if r.id == "2000"] == ["x"]
    assert [r._corrupt_record for r in more if r._corrupt_record] == ["{broken"]


def test_declared_schema_drops_extra_keys_and_nulls_missing(spark, tmp_root):
    land_raw(tmp_root, {1: [rec(1, extra="zzz", tag_list=["a", None]),
                            {"id": "2", "postal_code": "007"}]})
    rows = {r.id: r for r in read_landed(spark, tmp_root, D).collect()}
    assert "extra" not in rows["1"].asDict()
    assert rows["1"].tag_list == ["a", None]
    assert rows["2"].name is None and rows["2"].postal_code == "007"


def test_no_landing_reads_empty(spark, tmp_root):
    landed = read_landed(spark, f"{tmp_root}/nothing", D)
    assert landed.count() == 0 and page_report(page_counts(landed)).first().first_gap == 1


def test_malformed_lines_are_kept_as_lines(spark, tmp_root):
    land_raw(tmp_root, {1: [rec(1), rec(2, tag_list="not-a-list")], 2: [rec(3)]})
    path = partition_path(tmp_root, D)
    with open(f"{path}/page-00002.json", "a") as f:
        f.write("{this is not json\n")
    rows = read_landed(spark, tmp_root, D).collect()
    kept = {r.id: r for r in rows if r._corrupt_record is None}
    assert sorted(kept) == ["1", "2", "3"]
    assert kept["2"].tag_list is None and kept["2"].name == "n2"     # only the bad field is lost
    assert [r._corrupt_record for r in rows if r.id is None] == ["{this is not json"]


def test_pages_below_one_are_no_page(spark, tmp_root):
    path = partition_path(tmp_root, D)
    os.makedirs(path)
    with open(f"{path}/records.json", "w") as f:
        for i, page in enumerate([0, -3, 1, 2]):
            f.write(json.dumps({**rec(i), "page": page}) + "\n")
    landed = read_landed(spark, tmp_root, D)
    assert landed.count() == 4
    r = page_report(page_counts(landed)).first()
    assert (r.first_gap, r.pages_present, r.pages_missing, r.rows_without_page) == (3, 2, 0, 2)
