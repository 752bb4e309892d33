"""The jobs and the chain on hand-made records: reruns, quarantine, metrics."""

from __future__ import annotations

import datetime as dt
import json
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from strata.operators.quality import DataQualityError
from strata.plans import jobs
from strata.plans.layers import to_gold, to_silver
from strata.sources.landing import land_pages
from strata.sources.schemas import BRONZE, CORRUPT, GOLD, LANDED, QUARANTINE, SILVER
from strata.sources.tables import MissingInputError, partition_path, read_table, stage_partition

D1, D2 = dt.date(2024, 11, 27), dt.date(2024, 11, 28)


def record(i, btype, city, state, lon, updated, phone=None, page=1, rid=None):
    return {"id": rid or f"id{i}", "name": f"b{i}", "brewery_type": btype, "street": None,
            "city": city, "state": state, "postal_code": None, "country": "US",
            "longitude": lon, "latitude": "45.1", "phone": phone, "website_url": None,
            "updated_at": updated, "tag_list": None, "page": page}


RECORDS = [
    record(1, "micro", "Bend", "Oregon", "-121.3", "2024-01-01", page=1),
    record(2, "micro", "Bend", "Oregon", "abc", "2024-01-01", phone="555", page=1),
    record(3, "large", "Bend", "Oregon", None, "2024-01-01", page=1),
    record(4, "closed", None, "Texas", "1e2", "2024-01-01", page=2),
    {**record(5, None, None, None, "-97.4", "2024-01-01", page=2), "tag_list": ["x", None]},
    record(6, "micro", "Old", "Name", "-90", "2023-01-01", page=2, rid="id1"),   # older copy of id1
]


def land(spark, layout, day, recs):
    df = spark.createDataFrame([tuple(r[f.name] for f in LANDED.fields) for r in recs], LANDED)
    land_pages(df, layout.landing, day)


def test_chain_rerun_and_metrics(spark, tmp_root):
    layout = jobs.Layout.under(tmp_root)
    land(spark, layout, D1, RECORDS[:2])
    jobs.run(spark, layout, D1)
    land(spark, layout, D2, RECORDS)
    report, m = jobs.run(spark, layout, D2)
    first = [tuple(r) for r in report.collect()]
    report2, m2 = jobs.run(spark, layout, D2)              # rerun: same result
    assert [tuple(r) for r in report2.collect()] == first
    assert m["bronze"]["rows"] == 6 and m["bronze"]["invalid"] == 2
    assert m["silver"]["rows_in"] == 6 and m["silver"]["rows_out"] == 5
    assert m["gold"]["n_rows"] == 5 and m["gold"]["nulls_brewery_type"] == 1
    assert m["gold"]["nulls_localizacao"] == 1
    assert first == sorted(first, key=lambda r: (r[0] is not None, r[0] or "", r[1] or ""))
    assert ("micro", "Bend, Oregon", 2) in first and ("closed", "Texas", 1) in first
    assert (None, None, 1) in first

    # tables: D1 untouched, D2 not doubled
    bronze = read_table(spark, layout.bronze, BRONZE)
    assert bronze.where(F.col("date") == D1).count() == 2
    assert bronze.where(F.col("date") == D2).count() == 6
    q = read_table(spark, layout.quarantine, QUARANTINE, D2, fmt="json")
    assert sorted(r.id for r in q.collect()) == ["id2", "id3"]
    assert {r.is_valid_longitude for r in q.collect()} == {False}
    silver = read_table(spark, layout.silver, SILVER, D2)
    kept = {r.id: r for r in silver.collect()}
    assert kept["id1"].updated_at == "2024-01-01" and kept["id1"].localizacao == "Bend, Oregon"
    assert kept["id1"].phone == "N/A" and kept["id2"].phone == "555"
    assert kept["id2"].longitude is None and kept["id4"].longitude == 100.0
    assert kept["id5"].localizacao == "" and kept["id5"].tag_list == ["x", None]
    assert kept["id4"].tag_list is None and kept["id4"].brewery_type == "closed"
    assert "quantity_of_breweries:bigint" in m["gold"]["schema"]
    assert len(m["gold"]["sample"]) == m["gold"]["groups"] == 4 and m["gold"]["sample"][0]["brewery_type"] is None
    assert "longitude:float" in m["silver"]["schema"]
    gold = read_table(spark, layout.gold, GOLD, D2)
    assert gold.agg(F.sum("quantity_of_breweries")).first()[0] == silver.count()


def test_rerun_without_invalid_rows_clears_quarantine(spark, tmp_root):
    layout = jobs.Layout.under(tmp_root)
    land(spark, layout, D2, RECORDS)
    jobs.run(spark, layout, D2)
    assert read_table(spark, layout.quarantine, QUARANTINE, D2, fmt="json").count() == 2
    land(spark, layout, D2, [RECORDS[0], RECORDS[3]])
    _, m = jobs.run(spark, layout, D2)
    assert m["bronze"]["invalid"] == 0
    assert read_table(spark, layout.quarantine, QUARANTINE, D2, fmt="json").count() == 0


def test_empty_landing_writes_nothing(spark, tmp_root):
    layout = jobs.Layout.under(tmp_root)
    land(spark, layout, D2, RECORDS)
    jobs.run(spark, layout, D2)
    land(spark, layout, D2, [])
    report, m = jobs.run(spark, layout, D2)
    assert report is None and m["bronze"]["written"] is False and "silver" not in m
    assert read_table(spark, layout.bronze, BRONZE, D2).count() == 6   # left alone


def test_missing_input_raises_and_changes_nothing(spark, tmp_root):
    layout = jobs.Layout.under(tmp_root)
    land(spark, layout, D2, RECORDS)
    jobs.run(spark, layout, D2)
    lost = replace(layout, bronze=f"{tmp_root}/typo")
    with pytest.raises(MissingInputError):
        jobs.transform_silver(spark, lost, D2)
    with pytest.raises(MissingInputError):
        jobs.transform_gold(spark, replace(layout, silver=f"{tmp_root}/typo"), D2)
    assert read_table(spark, layout.silver, SILVER, D2).count() == 5
    assert read_table(spark, layout.gold, GOLD, D2).count() == 4
    # a first write that crashed was never published: the next job does not take it for an empty date
    stage_partition(read_table(spark, layout.silver, SILVER, D2), layout.silver, D1)
    with pytest.raises(MissingInputError):
        jobs.transform_gold(spark, layout, D1)
    assert read_table(spark, layout.silver, SILVER, D1).count() == 0
    assert read_table(spark, layout.gold, GOLD, D2).count() == 4


def test_null_threshold_fails_before_publishing(spark, tmp_root):
    layout = jobs.Layout.under(tmp_root)
    land(spark, layout, D2, RECORDS)
    with pytest.raises(DataQualityError, match="localizacao"):
        jobs.run(spark, layout, D2, max_null_fraction=0.1)
    assert read_table(spark, layout.gold, GOLD, D2).count() == 0      # nothing published
    _, m = jobs.run(spark, layout, D2, max_null_fraction=0.5)          # within the threshold
    assert m["gold"]["n_rows"] == 5


def test_missing_settings_and_columns(spark):
    with pytest.raises(ValueError):
        jobs.load_bronze(spark, jobs.Layout("", "b", "q", "s", "g"), D2)
    with pytest.raises(ValueError, match="localizacao"):
        to_gold(spark.range(1).withColumnRenamed("id", "brewery_type"))


SILVER_INPUT = "id string, city string, state string, phone string, longitude string, latitude string, updated_at string"


def test_silver_keeps_upstream_location(spark):
    df = spark.createDataFrame([("1", "X", "Y", None, None, None, None, "upstream")],
                               SILVER_INPUT + ", localizacao string")
    assert to_silver(df).first().localizacao == "upstream"


@pytest.mark.parametrize("column", ["id", "city", "state", "phone", "longitude", "latitude", "updated_at"])
def test_silver_requires_its_columns(spark, column):
    with pytest.raises(ValueError, match=column):
        to_silver(spark.createDataFrame([], SILVER_INPUT).drop(column))


def test_command_line_run_and_report(spark, tmp_root, capsys):
    from strata.__main__ import main

    layout = jobs.Layout.under(tmp_root)
    land(spark, layout, D2, RECORDS)
    assert main(["run", "--root", tmp_root, "--date", D2.isoformat()]) == 0
    assert main(["report", "--root", tmp_root, "--date", D2.isoformat()]) == 0
    out = capsys.readouterr().out
    assert "Bend, Oregon" in out and '"n_rows": 5' in out


def test_views_answer_the_report_query(spark, tmp_root, capsys):
    from strata.__main__ import main

    layout = jobs.Layout.under(tmp_root)
    land(spark, layout, D1, RECORDS[:2])
    jobs.run(spark, layout, D1)
    land(spark, layout, D2, RECORDS)
    report, _ = jobs.run(spark, layout, D2)
    assert jobs.register_views(spark, layout) == ["landing", "bronze", "quarantine", "silver", "gold"]
    text = ("SELECT brewery_type, localizacao, quantity_of_breweries FROM gold "
            "WHERE date = '2024-11-28' ORDER BY brewery_type, localizacao")
    assert spark.sql(text).collect() == report.collect()
    assert spark.sql("SELECT count(*) FROM bronze").first()[0] == 8          # both dates
    assert spark.sql("SELECT count(*) FROM quarantine WHERE date = '2024-11-28'").first()[0] == 2
    assert main(["sql", "--root", tmp_root, "SELECT date, count(*) AS n FROM silver GROUP BY date"]) == 0
    assert "2024-11-27" in capsys.readouterr().out


def test_gap_is_incomplete_never_shorter(spark, tmp_root):
    layout = jobs.Layout.under(tmp_root)
    gapped = [r if r["page"] == 1 else {**r, "page": 3} for r in RECORDS]    # page 2 lost
    land(spark, layout, D2, gapped)
    m = jobs.load_bronze(spark, layout, D2)
    assert (m["first_gap"], m["pages_missing"], m["rows"], m["complete"]) == (2, 1, 6, False)
    with pytest.raises(jobs.IncompleteLandingError):
        jobs.run(spark, layout, D2, on_gap="fail")
    assert read_table(spark, layout.bronze, BRONZE, D2).count() == 6
    assert read_table(spark, layout.gold, GOLD, D2).count() == 0
    land(spark, layout, D2, RECORDS)
    assert jobs.load_bronze(spark, layout, D2, expected_pages=2)["complete"] is True
    assert jobs.load_bronze(spark, layout, D2, expected_pages=3)["complete"] is False     # tail cut


def test_no_landed_line_is_lost(spark, tmp_root):
    layout = jobs.Layout.under(tmp_root)
    path = partition_path(layout.landing, D2)
    os.makedirs(path)
    lines = [json.dumps({**RECORDS[0], "id": f"r{i}", "page": p})
             for i, p in enumerate([1, 3000000000, "2", 2.0, None])]
    with open(f"{path}/landed.json", "w") as f:
        f.write("\n".join([*lines, "{broken"]) + "\n")
    m = jobs.load_bronze(spark, layout, D2)
    assert (m["landed"], m["rows"], m["corrupt"], m["rows_without_page"]) == (6, 5, 1, 1)
    kept = read_table(spark, layout.corrupt_root, CORRUPT, D2).collect()
    assert [r.line for r in kept] == ["{broken"]
    pages = {r.id: r.page for r in read_table(spark, layout.bronze, BRONZE, D2).collect()}
    assert pages == {"r0": 1, "r1": 3000000000, "r2": 2, "r3": 2, "r4": None}


def test_command_line_status_and_full_report(spark, tmp_root, capsys):
    from strata.__main__ import main

    layout = jobs.Layout.under(tmp_root)
    recs = [{**RECORDS[0], "id": f"i{i}", "city": f"c{i}"} for i in range(1500)]
    land(spark, layout, D2, [{**r, "page": 2} for r in recs])
    assert main(["run", "--root", tmp_root, "--date", D2.isoformat()]) == 3      # page 1 missing
    out = capsys.readouterr().out
    assert sum(line.startswith('{"brewery_type"') for line in out.splitlines()) == 1500
    land(spark, layout, D2, [])
    assert main(["run", "--root", tmp_root, "--date", D2.isoformat()]) == 3


def test_roots_are_uris(spark, tmp_root):
    layout = jobs.Layout.under(f"file://{tmp_root}/")
    land(spark, layout, D2, RECORDS)
    report, m = jobs.run(spark, layout, D2)
    assert m["gold"]["n_rows"] == 5 and len(report.collect()) == 4
    assert layout.gold == f"file://{tmp_root}/gold"
