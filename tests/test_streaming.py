"""The availableNow trigger rebuilds exactly the dates with new pages."""

from __future__ import annotations

import datetime as dt

import pytest

from strata.plans import jobs
from strata.sources.schemas import GOLD
from strata.sources.tables import read_table
from strata.streaming import chain_for_new_pages
from tests.test_jobs import RECORDS, land

D1, D2 = dt.date(2024, 11, 27), dt.date(2024, 11, 28)


def test_stream_rebuilds_new_dates_once(spark, tmp_root):
    layout = jobs.Layout.under(tmp_root)
    ckpt = f"{tmp_root}/_stream"
    seen = []

    def go():
        q = chain_for_new_pages(spark, layout, ckpt, on_date=lambda d, m: seen.append(d))
        q.awaitTermination(300)
        assert q.exception() is None

    land(spark, layout, D1, RECORDS[:3])
    go()
    assert seen == [D1]
    land(spark, layout, D2, RECORDS)
    go()
    assert seen == [D1, D2]
    go()                                   # nothing new landed: no rebuild
    assert seen == [D1, D2]
    gold = read_table(spark, layout.gold, GOLD)
    by_date = {d: gold.where(gold.date == d).groupBy().sum("quantity_of_breweries").first()[0]
               for d in (D1, D2)}
    assert by_date == {D1: 3, D2: 5}


def test_command_line_stream(spark, tmp_root, capsys):
    from strata.__main__ import main

    layout = jobs.Layout.under(tmp_root)
    land(spark, layout, D2, RECORDS)
    assert main(["stream", "--root", tmp_root]) == 0
    assert main(["stream", "--root", tmp_root]) == 0           # nothing new
    lines = [ln for ln in capsys.readouterr().out.splitlines() if ln.startswith("{")]
    assert lines == ['{"dates": ["2024-11-28"]}', '{"dates": []}']


def test_failed_batch_is_rebuilt_on_restart(spark, tmp_root):
    layout = jobs.Layout.under(tmp_root)
    ckpt = f"{tmp_root}/_stream"
    land(spark, layout, D2, RECORDS)
    calls = []

    def crash_once(d, m):
        calls.append(d)
        if len(calls) == 1:
            raise RuntimeError("simulated loss after the gold write")

    from pyspark.errors import StreamingQueryException

    q = chain_for_new_pages(spark, layout, ckpt, on_date=crash_once)
    with pytest.raises(StreamingQueryException, match="simulated loss"):
        q.awaitTermination(300)                    # batch not committed
    q = chain_for_new_pages(spark, layout, ckpt, on_date=crash_once)
    q.awaitTermination(300)
    assert q.exception() is None and calls == [D2, D2]   # same batch, rebuilt again
    gold = read_table(spark, layout.gold, GOLD, D2)
    assert gold.groupBy().sum("quantity_of_breweries").first()[0] == 5   # not doubled
