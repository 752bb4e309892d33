"""Notices that are much alike, short phrases and small templates."""

from __future__ import annotations

from strata.llm import licenses
from tests.llm.data import prose

DOCS = "doc_id long, text string"


def test_each_notice_is_named_as_itself(spark):
    names = [k for k in licenses.TEMPLATES if not k.endswith("/line")]
    data = [(i, f"{prose(i, 60)} {licenses.TEMPLATES[k]} {prose(99 + i, 60)}") for i, k in enumerate(names)]
    both = f"{licenses.TEMPLATES['GPL-2.0']} {licenses.TEMPLATES['GPL-3.0']}"
    got = {}
    for r in licenses.scan(spark.createDataFrame(data + [(100, both)], DOCS)).collect():
        if not r.license.endswith("/line"):
            got.setdefault(r.doc_id, set()).add(r.license)
    assert got == {**{i: {k} for i, k in enumerate(names)}, 100: {"GPL-2.0", "GPL-3.0"}}


def test_short_and_small_templates(spark):
    small = {"five": "one two three four five six seven eight nine", "four": "kappa lima mike nova oscar papa romeo tango",
             "short": "Use it FREELY"}
    data = [(1, "x one two three four five six seven eight y"), (2, "a b use it freely, use it freely"),
            (3, "reuse it freely"), (4, "y two three four five six seven eight nine z"), (5, None)]
    got = licenses.scan(spark.createDataFrame(data, DOCS), small).collect()
    assert sorted((r.doc_id, r.license, r.containment) for r in got) == [(1, "five", 0.8), (2, "short", 1.0),
                                                                        (4, "five", 0.8)]
    assert [r.position for r in got if r.license == "short"] == [2]
