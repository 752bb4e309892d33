"""Cards beside other digit groups."""

from __future__ import annotations

import re

from strata.llm import pii
from tests.llm.test_native_operators import luhn, replaced

CARD = "4111 1111 1111 1111"
AROUND = ["{} 12/27", "order 7 {}", "{} 123", "{} 12ab", "12345 6780 {}", "7-{}",
          "{} 123 456 {}", "4111111111111111 {}"]


def test_a_card_beside_digits_is_replaced(spark):
    plain = CARD.replace(" ", "")
    alone, joined = replaced(spark, [CARD, plain])
    assert alone != CARD and luhn(joined) and alone.replace(" ", "") == joined
    assert replaced(spark, [a.format(CARD, CARD) for a in AROUND]) == [
        a.format(alone, alone).replace(plain, joined) for a in AROUND]


def test_values_after_a_card_are_found(spark):
    values = ["123-45-6789", "2024-05-01", "25/12/1980", "555-223-4567", "10.0.0.1", "72ab@example.com"]
    got = replaced(spark, values + [f"{CARD} {v}" for v in values])
    for v, alone, beside in zip(values, got, got[len(values):]):
        assert alone != v and beside.endswith(" " + alone) and not beside.startswith("4111")


def test_cards_of_a_run_are_counted_and_long_runs_borne(spark):
    data = [(1, f"{CARD} 5 {CARD}"), (2, " ".join(["0"] * 5 + ["7"] * 30000)), (3, "1234 5678 9012 3456")]
    got = pii.pseudonymise(spark.createDataFrame(data, "doc_id long, text string"), counts="n")
    got = {r.doc_id: r for r in got.orderBy("doc_id").collect()}
    assert got[1].n == 2 and got[3].n == 0 and got[3].text == data[2][1]
    assert re.sub(r"\d", "9", got[2].text) == re.sub(r"\d", "9", data[1][1])
