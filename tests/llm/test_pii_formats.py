"""Dates, telephone numbers, accounts and mail names in more of the forms in use."""

from __future__ import annotations

import datetime
import re

from tests.llm.test_native_operators import replaced

VALUES = ["12/25/1980", "1/5/1980", "1.5.1980", "5 May 2024", "May 5, 2024", "DEC 21st, 1999", "3rd of June 1985",
          "+44 20 7946 0958", "+4915112345678", "+33 (0)1 23 45 67 89", "+12125550123", "DE89 3704 0044 0532 0130 00",
          "GB82WEST12345698765432", "2024-05-01"]
INVALID = ["31/31/1980", "30 Feb 2024", "DE88 3704 0044 0532 0130 00", "May 2024", "+11"]


def test_more_forms_are_replaced(spark):
    got = dict(zip(VALUES, replaced(spark, VALUES)))
    beside = replaced(spark, [f"on {v}, and {v}." for v in VALUES])
    for (v, p), b in zip(got.items(), beside):
        assert p != v and b == f"on {p}, and {p}."
        if not re.search("[A-Za-z]{3}", v):
            assert re.sub(r"\d", "9", p) == re.sub(r"\d", "9", v)
    assert datetime.datetime.strptime(got["12/25/1980"], "%m/%d/%Y").day > 12
    assert datetime.datetime.strptime(got["5 May 2024"], "%d %B %Y")
    assert got["+44 20 7946 0958"].startswith("+44 ") and got["+4915112345678"].startswith("+49")
    for v in ("DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"):
        t = got[v].replace(" ", "")
        assert int("".join(str(int(c, 36)) for c in t[4:] + t[:4])) % 97 == 1 and t[:2] == v[:2]
    stamp, = replaced(spark, ["at 2024-05-01T12:00"])
    assert stamp == f"at {got['2024-05-01']}T12:00"
    assert replaced(spark, INVALID) == INVALID


def test_letters_beyond_ascii_move(spark):
    a, b = replaced(spark, ["жанна@example.com", "éö@example.com"])
    for old, new in (("жанна", a), ("éö", b)):
        name = new.split("@")[0]
        assert name != old and len(name) == len(old) and name.isalpha() and not set(name) & set("abcxyz")


def test_pseudonyms_of_short_dates_do_not_meet(spark):
    days = [f"{d}/{m}/1980" for d in range(1, 32) for m in range(1, 10)] + [f"{m}/{d}/1980" for m in range(1, 13) for d in range(13, 29)]
    days = sorted(set(days))
    assert len(set(replaced(spark, days))) == len(days)
