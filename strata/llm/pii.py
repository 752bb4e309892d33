"""Format-preserving pseudonyms for personal data in text.

Values found by pattern and then validated (card numbers by their check digit,
IPv4 addresses by range, social-security numbers by the ranges in use, telephone
numbers by their marks or the ranges in use, dates by the calendar) are numbers of a finite domain.  A keyed Feistel
network permutes that domain, so the pseudonym has the value's format and passes
the same validation, equal values have equal pseudonyms in every document, and
different values never collide.  The local parts of mail addresses and long hex
keys are permuted the same way, character by character within their class.

All of it is built from SQL expressions; a text without a candidate character
is not searched further.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import whole_text

ROUNDS = 10
KEY = "strata-pseudonyms"       # a parameter; production passes a secret

# What is looked for, in this order, between characters that cannot belong to it.
MAIL = r"[\p{L}\p{N}._%+-]{1,64}+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IPV4 = r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}"
ISO_DATE = r"\d{4}(?:-\d{2}-|/\d{2}/)\d{2}"
DAY_DATE = r"\d{1,2}(?:/\d{1,2}/|\.\d{1,2}\.)\d{4}"
MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October",
          "November", "December"]
_MONTH = "(?:" + "|".join(f"{m}|{m.upper()}|{m.lower()}" for m in [*MONTHS, *(m[:3] for m in MONTHS)]) + ")"
SAID_DATE = (rf"(?:\d{{1,2}}(?:st|nd|rd|th)?[ -](?:of )?{_MONTH}[.,]{{0,2}}[ -]\d{{4}}"
             rf"|{_MONTH}\.? \d{{1,2}}(?:st|nd|rd|th)?,? \d{{4}})")
# With a telephone's marks (+1, brackets, hyphens or points) any digits, else those in use.
PHONE = (r"(?:(?:\+1[ .-]?)(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}|\(\d{3}\) ?\d{3}[ .-]\d{4}"
         r"|\d{3}[.-]\d{3}[.-]\d{4}|[2-9]\d{2}[ .-][2-9]\d{2}[ .-]\d{4})")
SSN = r"\d{3}-\d{2}-\d{4}"
ABROAD = r"\+[1-9](?:[ .()-]{0,2}\d){6,14}"
IBAN = r"[A-Z]{2}\d{2}(?:(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?|[A-Z0-9]{11,30})"
HEX_KEY = r"[0-9a-f]{32,128}"
_AHEAD = r"(?![\p{L}\p{N}])"
_DATE_AHEAD = r"(?!(?!T\d)[\p{L}\p{N}])"
_IP_AHEAD = r"(?!\.?\d)"
# Digit groups of 13 digits or more in all, up to where another value begins; the
# cards are searched for among them.  Possessive, which Java runs without recursion.
_OTHER = (rf"(?!{MAIL}|{IPV4}{_IP_AHEAD}|{ISO_DATE}{_DATE_AHEAD}"
          rf"|(?:{DAY_DATE}|{SAID_DATE}|{SSN}|{PHONE}){_AHEAD})")
_GROUP = rf"\d{{1,19}}+{_AHEAD}"
CARD_RUN = rf"(?=\d(?:[ -]?\d){{12}}){_GROUP}(?:[ -]{_OTHER}{_GROUP})*+"
# Groups as cards are printed: one, four by four, 4-6-5 and 4-6-4.
CARD_SHAPES = r"\d{13,19}|\d{4}(?: \d{4}){3}(?: \d{3})?|\d{4} \d{6} \d{4,5}"
PATTERN = (rf"(?<![\p{{L}}\p{{N}}._%+-]){MAIL}"
           rf"|(?<![\p{{L}}\p{{N}}.]){IPV4}{_IP_AHEAD}"
           rf"|(?<![\p{{L}}\p{{N}}-])(?:{ISO_DATE}{_DATE_AHEAD}|(?:{DAY_DATE}|{SAID_DATE}|{SSN}){_AHEAD})"
           rf"|(?<![\p{{L}}\p{{N}}])(?:{PHONE}|{ABROAD}|{IBAN}){_AHEAD}"
           rf"|(?<![\p{{L}}\p{{N}}.-]){CARD_RUN}"
           rf"|(?<![\p{{L}}\p{{N}}]){HEX_KEY}{_AHEAD}")


def _prf(key: str, kind: str | Column, i: int, half: Column) -> Column:
    """60 keyed bits of a round, a non-negative long."""
    kind = kind if isinstance(kind, Column) else F.lit(kind)
    said = F.concat(F.lit(f"{key}|"), kind, F.lit(f"|{i}|"), half.cast("string"), F.lit(f"|{key}"))
    return F.conv(F.left(F.sha2(said.cast("binary"), 256), F.lit(15)), 16, 10).cast("long")


def feistel(left: Column, right: Column, a: int | Column, b: int | Column, key: str,
            kind: str | Column, rounds: int = ROUNDS) -> tuple[Column, Column]:
    """Permutes the pairs of [0, a) x [0, b): rounds add a keyed function of one
    half to the other, modulo its range, in turn."""
    state = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    bounds = [c if isinstance(c, Column) else F.lit(c).cast("long") for c in (a, b)]

    def round_(i: int) -> Callable[[Column], Column]:
        if i % 2 == 0:
            return lambda s: F.struct(
                F.pmod(s["l"] + _prf(key, kind, i, s["r"]), bounds[0]).alias("l"), s["r"].alias("r"))
        return lambda s: F.struct(
            s["l"].alias("l"), F.pmod(s["r"] + _prf(key, kind, i, s["l"]), bounds[1]).alias("r"))

    for i in range(rounds):     # a lambda holds each state once, however often the next round reads it
        state = _let(state, round_(i))
    return state["l"], state["r"]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, r"\D", "")


def _pad(n: Column, width: int | Column) -> Column:
    return F.lpad(n.cast("string"), width, "0")


def _refill(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced, in order, by those of ``digits``."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("n"))

    def step(acc: Column, c: Column) -> Column:
        is_digit = c.between("0", "9")
        return F.struct(F.concat(acc["out"], F.when(is_digit, F.substring(digits, acc["n"] + 1, F.lit(1))).otherwise(c))
                        .alias("out"), F.when(is_digit, acc["n"] + 1).otherwise(acc["n"]).alias("n"))
    return F.aggregate(F.split(value, ""), start, step, lambda acc: acc["out"])


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string whose last digit is the check digit."""
    places = F.sequence(F.lit(1), F.length(digits))

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = (F.length(digits) - i) % 2 == 1
        return acc + F.when(twice, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)
    return F.aggregate(places, F.lit(0), add)


def _card(value: Column, key: str) -> Column:
    """All digits of a valid card but the last are permuted; the last is the new
    check digit."""
    def with_digits(d: Column) -> Column:
        n = F.length(d) - 1
        lw = F.floor(n / 2).cast("int")
        a, b = F.pow(F.lit(10.0), lw).cast("long"), F.pow(F.lit(10.0), n - lw).cast("long")
        left, right = feistel(F.left(d, lw).cast("long"), F.substring(d, lw + 1, n - lw).cast("long"),
                              a, b, key, "card")
        body = _let(F.struct(left.alias("l"), right.alias("r")),
                    lambda s: F.concat(_pad(s["l"], lw), _pad(s["r"], n - lw)))

        def checked(x: Column) -> Column:
            return F.concat(x, F.pmod(-luhn_sum(F.concat(x, F.lit("0"))), F.lit(10)).cast("string"))
        return _refill(value, _let(body, checked))
    return _let(_digits(value), with_digits)


def _card_ends(groups: Column, first: Column) -> Column:
    """Ends (counts of groups) of the valid cards that begin at group ``first``,
    with ``usual`` for those in the groups that cards are printed in."""
    spans = F.transform(
        F.sequence(F.lit(1), F.least(F.lit(19), F.size(groups) - first + 1)),
        lambda n: F.struct((first + n - 1).alias("end"), F.array_join(F.slice(groups, first, n), " ").alias("said")))

    def valid(x: Column) -> Column:
        return F.when(F.length(F.replace(x["said"], F.lit(" "), F.lit(""))).between(13, 19),
                      _let(F.replace(x["said"], F.lit(" "), F.lit("")), lambda d: luhn_sum(d) % 10 == 0)).otherwise(False)
    return F.transform(F.filter(spans, valid), lambda x: F.struct(
        x["end"].alias("end"), x["said"].rlike(f"^(?:{CARD_SHAPES})$").alias("usual")))


def _cards(value: Column, key: str) -> Column:
    """``out``, a run of digit groups with the valid cards in it replaced, and
    ``n``, their number; NULL without any.  A card begins and ends at the border
    of a group.  From left to right, a card in usual groups goes before one that
    reaches into it or begins with it; of the others the longest is taken."""
    def of_groups(tokens: Column, groups: Column, ends: Column) -> Column:
        usual = F.transform(ends, lambda e: F.array_max(F.transform(F.filter(e, lambda x: x["usual"]),
                                                                    lambda x: x["end"])))

        def chosen(usual: Column, i: Column) -> Column:
            free = F.filter(F.get(ends, i - 1), lambda x: ~F.exists(
                F.slice(usual, i + 1, F.greatest(F.lit(0), x["end"] - i)), lambda u: u.isNotNull()))
            return F.coalesce(F.get(usual, i - 1), F.array_max(F.transform(free, lambda x: x["end"])))

        def pieces(usual: Column) -> Column:
            start = F.struct(F.lit(1).alias("next"), F.array().cast("array<struct<at:int,end:int>>").alias("cards"))

            def step(acc: Column, i: Column) -> Column:
                return _let(F.when(i >= acc["next"], chosen(usual, i)), lambda end: F.when(end.isNull(), acc).otherwise(
                    F.struct((end + 1).alias("next"), F.array_append(
                        acc["cards"], F.struct(i.alias("at"), end.alias("end"))).alias("cards"))))
            return F.aggregate(F.sequence(F.lit(1), F.size(groups)), start, step, lambda acc: acc["cards"])

        def text(first: Column, n: Column) -> Column:
            return F.array_join(F.slice(tokens, first, n), "")

        def put(cards: Column) -> Column:
            def with_gap(c: Column, k: Column) -> Column:
                gap = F.coalesce(F.get(cards, k - 1)["end"], F.lit(0)) + 1
                return F.concat(text(gap, c["at"] - gap), _card(text(c["at"], c["end"] - c["at"] + 1), key))
            last = F.element_at(cards, -1)["end"]
            return F.when(F.size(cards) > 0, F.struct(
                F.concat(F.array_join(F.transform(cards, with_gap), ""),
                         text(last + 1, F.size(tokens) - last)).alias("out"), F.size(cards).alias("n")))
        return _let(_let(usual, pieces), put)

    def with_tokens(tokens: Column) -> Column:
        return _let(F.transform(tokens, _digits), lambda groups: _let(
            F.transform(F.sequence(F.lit(1), F.size(groups)), lambda i: _card_ends(groups, i)),
            lambda ends: of_groups(tokens, groups, ends)))
    return _let(F.regexp_extract_all(value, F.lit(r"\d+[ -]?"), F.lit(0)), with_tokens)


def _ipv4(value: Column, key: str) -> Column:
    def with_parts(p: Column) -> Column:
        left, right = feistel(p[0] * 256 + p[1], p[2] * 256 + p[3], 1 << 16, 1 << 16, key, "ipv4")

        def dotted(s: Column) -> Column:
            return F.concat_ws(".", *[x.cast("string") for h in ("l", "r")
                                      for x in (F.shiftright(s[h], 8), F.pmod(s[h], F.lit(256)))])
        out = _let(F.struct(left.alias("l"), right.alias("r")), dotted)
        return F.when(F.forall(p, lambda x: x <= 255), out)
    return _let(F.transform(F.split(value, r"\."), lambda x: x.cast("int")), with_parts)


def _phone(value: Column, key: str) -> Column:
    """Ten digits.  Area and exchange codes that begin with 2 to 9, as those in use
    do, keep doing so; a code that begins with 0 or 1 stays among those."""
    def with_digits(d: Column) -> Column:
        area, rest = F.left(d, F.lit(3)).cast("long"), F.substring(d, 4, 7).cast("long")

        def of(c: Column, low: int, size: int) -> tuple[Column, Column]:
            """First number and size of the class of codes that ``c`` is of."""
            return (F.when(c >= low, F.lit(low)).otherwise(0).cast("long"),
                    F.when(c >= low, F.lit(size - low)).otherwise(low).cast("long"))
        (a0, a_n), (r0, r_n) = of(area, 200, 1000), of(rest, 2_000_000, 10_000_000)
        # a key of its own per class: the classes are domains apart
        kind = F.concat(F.lit("phone"), F.when(area < 200, F.lit("-a")).otherwise(""),
                        F.when(rest < 2_000_000, F.lit("-x")).otherwise(""))
        left, right = feistel(area - a0, rest - r0, a_n, r_n, key, kind)
        out = _let(F.struct(left.alias("l"), right.alias("r")), lambda s: F.concat(
            F.when(value.startswith("+1"), F.lit("1")).otherwise(""), _pad(s["l"] + a0, 3), _pad(s["r"] + r0, 7)))
        return _refill(value, out)
    return _let(F.right(_digits(value), F.lit(10)), with_digits)


def _ssn(value: Column, key: str) -> Column:
    """Areas 001-899 without 666, groups 01-99, serials 0001-9999."""
    def with_digits(d: Column) -> Column:
        area, group, serial = (F.substring(d, s, n).cast("long") for s, n in ((1, 3), (4, 2), (6, 4)))
        place = F.when(area > 666, area - 2).otherwise(area - 1)
        left, right = feistel(place, (group - 1) * 9999 + serial - 1, 898, 99 * 9999, key, "ssn")

        def joined(s: Column) -> Column:
            return F.concat_ws("-", _pad(F.when(s["l"] >= 665, s["l"] + 2).otherwise(s["l"] + 1), 3),
                               _pad(F.floor(s["r"] / 9999) + 1, 2), _pad(F.pmod(s["r"], F.lit(9999)) + 1, 4))
        valid = area.between(1, 899) & (area != 666) & (group >= 1) & (serial >= 1)
        return F.when(valid, _let(F.struct(left.alias("l"), right.alias("r")), joined))
    return _let(_digits(value), with_digits)


_FIRST_DAY = "1800-01-01"
_DAYS = 189 * 773           # the 400 years from then on


def _walk(n: Column, key: str, within: Callable[[Column], Column]) -> Column:
    """The day ``n`` permuted until the result is ``within`` a class that ``n``
    is of: a permutation of that class.  Of the smallest class, every fifth of
    the days, one in 10^27 are still outside after the last step: NULL."""
    def again(acc: Column, i: Column) -> Column:
        left, right = feistel(F.floor(acc / 773), F.pmod(acc, F.lit(773)), 189, 773, key, "date")
        moved = _let(F.struct(left.alias("l"), right.alias("r")), lambda s: s["l"] * 773 + s["r"])
        return F.when((i > 1) & within(F.date_add(F.lit(_FIRST_DAY).cast("date"), acc.cast("int"))), acc).otherwise(moved)
    out = F.aggregate(F.sequence(F.lit(1), F.lit(256)), n, again)
    return _let(out, lambda x: F.when(
        x.isNotNull() & within(F.date_add(F.lit(_FIRST_DAY).cast("date"), x.cast("int"))),
        F.date_add(F.lit(_FIRST_DAY).cast("date"), x.cast("int"))))


def _date(year: Column, month: Column, day: Column, key: str, within: Callable[[Column], Column]) -> Column:
    """Another day of the 400 years from 1800 on, ``within`` the days that can be
    written as the value is; NULL if the calendar has no such day."""
    said = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    n = F.datediff(F.to_date(F.try_to_timestamp(said, F.lit("yyyy-MM-dd"))), F.lit(_FIRST_DAY).cast("date"))
    return _let(n.cast("long"), lambda n: F.when(n.between(0, _DAYS - 1), _walk(n, key, within)))


def _iso_date(value: Column, key: str) -> Column:
    """The same day has the same pseudonym with hyphens and with slashes."""
    new = _date(F.left(value, F.lit(4)), F.substring(value, 6, 2), F.right(value, F.lit(2)), key,
                lambda d: F.lit(True))
    return F.when(value.contains("/"), F.date_format(new, "yyyy/MM/dd")).otherwise(F.date_format(new, "yyyy-MM-dd"))


def _day_date(value: Column, key: str) -> Column:
    """Day first if the calendar has such a day, else month first.  The digits of
    day and month stay as many, and what can only be read month first stays so:
    a text has one reading, and different texts have different pseudonyms."""
    def with_parts(p: Column) -> Column:
        day_first = p[1].cast("int") <= 12
        day, month = F.when(day_first, p[0]).otherwise(p[1]), F.when(day_first, p[1]).otherwise(p[0])

        def places(d: Column) -> tuple[Column, Column]:
            return (F.when(day_first, F.day(d)).otherwise(F.month(d)),
                    F.when(day_first, F.month(d)).otherwise(F.day(d)))

        def within(d: Column) -> Column:
            first, second = places(d)
            return (((F.length(p[0]) == 2) | (first < 10)) & ((F.length(p[1]) == 2) | (second < 10))
                    & (day_first | (second > 12)))

        def said(d: Column) -> Column:
            first, second = places(d)
            mark = F.when(value.contains("/"), "/").otherwise(".")
            return F.concat(_pad(first, F.length(p[0])), mark, _pad(second, F.length(p[1])), mark, _pad(F.year(d), 4))
        return _let(_date(p[2], month, day, key, within), lambda d: F.when(d.isNotNull(), said(d)))
    return _let(F.split(value, "[/.]"), with_parts)


def _said_date(value: Column, key: str) -> Column:
    """A date with an English month.  Its order, marks, case, number of digits and
    long or short names stay; the name May counts as long."""
    names = F.array(*[F.lit(m) for m in MONTHS])

    def with_parts(p: Column) -> Column:
        name, day, mark = p["name"], p["day"], p["mark"]
        month = F.array_position(F.transform(names, lambda m: F.lower(F.left(m, F.lit(3)))),
                                 F.lower(F.left(name, F.lit(3))))
        short = (F.length(name) == 3) & (F.lower(name) != "may")

        def within(d: Column) -> Column:
            return ((F.length(day) == 2) | (F.day(d) < 10)) & (~short | (F.month(d) != 5))

        def said(d: Column) -> Column:
            full = F.element_at(names, F.month(d))
            new = F.when(short, F.left(full, F.lit(3))).otherwise(full)
            new = F.when(name == F.upper(name), F.upper(new)).when(name == F.lower(name), F.lower(new)).otherwise(new)
            n = F.day(d)
            nth = F.when(mark == "", "").when(n.isin(1, 21, 31), "st").when(n.isin(2, 22), "nd").when(
                n.isin(3, 23), "rd").otherwise("th")
            day_out = F.concat(_pad(n, F.length(day)), nth)
            return F.concat(F.when(p["before"] == "", F.concat(day_out, p["mid"], new)).otherwise(
                F.concat(new, p["mid"], day_out)), p["end"], _pad(F.year(d), 4))
        return _let(_date(F.right(value, F.lit(4)), month.cast("string"), day, key, within),
                    lambda d: F.when(d.isNotNull(), said(d)))

    def part(pattern: str, group: int) -> Column:
        return F.regexp_extract(value, pattern, group)
    day_first = rf"^(\d+)(st|nd|rd|th|)([ -](?:of )?)({_MONTH})([.,]*[ -])\d{{4}}$"
    month_first = rf"^({_MONTH})(\.? )(\d+)(st|nd|rd|th|)(,? )\d{{4}}$"

    def struct(pattern: str, name: int, day: int, mark: int, mid: int, end: int, before: str) -> Column:
        return F.struct(part(pattern, name).alias("name"), part(pattern, day).alias("day"),
                        part(pattern, mark).alias("mark"), part(pattern, mid).alias("mid"),
                        part(pattern, end).alias("end"), F.lit(before).alias("before"))
    return _let(F.when(value.rlike(r"^\d"), struct(day_first, 4, 1, 2, 3, 5, ""))
                .otherwise(struct(month_first, 1, 3, 4, 2, 5, "month")), with_parts)


def _permute_digits(d: Column, key: str, kind: str) -> Column:
    """A string of 2 to 18 digits permuted over all strings of as many."""
    n, lw = F.length(d), F.floor(F.length(d) / 2).cast("int")
    left, right = feistel(F.left(d, lw).cast("long"), F.substring(d, lw + 1, n - lw).cast("long"),
                          F.pow(F.lit(10.0), lw).cast("long"), F.pow(F.lit(10.0), n - lw).cast("long"), key, kind)
    return _let(F.struct(left.alias("l"), right.alias("r")),
                lambda s: F.concat(_pad(s["l"], lw), _pad(s["r"], n - lw)))


# Country codes: one digit, two digits; all others have three.
COUNTRY = r"^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"


def _abroad(value: Column, key: str) -> Column:
    """The country code stays; the digits after it are permuted over all of their
    number.  A North American number without its marks is one of ``_phone``."""
    def with_digits(d: Column) -> Column:
        code = F.regexp_extract(d, f"({COUNTRY})", 1)
        rest = F.substring(d, F.length(code) + 1, F.length(d))
        return F.when(code != "1", _refill(value, F.concat(code, _permute_digits(rest, key, "abroad")))).when(
            d.rlike(r"^1\d{10}$"), _phone(value, key))
    return _let(_digits(value), with_digits)


def _iban(value: Column, key: str) -> Column:
    """Letters and digits of a valid account are permuted within their class, and
    the check digits follow.  The country stays."""
    def check(country: Column, account: Column) -> Column:
        def add(acc: Column, c: Column) -> Column:
            n = F.ascii(c)
            return F.when(n < 58, F.pmod(acc * 10 + n - 48, F.lit(97))).otherwise(F.pmod(acc * 100 + n - 55, F.lit(97)))
        return _pad(98 - F.aggregate(F.split(F.concat(account, country, F.lit("00")), ""), F.lit(0), add), 2)

    def with_text(t: Column) -> Column:
        country, account = F.left(t, F.lit(2)), F.substring(t, 5, 30)

        def put(new: Column) -> Column:
            whole = F.concat(country, check(country, new), new)
            start = F.struct(F.lit("").alias("out"), F.lit(0).alias("n"))
            return F.aggregate(F.split(value, ""), start, lambda acc, c: F.struct(
                F.concat(acc["out"], F.when(c == " ", c).otherwise(F.substring(whole, acc["n"] + 1, F.lit(1)))).alias("out"),
                (acc["n"] + F.when(c == " ", 0).otherwise(1)).alias("n")), lambda acc: acc["out"])
        return F.when(F.substring(t, 3, 2) == check(country, account),
                      _let(_permute_chars(account, key, "iban"), put))
    return _let(F.replace(value, F.lit(" "), F.lit("")), with_text)


def _letter_ranges() -> list[tuple[int, int]]:
    """(first, size) of the runs of code points beyond ASCII that are letters or
    numbers; the runs of one go together as the pairs after the list."""
    runs: list[list[int]] = []
    for c in range(128, 0x20000):
        if unicodedata.category(chr(c))[0] in "LN":
            if runs and runs[-1][0] + runs[-1][1] == c:
                runs[-1][1] += 1
            else:
                runs.append([c, 1])
    return [(a, n) for a, n in runs]


_RUNS = [r for r in _letter_ranges() if r[1] > 1]
_LONE = "".join(chr(a) for a, n in _letter_ranges() if n == 1)


def _beyond_ascii(c: Column, k: Column) -> Column:
    """A letter or number beyond ASCII moved by ``k`` within the run of code
    points it is in, a lone one among the lone ones."""
    runs = F.from_json(F.lit(json.dumps([{"a": a, "n": n} for a, n in _RUNS])), "array<struct<a:int,n:int>>")

    def moved(n: Column) -> Column:
        def place(r: Column) -> Column:
            to = r["a"] + F.pmod(n - r["a"] + k, r["n"])
            return F.decode(F.unhex(F.lpad(F.hex(to), 8, "0")), "UTF-32")
        return _let(F.get(F.filter(runs, lambda r: n.between(r["a"], r["a"] + r["n"] - 1)), F.lit(0)), place)
    lone = F.substring(F.lit(_LONE), F.pmod(F.instr(F.lit(_LONE), c) - 1 + k, F.lit(len(_LONE))) + 1, F.lit(1))
    return F.coalesce(F.when(F.instr(F.lit(_LONE), c) > 0, lone).otherwise(_let(F.ascii(c), moved)), c)


def _shift_chars(half: Column, stream: Column, hex_key: bool) -> Column:
    """Every letter and digit moved within its class by a keystream byte."""
    def moved(c: Column, i: Column) -> Column:
        k = F.conv(F.substring(stream, F.pmod(i, F.lit(32)) * 2 + 1, F.lit(2)), 16, 10).cast("int")

        def within(alphabet: str) -> Column:
            n = len(alphabet)
            return F.substring(F.lit(alphabet), F.pmod(F.instr(F.lit(alphabet), c) - 1 + k, F.lit(n)) + 1, F.lit(1))
        lower, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
        if hex_key:
            return within(digits + "abcdef")
        return (F.when(c.between("0", "9"), within(digits)).when(c.between("a", "z"), within(lower))
                .when(c.between("A", "Z"), within(lower.upper()))
                .when(F.octet_length(c) > 1, _beyond_ascii(c, k)).otherwise(c))
    return F.when(F.length(half) == 0, "").otherwise(F.array_join(F.transform(F.split(half, ""), moved), ""))


def _permute_chars(value: Column, key: str, kind: str, hex_key: bool = False, rounds: int = 6) -> Column:
    cut = F.ceil(F.length(value) / 2).cast("int")
    state = F.struct(F.left(value, cut).alias("l"), F.substring(value, cut + 1, F.length(value)).alias("r"))

    def round_(i: int) -> Callable[[Column], Column]:
        src, dst = ("r", "l") if i % 2 == 0 else ("l", "r")

        def turn(s: Column) -> Column:
            stream = F.sha2(F.concat(F.lit(f"{key}|{kind}|{i}|"), s[src], F.lit(f"|{key}")).cast("binary"), 256)
            new = _let(stream, lambda k: _shift_chars(s[dst], k, hex_key))
            return F.struct(*[(new if h == dst else s[h]).alias(h) for h in ("l", "r")])
        return turn

    for i in range(rounds):
        state = _let(state, round_(i))
    return _let(state, lambda s: F.concat(s["l"], s["r"]))


def _mail(value: Column, key: str) -> Column:
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    return F.concat(_permute_chars(local, key, "mail"), F.lit("@"), domain)


def pseudonym(value: Column, key: str = KEY) -> Column:
    """``out``, the pseudonym of one match of ``PATTERN``, and ``n``, how many
    values in it were replaced; NULL where none is valid."""
    def whole(p: str) -> Column:
        return value.rlike(f"^(?:{p})$")

    def one(new: Column) -> Column:
        return _let(new, lambda x: F.when(x.isNotNull(), F.struct(x.alias("out"), F.lit(1).alias("n"))))

    return (F.when(value.contains("@"), one(_mail(value, key)))
            .when(whole(IPV4), one(_ipv4(value, key)))
            .when(whole(ISO_DATE), one(_iso_date(value, key)))
            .when(whole(DAY_DATE), one(_day_date(value, key)))
            .when(whole(SAID_DATE), one(_said_date(value, key)))
            .when(whole(SSN), one(_ssn(value, key)))
            .when(whole(PHONE), one(_phone(value, key)))
            .when(whole(ABROAD), one(_abroad(value, key)))
            .when(whole(IBAN), one(_iban(value, key)))
            .when(whole(HEX_KEY), one(_permute_chars(value, key, "hex", hex_key=True)))
            .otherwise(_cards(value, key)))


def pseudonymise(docs: DataFrame, key: str = KEY, counts: str | None = None) -> DataFrame:
    """``docs`` with the personal data in ``text`` replaced; all other columns
    stay.  NULL texts stay NULL; texts without valid values stay as they are.  With ``counts``, a column of that
    name has the number of values replaced."""
    text = F.col("text").cast("string")
    searched = F.coalesce(text.rlike("[0-9@]") & (text.rlike(r"@|\d[\d ()./-]{5}|[0-9a-f]{32}|\d{4}|[A-Z]{2}\d\d")), F.lit(False))
    found = F.when(searched, F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)))
    rows = docs.withColumn("__found", found)
    news = F.when(F.size("__found") > 0, F.transform("__found", lambda v: pseudonym(v, key)))
    rows = rows.withColumn("__new", news)
    parts = F.split(text, PATTERN, -1)
    put = F.array_join(F.concat(F.zip_with(
        F.slice(parts, F.lit(1), F.size("__found")),
        F.zip_with("__found", "__new", lambda old, new: F.coalesce(new["out"], old)), lambda p, v: F.concat(p, v)),
        F.slice(parts, F.size("__found") + 1, F.lit(1))), "")
    new_text = F.when(F.size("__found") > 0, put).otherwise(text)
    out = [new_text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    if counts:
        out.append(F.coalesce(F.aggregate(
            "__new", F.lit(0), lambda n, v: n + F.coalesce(v["n"], F.lit(0))), F.lit(0)).cast("long").alias(counts))
    return rows.select(*out)
