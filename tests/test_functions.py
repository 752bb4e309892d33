"""Column expressions on hand-made edge rows, and the validity rule against
Python's own float() on generated text."""

from __future__ import annotations

import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.functions import (
    empty_to_null,
    fill_null,
    is_float_text,
    lenient_float,
    location_label,
    run_date,
    stamp_date,
)


def py_valid(s):
    if s is None:
        return False
    try:
        float(s)
        return True
    except (ValueError, TypeError):
        return False


def spark_eval(spark, values, expr):
    schema = StructType([StructField("i", StringType()), StructField("s", StringType())])
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], schema)
    rows = df.select("i", expr(F.col("s")).alias("r")).collect()
    return [r.r for r in sorted(rows, key=lambda r: int(r.i))]


EDGE_VALID = ["-97.46818222", " 1.5 ", "1e3", ".5", "5.", "nan", "inf", "-Infinity",
              "1_000", "١٢", "999", "+.5e-3", "\t7\n", "iNfInItY", "\xa01",
              "\x851", "\u20281", "\u30001", "\x0b1", "\x0c1"]
EDGE_INVALID = [None, "", "abc", "1.5f", "1.5d", "ınf", "İnf", "1,5", "0x10",
                "1__0", "_1", "1_", ". 5", "e5", "1e", "--1", "in f",
                "\x1c1", "1\x1f", "\u180e1"]


def test_validity_edge_rows(spark):
    got = spark_eval(spark, EDGE_VALID + EDGE_INVALID, is_float_text)
    assert got == [True] * len(EDGE_VALID) + [False] * len(EDGE_INVALID)
    assert [py_valid(v) for v in EDGE_VALID + EDGE_INVALID] == got


ALPHABET = list("0123456789.eE+-_ infatyINFATY,x") + ["\t", "\n", "\xa0", " ",
                                                      "١", "１", "ı", "\x1c", "\x1f"]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, min_size=0, max_size=8), min_size=300, max_size=300))
def test_validity_matches_python_float(spark, texts):
    assert spark_eval(spark, texts, is_float_text) == [py_valid(t) for t in texts]


def test_validity_matches_python_float_numeric_shapes(spark):
    rng = random.Random(7)
    parts = ["", "+", "-", " ", "0", "1", "12", "1_2", ".", "e", "E", "e-", "5", "_", "inf", "nan"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 5))) for _ in range(3000)]
    assert spark_eval(spark, texts, is_float_text) == [py_valid(t) for t in texts]


def test_lenient_cast(spark):
    got = spark_eval(spark, ["-97.46818222", "abc", "", None, "1e3", "1.5f", "1_000", "nan", "-inf"],
                     lenient_float)
    assert got[0] == pytest.approx(-97.468185, rel=1e-6)
    assert got[1:4] == [None, None, None]
    assert got[4] == 1000.0 and got[5] == 1.5 and got[6] is None
    assert math.isnan(got[7]) and got[8] == float("-inf")


def test_fill_null_keeps_empty(spark):
    assert spark_eval(spark, [None, "", "555"], fill_null) == ["N/A", "", "555"]


def test_location_label_cases(spark):
    rows = [("C", "S"), ("C", None), (None, "S"), (None, None)]
    df = spark.createDataFrame(rows, "city string, state string")
    got = [r[0] for r in df.select(location_label("city", "state")).collect()]
    assert got == ["C, S", "C", "S", ""]
    got = [r[0] for r in df.select(empty_to_null(location_label("city", "state"))).collect()]
    assert got == ["C, S", "C", "S", None]


def test_run_date_and_stamp(spark):
    import datetime as dt

    assert run_date("2024-11-28") == dt.date(2024, 11, 28)
    assert run_date(dt.datetime(2024, 11, 28, 6, 1)) == dt.date(2024, 11, 28)
    with pytest.raises(ValueError):
        run_date(20241128)
    df = stamp_date(spark.range(2), "2024-11-28")
    assert df.schema["date"].dataType.typeName() == "date"
    assert {r.date for r in df.collect()} == {dt.date(2024, 11, 28)}


def test_no_python_udf_in_plans(spark):
    df = spark.createDataFrame([("1",)], "s string").select(
        is_float_text("s"), lenient_float("s"), fill_null("s"), location_label("s", "s"))
    from tests.plans import plan as _plan
    plan = _plan(df)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_cluster_settings_scale_with_input():
    from strata.session import cluster_settings

    small = cluster_settings(10 << 30, 64)
    big = cluster_settings(100 << 40, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 128          # two waves of cores
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (128 << 20)
    assert big["spark.sql.adaptive.enabled"] == "true"


def test_validity_unicode_digits_of_any_jvm(spark):
    # digits added in Unicode 14/15 (a Java 17 regex alone does not know them),
    # plus a sweep of every 97th code point in both positions
    texts = [chr(b + i) + "1" for b in (0x11F50, 0x16AC0, 0x1E4F0, 0x0660, 0xFF10) for i in range(10)]
    texts += [t for cp in range(0, 0x110000, 97) if not 0xD800 <= cp <= 0xDFFF
              for t in (chr(cp) + "1", "1" + chr(cp))]
    assert spark_eval(spark, texts, is_float_text) == [py_valid(t) for t in texts]
