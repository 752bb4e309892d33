"""Declared schemas of the four tables.

Fixed values: the record field names and types of the source API, the name of
the quarantine flag, the derived location column and the gold count column must
equal the original pipeline's so that its tables and reports read the same.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    FloatType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# --- fixed values (names shared with the original pipeline) -------------------
RECORD_FIELDS = (
    "id", "name", "brewery_type", "street", "city", "state", "postal_code",
    "country", "longitude", "latitude", "phone", "website_url", "updated_at",
    "tag_list",
)
KEY = "id"
TYPE_COL = "brewery_type"
LOCATION_COL = "localizacao"
COUNT_COL = "quantity_of_breweries"
VALID_FLAG = "is_valid_longitude"
PHONE_FILL = "N/A"
LOCATION_SEP = ", "
# -------------------------------------------------------------------------------

DATE_COL = "date"      # partition column of every table (DateType)
PAGE_COL = "page"      # page number of a landed record (1-based, bigint)
CORRUPT_COL = "_corrupt_record"   # text of a landed line that is no record
FAULTS_COL = "field_faults"       # fields of a record whose value is of another kind than declared

# Raw record: every field arrives as text (coordinates included) except the tag
# list.  String first, cast later.
RECORD = StructType(
    [StructField(name, StringType(), True) for name in RECORD_FIELDS[:-1]]
    + [StructField("tag_list", ArrayType(StringType()), True)]
)

# A record as landed by the page client: the record plus its page number.
LANDED = StructType(RECORD.fields + [StructField(PAGE_COL, LongType(), True)])

BRONZE = StructType(LANDED.fields + [StructField(DATE_COL, DateType(), True)])

# Landed lines that hold no record, kept beside the quarantine.
CORRUPT = StructType([StructField("line", StringType(), True), StructField(DATE_COL, DateType(), True)])

# Records with fields that did not fit, each with its name and raw text.
FAULTS = ArrayType(StructType([StructField("field", StringType(), True), StructField("raw", StringType(), True)]))
FAULTY = StructType(LANDED.fields + [StructField(FAULTS_COL, FAULTS, True), StructField(DATE_COL, DateType(), True)])

# Runs of page numbers that did not land.
GAPS = StructType([StructField(n, LongType(), True) for n in ("first_missing", "last_missing", "n_missing")]
                  + [StructField(DATE_COL, DateType(), True)])

QUARANTINE = StructType(
    RECORD.fields
    + [StructField(VALID_FLAG, BooleanType(), True), StructField(DATE_COL, DateType(), True)]
)


def _silver_field(f: StructField) -> StructField:
    if f.name in ("longitude", "latitude"):
        return StructField(f.name, FloatType(), True)
    return f


SILVER = StructType(
    [_silver_field(f) for f in RECORD.fields]
    + [StructField(LOCATION_COL, StringType(), True), StructField(DATE_COL, DateType(), True)]
)

GOLD = StructType([
    StructField(TYPE_COL, StringType(), True),
    StructField(LOCATION_COL, StringType(), True),
    StructField(COUNT_COL, LongType(), False),
    StructField(DATE_COL, DateType(), True),
])


def without(schema: StructType, *names: str) -> StructType:
    """``schema`` minus the named fields."""
    return StructType([f for f in schema.fields if f.name not in names])
