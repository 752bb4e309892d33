"""Column expressions: all native Spark functions, no Python UDFs."""

from strata.functions.dates import date_literal, day_label, run_date, stamp_date
from strata.functions.numeric import FLOAT_TEXT, is_float_text, lenient_float
from strata.functions.text import empty_to_null, fill_null, location_label

__all__ = [
    "FLOAT_TEXT", "date_literal", "day_label", "empty_to_null", "fill_null",
    "is_float_text", "lenient_float", "location_label", "run_date", "stamp_date",
]
