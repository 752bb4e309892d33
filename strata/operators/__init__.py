"""DataFrame -> DataFrame operators."""

from strata.operators.aggregate import group_count
from strata.operators.dedupe import dedupe_by_key
from strata.operators.quality import (
    DataQualityError,
    check_null_rates,
    invalid_count,
    null_audit,
    observed,
    require_columns,
)
from strata.operators.quarantine import flag_validity, invalid_rows, quarantine_of
from strata.operators.report import gold_report, sample_rows

__all__ = [
    "DataQualityError", "check_null_rates", "dedupe_by_key", "flag_validity",
    "gold_report", "group_count", "invalid_count", "invalid_rows", "null_audit",
    "observed", "quarantine_of", "require_columns", "sample_rows",
]
