"""Column expressions: typed casts, trimming, dates, code labels.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; nothing here runs Python per row.
"""

from arrivals_mart.functions.columns import (
    SAS_EPOCH,
    as_double,
    as_int,
    as_text,
    calendar_columns,
    char_date,
    day_number_range,
    day_number_to_date,
    trimmed,
    valid_day_number,
)
from arrivals_mart.functions.labels import (
    TRAVEL_MODE_DEFAULT,
    TRAVEL_MODE_LABELS,
    VISA_DEFAULT,
    VISA_LABELS,
    code_label,
)

__all__ = [
    "SAS_EPOCH",
    "as_double",
    "as_int",
    "as_text",
    "calendar_columns",
    "char_date",
    "day_number_range",
    "day_number_to_date",
    "trimmed",
    "valid_day_number",
    "TRAVEL_MODE_DEFAULT",
    "TRAVEL_MODE_LABELS",
    "VISA_DEFAULT",
    "VISA_LABELS",
    "code_label",
]
