"""Column-level helpers (return ``Column``; all JVM-side built-ins)."""

from .text import strip_ws, first_value, blank_to_null, WS_PATTERN
from .dates import parse_yyyymmdd, year_month, display_date, parse_timestamp
from .codes import decode, strip_prefix, nan_to_null, missing, age_bucket, yes_no

__all__ = [
    "strip_ws", "first_value", "blank_to_null", "WS_PATTERN",
    "parse_yyyymmdd", "year_month", "display_date", "parse_timestamp",
    "decode", "strip_prefix", "nan_to_null", "missing", "age_bucket", "yes_no",
]
