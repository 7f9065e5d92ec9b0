"""Text cleaning: whitespace strip and first-value extraction."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, DataType, StringType

# Whitespace as Python's str.strip() sees it (ASCII controls, separators and
# the Unicode space separators). Spark's trim() only removes ' '.
WS_CLASS = r"[\t\n\x0B\f\r\x1c-\x1f\x85\p{Z}]"
WS_PATTERN = rf"^{WS_CLASS}+|{WS_CLASS}+$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Remove leading/trailing whitespace (all kinds), null stays null."""
    return F.regexp_replace(_col(c), WS_PATTERN, "")


def blank_to_null(c) -> Column:
    """'' becomes NULL (what a CSV round trip would do)."""
    return F.nullif(_col(c), F.lit(""))


def first_value(c, dtype: DataType | None = None) -> Column:
    """First list item, stripped; a plain string, stripped; else NULL.

    ``dtype`` is the column's type. Arrays use ``try_element_at`` so an empty
    array gives NULL instead of an error under ANSI mode.
    """
    col = _col(c)
    if isinstance(dtype, ArrayType):
        return strip_ws(F.try_element_at(col, F.lit(1)).cast("string"))
    if dtype is None or isinstance(dtype, StringType):
        return strip_ws(col)
    return F.lit(None).cast("string")
