"""Code decoding and small value mappings (P12, P13, N9, A1 bucket)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode(c, mapping: Mapping, default=None) -> Column:
    """CASE c WHEN k THEN v ... ELSE default END (NULL input -> default)."""
    col = _col(c)
    expr = None
    for k, v in mapping.items():
        expr = (F.when(col == F.lit(k), F.lit(v)) if expr is None
                else expr.when(col == F.lit(k), F.lit(v)))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def strip_prefix(c, prefix: str = "Patient/") -> Column:
    """Remove every occurrence of ``prefix`` (reference ids 'Patient/x' -> 'x')."""
    return F.replace(_col(c), F.lit(prefix), F.lit(""))


def nan_to_null(c) -> Column:
    """Float NaN -> NULL (JSON has no NaN)."""
    return F.nanvl(_col(c), F.lit(None).cast("double"))


def missing(df: DataFrame, c: str) -> Column:
    """Whether a value is missing: NULL, or NaN in a float column."""
    null = F.col(c).isNull()
    return null | F.isnan(c) if isinstance(df.schema[c].dataType, (DoubleType, FloatType)) else null


def age_bucket(c, width: int = 10) -> Column:
    """Round half to even to an integer, then floor to ``width`` buckets.

    Matches a SQL ``x::int / 10 * 10`` on a float column (cast rounds).
    """
    # text ages; unparsable or out of range -> NULL
    n = F.rint(_col(c).try_cast("double")).try_cast("int")
    # n - n % w truncates toward zero, like SQL integer division.
    return n - (n % F.lit(width))


def yes_no(c, yes_value=1) -> Column:
    """1 -> 'Yes', anything else -> 'No' (dashboard display of ``serious``)."""
    return F.when(_col(c) == F.lit(yes_value), F.lit("Yes")).otherwise(F.lit("No"))
