"""Date helpers (N10, N12, N13, P14). All safe under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_yyyymmdd(c) -> Column:
    """'20240130' (text or integer) -> DATE; bad text -> NULL."""
    return F.try_to_date(_col(c).cast("string"), "yyyyMMdd")


def year_month(d) -> Column:
    """DATE -> 'yyyy-MM'."""
    return F.date_format(_col(d), "yyyy-MM")


def parse_timestamp(c) -> Column:
    """ISO text -> naive timestamp (TIMESTAMP_NTZ, like a parsed ISO string
    without zone); NULL or unparsable -> NULL. Independent of the session
    time zone."""
    return _col(c).cast("string").try_cast("timestamp_ntz")


def display_date(c) -> Column:
    """8-char 'yyyyMMdd' -> 'yyyy-MM-dd'; NULL/'' -> 'N/A'; other text unchanged."""
    s = _col(c).cast("string")
    return (F.when(s.isNull() | (s == ""), F.lit("N/A"))
            .when(F.length(s) == 8,
                  F.concat_ws("-", F.substring(s, 1, 4), F.substring(s, 5, 2),
                              F.substring(s, 7, 2)))
            .otherwise(s))


def ts_text(c) -> Column:
    """TIMESTAMP_NTZ -> 'yyyy-MM-dd HH:mm:ss' without going through the
    session time zone (``date_format`` would, shifting DST-gap times)."""
    return F.substring(_col(c).cast("timestamp_ntz").cast("string"), 1, 19)
