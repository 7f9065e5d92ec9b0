"""Counts, trends and top-k.

All are single hash aggregations (partial aggregation before the shuffle);
top-k results are ``orderBy(...).limit(n)`` = TakeOrderedAndProject, which
keeps only ``n`` rows per partition. Ties are always broken by the key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import age_bucket, decode, parse_yyyymmdd, year_month
from .select import SEX_CODES, SEX_DEFAULT


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _numeric(df: DataFrame, col: str, to: str) -> Column:
    """Numeric view of a column that may hold text codes ('1', '2'):
    unparsable text is NULL instead of an ANSI cast error."""
    from pyspark.sql.types import NumericType
    c = F.col(col)
    return c if isinstance(df.schema[col].dataType, NumericType) else c.try_cast(to)


def age_histogram(df: DataFrame, age_col: str = "patientonsetage", width: int = 10) -> DataFrame:
    """A1: rows per ``width``-year bucket, NULL ages excluded, ordered."""
    b = age_bucket(age_col, width)
    return (df.where(b.isNotNull())
              .groupBy(b.alias("age_group"))
              .agg(F.count(F.lit(1)).alias("count"))
              .orderBy("age_group"))


def top_counts(df: DataFrame, key, n: int | None = 10, alias: str = "count",
               key_alias: str | None = None) -> DataFrame:
    """Count per key, most frequent first, key breaks ties.

    A NULL key is its own group (it sorts after non-NULL keys on ties).
    """
    k = _col(key)
    if key_alias:
        k = k.alias(key_alias)
    out = df.groupBy(k).agg(F.count(F.lit(1)).alias(alias))
    kname = out.columns[0]
    out = out.orderBy(F.col(alias).desc(), F.col(kname).asc_nulls_last())
    return out.limit(n) if n else out


def top_products(df: DataFrame, col: str = "medicinalproduct", n: int = 10) -> DataFrame:
    """A3: case-folded product name counts, top ``n``."""
    return top_counts(df, F.lower(F.col(col)), n, key_alias="drug_name")


def monthly_counts(df: DataFrame, date_col: str = "receivedate", alias: str = "reports",
                   yyyymmdd: bool = True) -> DataFrame:
    """A4: rows per 'yyyy-MM' month, ordered (bad dates -> NULL month)."""
    d = parse_yyyymmdd(date_col) if yyyymmdd else F.to_date(F.col(date_col))
    return (df.groupBy(year_month(d).alias("month"))
              .agg(F.count(F.lit(1)).alias(alias))
              .orderBy(F.col("month").asc_nulls_last()))


def count_by_decoded(df: DataFrame, col: str = "patientsex", mapping: Mapping = SEX_CODES,
                     default=SEX_DEFAULT, alias: str = "sex") -> DataFrame:
    """A5: count per decoded code (P13 then group)."""
    return (df.groupBy(decode(col, mapping, default).alias(alias))
              .agg(F.count(F.lit(1)).alias("count"))
              .orderBy(F.col("count").desc(), F.col(alias)))


def count_by_year(df: DataFrame, date_col: str, alias: str = "drug_count") -> DataFrame:
    """Rows per year of ``date_col``, ordered by year."""
    return (df.groupBy(F.year(F.col(date_col)).alias("year"))
              .agg(F.count(F.lit(1)).alias(alias))
              .orderBy(F.col("year").asc_nulls_last()))


def group_summary(df: DataFrame, keys: Sequence[str], serious_col: str = "serious",
                  date_col: str = "receivedate", n: int | None = 50,
                  serious_true=1) -> DataFrame:
    """Per key group: event count, SUM(serious) (a sum of codes, as the
    dashboard shipped it), count of serious = ``serious_true``, first/last
    date as 'yyyyMMdd'; largest groups first, keys break ties. ``date_col`` is a
    date or a 'yyyyMMdd' code (anything else in it is no date); dates are
    aggregated, not their text, so a hash aggregate combines them."""
    s = _numeric(df, serious_col, "long")
    kind = df.schema[date_col].dataType.typeName()
    d = F.col(date_col).cast("date") if kind in ("date", "timestamp", "timestamp_ntz") else parse_yyyymmdd(date_col)
    out = (df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("event_count"),
        F.sum(s).alias("serious_count"),
        F.count_if(s == F.lit(serious_true)).alias("serious_true_count"),
        F.date_format(F.min(d), "yyyyMMdd").alias("first_event"),
        F.date_format(F.max(d), "yyyyMMdd").alias("last_event")))
    out = out.orderBy(F.col("event_count").desc(), *[F.col(k).asc_nulls_last() for k in keys])
    return out.limit(n) if n else out


def trend(df: DataFrame, date_col: str = "receivedate", metric_col: str = "serious",
          group_by: str = "patientsex", limit: int | None = 500,
          yyyymmdd: bool | None = None) -> DataFrame:
    """A10: AVG(metric) per (group, day), newest day first, then group.

    Table, date, metric and group columns are parameters. A ``yyyyMMdd``
    text/integer date is parsed; anything else is cast to DATE.
    """
    if yyyymmdd is None:
        yyyymmdd = date_col == "receivedate"
    d = parse_yyyymmdd(date_col) if yyyymmdd else F.to_date(F.col(date_col))
    out = (df.groupBy(F.col(group_by).alias("group_key"), d.alias("date"))
             .agg(F.avg(_numeric(df, metric_col, "double")).alias("avg_value"))
             .orderBy(F.col("date").desc_nulls_last(), F.col("group_key").asc_nulls_last()))
    return out.limit(limit) if limit else out


def daily_counts(df: DataFrame, ts_col: str, start=None, end=None,
                 alias: str = "count") -> DataFrame:
    """(date, count) per day, optionally within [start, end]."""
    d = F.to_date(F.col(ts_col))
    if start is not None or end is not None:
        df = df.where(d.between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return (df.groupBy(d.alias("date")).agg(F.count(F.lit(1)).alias(alias))
              .orderBy("date"))


def category_counts(df: DataFrame, cat_col: str, ts_col: str | None = None,
                    start=None, end=None) -> DataFrame:
    """(category, count) within a date range."""
    if ts_col is not None and (start is not None or end is not None):
        d = F.to_date(F.col(ts_col))
        df = df.where(d.between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return (df.groupBy(F.col(cat_col).alias("category"))
              .agg(F.count(F.lit(1)).alias("count"))
              .orderBy(F.col("count").desc(), F.col("category").asc_nulls_last()))


def kpis(daily: DataFrame, date_col: str = "date", count_col: str = "count") -> DataFrame:
    """Total records, distinct dates, latest date of a daily series."""
    return daily.agg(F.sum(count_col).alias("total_records"),
                     F.count_distinct(date_col).alias("unique_dates"),
                     F.max(date_col).alias("latest_date"))
