"""Projections, filters, limits and search."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..functions import codes, dates


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def project(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Keep ``columns`` (None or empty = all)."""
    return df.select(*columns) if columns else df


def filter_eq(df: DataFrame, filters: Mapping[str, object] | None) -> DataFrame:
    """AND of ``col = v`` (str/number/bool) and ``col IN (...)`` (list).

    Values of other types are ignored. Built as Column expressions, so no
    SQL text is ever assembled from user input.
    """
    if not filters:
        return df
    cond = None
    for name, value in filters.items():
        if isinstance(value, bool):  # a bool filters as the number 0/1
            c = F.col(name) == F.lit(int(value))
        elif isinstance(value, (str, int, float)):
            c = F.col(name) == F.lit(value)
        elif isinstance(value, (list, tuple)):
            c = F.col(name).isin(list(value))
        else:
            continue
        cond = c if cond is None else cond & c
    return df if cond is None else df.where(cond)


def take(df: DataFrame, n: int | None, order: Sequence | None = None) -> DataFrame:
    """First ``n`` rows by ``order`` (a top-k, planned as
    TakeOrderedAndProject); no ``n`` = all rows."""
    if not n:
        return df
    if order:
        df = df.orderBy(*order)
    return df.limit(int(n))


def select_table(catalog, name: str, columns=None, filters=None, limit=None,
                 order=None) -> DataFrame:
    """P1+P2+P4 over a catalog table (S6): the loader's ``load_data``."""
    df = catalog.table(name)
    df = filter_eq(df, filters)
    df = project(df, columns)
    return take(df, limit, order)


def browse(df: DataFrame, predicate: str | Column | None = None, size: int = 100,
           order: Sequence | None = None) -> DataFrame:
    """P5: free predicate (SQL expression text or Column) + row cap.

    The table itself only comes through the catalog; the predicate is parsed
    as a Spark SQL expression, never spliced into a statement.
    """
    if predicate is not None:
        df = df.where(F.expr(predicate) if isinstance(predicate, str) else predicate)
    return take(df, size, order)


def date_range(df: DataFrame, col: str, start, end, tie: Sequence[str] = ()) -> DataFrame:
    """``col BETWEEN start AND end ORDER BY col``."""
    c = F.col(col)
    return df.where(c.between(F.lit(start), F.lit(end))).orderBy(c, *tie)


def search(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """Case-insensitive LIKE."""
    return df.where(F.col(col).ilike(pattern))


def recent(df: DataFrame, date_col: str, as_of=None, months: int = 12,
           columns: Sequence[str] | None = None, tie: Sequence[str] = ()) -> DataFrame:
    """Rows with ``date >= as_of - months``, newest first.
    ``as_of`` defaults to ``current_date()``."""
    ref = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    out = df.where(F.col(date_col) >= F.add_months(ref, -months))
    out = project(out, columns)
    return out.orderBy(F.col(date_col).desc(), *tie)


def drop_null_target(df: DataFrame, target: str, cast: str = "int") -> DataFrame:
    """Drop rows whose target is NULL; cast the target (bad text -> dropped)."""
    return (df.withColumn(target, F.col(target).try_cast(cast))
              .where(F.col(target).isNotNull()))


def nan_to_null_all(df: DataFrame) -> DataFrame:
    """Every float/double column's NaN becomes NULL."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(codes.nan_to_null(F.col(f.name)).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# Report sex codes as decoded by the dashboard SQL.
SEX_CODES = {"1": "Male", "2": "Female"}
SEX_DEFAULT = "Unknown"


def decode_column(df: DataFrame, col: str, mapping: Mapping = SEX_CODES,
                  default=SEX_DEFAULT, alias: str | None = None) -> DataFrame:
    """add/replace a decoded column."""
    return df.withColumn(alias or col, codes.decode(col, mapping, default))


def newest_events(df: DataFrame, ts_col: str, n: int = 20,
                  product_cols: Sequence[str] = ("medicinalproduct", "brand_name"),
                  serious_col: str = "serious", tie: Sequence[str] = (),
                  columns: Sequence[str] | None = None) -> DataFrame:
    """Newest-first event view with display fallbacks.

    ``product`` = first non-empty of ``product_cols`` else 'N/A';
    ``serious_label`` = 'Yes' when serious = 1 else 'No'.
    """
    prod = F.coalesce(*[F.nullif(F.col(c).cast("string"), F.lit("")) for c in product_cols],
                      F.lit("N/A"))
    out = df.select(*(columns or df.columns),
                    prod.alias("product"),
                    codes.yes_no(serious_col).alias("serious_label"))
    return out.orderBy(F.col(ts_col).desc(), *tie).limit(n)


def display_dates(df: DataFrame, col: str, alias: str | None = None) -> DataFrame:
    """P14: 'yyyyMMdd' -> 'yyyy-MM-dd', empty -> 'N/A'."""
    return df.withColumn(alias or col, dates.display_date(col))
