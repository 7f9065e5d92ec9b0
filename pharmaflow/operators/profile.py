"""Table profile and load guard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def profile(df: DataFrame) -> DataFrame:
    """One row per column (position, column, type, nullable) with the
    table's row count. The schema part needs no scan; the count is one
    aggregate. Rows are produced by exploding a literal array on the 1-row
    aggregate (no join)."""
    cols = F.array(*[
        F.struct(F.lit(i + 1).alias("position"), F.lit(f.name).alias("column"),
                 F.lit(f.dataType.simpleString()).alias("type"),
                 F.lit(bool(f.nullable)).alias("nullable"))
        for i, f in enumerate(df.schema.fields)])
    return (df.agg(F.count(F.lit(1)).alias("rows"))
              .select(F.explode(cols).alias("c"), "rows")
              .select("c.*", "rows"))


def sample_rows(df: DataFrame, n: int = 5, order: Sequence[str] = ()) -> DataFrame:
    """The profile's sample rows; with ``order`` the first ``n`` in it (a top-n, no
    full sort), else any ``n``."""
    return (df.orderBy(*order) if order else df).limit(n)


def class_check(df: DataFrame, target: str, min_classes: int = 2) -> DataFrame:
    """(rows, classes, ok) in one aggregate; NULL targets are not a class."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.count_distinct(F.col(target)).alias("classes")).select(
        "rows", "classes",
        ((F.col("rows") > 0) & (F.col("classes") >= min_classes)).alias("ok"))


def require_classes(df: DataFrame, target: str, min_classes: int = 2) -> DataFrame:
    """Raise if ``df`` is empty, or if ``target`` exists and has fewer
    than ``min_classes`` distinct non-NULL values; returns ``df`` unchanged."""
    if target not in df.columns:
        if df.isEmpty():
            raise RuntimeError("query returned no rows")
        return df
    row = class_check(df, target, min_classes).first()
    if row["rows"] == 0:
        raise RuntimeError("query returned no rows")
    if row["classes"] < min_classes:
        raise RuntimeError(f"'{target}' has fewer than {min_classes} classes")
    return df
