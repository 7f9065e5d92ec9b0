"""Keep-first / keep-best row per key.

A ``row_number() = 1`` window: Spark plans a partial group limit before the
shuffle, so a hot key sends one candidate row per input partition, and another
one behind it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def _norm(order) -> list[tuple[str, bool]]:
    out = []
    for o in order:
        out.append((o, True) if isinstance(o, str) else (o[0], bool(o[1])))
    return out


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence,
               keep_columns: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys``: the first by ``order``.

    ``order`` items are column names (ascending) or ``(name, ascending)``.
    NULL keys form one group (NULLs compare equal, as in pandas
    ``drop_duplicates``). The order must be total within a key for the
    result to be deterministic.
    """
    w = Window.partitionBy(*keys).orderBy(
        *[F.col(n).asc() if a else F.col(n).desc() for n, a in _norm(order)])
    cols = list(keep_columns or df.columns)
    return (df.withColumn("_rn", F.row_number().over(w))
              .where(F.col("_rn") == 1).select(*cols))


def latest_per_group(df: DataFrame, keys: Sequence[str], ts_col: str,
                     tie: Sequence[str] = ()) -> DataFrame:
    """Newest row per key (ties: smallest ``tie`` values win)."""
    order = [(ts_col, False)] + [(t, True) for t in tie]
    return keep_first(df, keys, order)


def best_per_group(df: DataFrame, keys: Sequence[str], metric: str,
                   ascending: bool = False, tie: Sequence[str] = ()) -> DataFrame:
    """Best row per key by ``metric`` (rows lacking it are skipped);
    on equal metric the first by ``tie`` is kept."""
    order = [(metric, ascending)] + [(t, True) for t in tie]
    return keep_first(df.where(F.col(metric).isNotNull()), keys, order)
