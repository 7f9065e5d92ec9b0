"""Window operators over pre-aggregated series.

These run on per-day / per-point rows (one row per series per time step),
never on raw events, so each window partition is small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def rolling_mean(series: DataFrame, value_col: str = "count", order_col: str = "date",
                 n: int = 7, partition: Sequence[str] = (), alias: str = "rolling_avg") -> DataFrame:
    """Mean of the last ``n`` rows (row-based, not day-based); NULL until
    ``n`` rows exist."""
    w = Window.partitionBy(*partition).orderBy(order_col).rowsBetween(-(n - 1), 0)
    return series.withColumn(
        alias, F.when(F.count(F.col(value_col)).over(w) == n, F.avg(F.col(value_col)).over(w)))


def history_mean(points: DataFrame, keys: Sequence[str], order_col: str,
                 value_col: str = "value", window: int = 10) -> DataFrame:
    """Mean of up to ``window - 1`` earlier points (``[-window:-1]``)."""
    w = Window.partitionBy(*keys).orderBy(order_col).rowsBetween(-(window - 1), -1)
    return (points.withColumn("historical_mean", F.avg(F.col(value_col)).over(w))
                  .withColumn("n_history", F.count(F.col(value_col)).over(w)))


def trend_label(points: DataFrame, keys: Sequence[str], order_col: str,
                value_col: str = "value") -> DataFrame:
    """Trend of the last three values per key.

    Non-decreasing -> 'improving' (tested first, so all-equal is improving),
    non-increasing -> 'declining', otherwise or fewer than 3 -> 'stable'.
    """
    w = Window.partitionBy(*keys).orderBy(order_col)
    v = F.col(value_col)
    lagged = (points.withColumn("_p1", F.lag(v, 1).over(w))
                    .withColumn("_p2", F.lag(v, 2).over(w)))
    last = (lagged.groupBy(*keys)
            .agg(F.max_by(F.struct(v.alias("v0"), F.col("_p1").alias("p1"),
                                   F.col("_p2").alias("p2")), F.col(order_col)).alias("_l")))
    v0, p1, p2 = F.col("_l.v0"), F.col("_l.p1"), F.col("_l.p2")
    have3 = p1.isNotNull() & p2.isNotNull()
    label = (F.when(have3 & (p1 >= p2) & (v0 >= p1), F.lit("improving"))
              .when(have3 & (p1 <= p2) & (v0 <= p1), F.lit("declining"))
              .otherwise(F.lit("stable")))
    return last.select(*keys, label.alias("trend"))
