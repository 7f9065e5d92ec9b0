"""Running sums and dense ids over an order that no single task could hold.

The rows are range-partitioned by group and order, so that a task holds a stretch of the
order. The sums of a group's stretches give each stretch its offset: a table with a row
per task and group, over which a window is small. Inside a stretch the sum runs on. The stretches are
written before they are used, so a lost executor cannot deal them anew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..session import ensure_checkpoint_dir

_PARTITION = 33  # monotonically_increasing_id has the partition from this bit on


def prefix_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, str]) -> DataFrame:
    """``df`` with, for every item ``value: name`` of ``values``, the sum of ``value`` over the rows that come
    before it in ``order`` within its group of ``keys``. Rows of equal ``keys`` and ``order`` must have been
    combined before; NULL keys are a group of their own."""
    ensure_checkpoint_dir(df.sparkSession)
    keys, order = list(keys), list(order)
    rows = (df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
            .withColumn("_at", F.monotonically_increasing_id()).checkpoint(eager=True)
            .withColumn("_part", F.shiftright("_at", _PARTITION)))
    parts = rows.groupBy(*keys, "_part").agg(*[F.sum(v).alias(f"_s{i}") for i, v in enumerate(values)])
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_part").alias("_p"),
                         *[F.coalesce(F.sum(f"_s{i}").over(before), F.lit(0)).alias(f"_o{i}") for i in range(len(values))])
    on = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    inner = Window.partitionBy(*keys, "_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    out = rows.join(parts, on)
    return out.select(*df.columns, *[(F.col(f"_o{i}") + F.coalesce(F.sum(v).over(inner), F.lit(0))).alias(name)
                                     for i, (v, name) in enumerate(values.items())])


def dense_ids(values: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "id") -> DataFrame:
    """The distinct rows of (``keys``, ``order``) numbered 0, 1, ... in ``order`` within each group."""
    d = values.select(*keys, *order).distinct().withColumn("_one", F.lit(1).cast("long"))
    return prefix_sums(d, keys, order, {"_one": name}).drop("_one")
