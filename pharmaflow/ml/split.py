"""Seeded, stratified train/test split and k-fold ids (M1, M9).

Rows are ordered inside their class by ``md5(seed|key)``. The rank of a row
in that order is computed without sorting a whole class in one task: rows are
counted by the first hex digits of the hash, buckets that hold more than
``bucket_rows`` are counted again by more digits, prefix counts of the buckets
give their offsets, and rows are ranked only inside their bucket. The result equals
``row_number() OVER (PARTITION BY class ORDER BY md5)`` exactly, so a SQL oracle
exists, while a class holding all rows is still spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import ensure_checkpoint_dir

BUCKET_ROWS = 200_000  # rows that are ranked together at most, but for equal hashes
DIGITS = 3  # hex digits per level: a bucket has 4,096 parts
_HASH = 32  # digits of a hash


def hash_key(key_cols: Sequence[str], seed: int = 42):
    parts = [F.lit(str(seed))] + [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key_cols]
    return F.md5(F.concat_ws("|", *parts))


def _same(left: str, right: str) -> Column:
    """NULL classes are a stratum of their own."""
    return F.col(left).eqNullSafe(F.col(right))


def _buckets(h: DataFrame, bucket_rows: int, digits: int) -> tuple[DataFrame, list[DataFrame]]:
    """Buckets (class, prefix, offset, class size) of at most ``bucket_rows`` rows, and of every level the
    prefixes that were too full. A level's windows run over the 16^digits parts of one bucket."""
    counts = h.groupBy("_cls", F.substring("_h", 1, digits).alias("_b")).agg(F.count(F.lit(1)).alias("_nb"))
    top = Window.partitionBy("_cls")
    level = counts.select("_cls", "_b", "_nb", F.coalesce(F.sum("_nb").over(
        top.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"), F.sum("_nb").over(top).alias("_n_class"))
    leaves, full, depth = [], [], digits
    while True:
        level = level.checkpoint(eager=True)
        over = (F.col("_nb") > bucket_rows) & F.lit(depth < _HASH)
        leaves.append(level.where(~over))
        parents = level.where(over).select(F.col("_cls").alias("_pc"), F.col("_b").alias("_pb"), F.col("_off").alias("_po"), F.col("_n_class"))
        if parents.isEmpty():
            break
        full.append(parents)
        rows = h.withColumn("_pre", F.substring("_h", 1, depth))
        depth += digits
        counts = (rows.join(parents, _same("_cls", "_pc") & (F.col("_pre") == F.col("_pb")))
                  .groupBy("_cls", "_pb", "_po", "_n_class", F.substring("_h", 1, depth).alias("_b")).agg(F.count(F.lit(1)).alias("_nb")))
        siblings = Window.partitionBy("_cls", "_pb").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        level = counts.select("_cls", "_b", "_nb", (F.col("_po") + F.coalesce(F.sum("_nb").over(siblings), F.lit(0))).alias("_off"), "_n_class")
    out = leaves[0]
    for more in leaves[1:]:
        out = out.unionByName(more)
    return out, full


def stratified_rank(df: DataFrame, class_col: str | None, key_cols: Sequence[str],
                    seed: int = 42, bucket_rows: int = BUCKET_ROWS, digits: int = DIGITS) -> DataFrame:
    """Add ``_h`` (md5 text), ``_rank`` (0-based rank inside the class) and
    ``_n_class`` (class size). ``class_col=None`` ranks all rows as one class. No sort
    holds more than ``bucket_rows`` rows unless their hashes are equal."""
    ensure_checkpoint_dir(df.sparkSession)
    cls = F.col(class_col) if class_col else F.lit(0)
    h = df.withColumn("_cls", cls).withColumn("_h", hash_key(key_cols, seed))
    leaves, full = _buckets(h.select("_cls", "_h"), bucket_rows, digits)
    h = h.withColumn("_b", F.substring("_h", 1, digits))
    for level, parents in enumerate(full):  # rows of a full bucket go by a longer prefix
        more = parents.select("_pc", "_pb")
        h = h.join(more, _same("_cls", "_pc") & (F.col("_b") == F.col("_pb")), "left").withColumn(
            "_b", F.when(F.col("_pb").isNotNull(), F.substring("_h", 1, digits * (level + 2))).otherwise(F.col("_b"))).drop("_pc", "_pb")
    offsets = leaves.select(F.col("_cls").alias("_cls2"), F.col("_b").alias("_b2"), "_off", "_n_class")
    inb = Window.partitionBy("_cls", "_b").orderBy("_h", *key_cols)
    ranked = (h.join(offsets, _same("_cls", "_cls2") & (F.col("_b") == F.col("_b2")))
               .withColumn("_rank", F.col("_off") + F.row_number().over(inb) - 1))
    return ranked.drop("_b", "_off", "_cls", "_cls2", "_b2")


def train_test_split(df: DataFrame, target: str | None, key_cols: Sequence[str],
                     test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """M1: add ``split`` = 'test' | 'train'. Per class, the first
    ``ceil(test_size * n_class)`` rows in hash order are test rows, so class
    shares are kept (stratified) and the split is reproducible by seed.
    Rows with a NULL target form their own stratum."""
    r = stratified_rank(df, target, key_cols, seed)
    k = F.ceil(F.col("_n_class") * F.lit(test_size))
    return (r.withColumn("split", F.when(F.col("_rank") < k, F.lit("test")).otherwise(F.lit("train")))
             .drop("_h", "_rank", "_n_class"))


def fold_ids(df: DataFrame, target: str | None, key_cols: Sequence[str], k: int = 5,
             seed: int = 42, col: str = "fold") -> DataFrame:
    """M9: ``fold`` in 0..k-1, dealt round-robin in hash order inside each
    class (stratified); ``target=None`` gives plain k-fold."""
    r = stratified_rank(df, target, key_cols, seed)
    return r.withColumn(col, (F.col("_rank") % F.lit(k)).cast("int")).drop("_h", "_rank", "_n_class")


def weight_table(df: DataFrame, target: str, col: str = "weight") -> DataFrame:
    """Balanced weights n / (n_classes * n_class), a row per class."""
    counts = df.where(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).alias("_nc"))
    total = counts.agg(F.sum("_nc").alias("_n"), F.count(F.lit(1)).alias("_k"), F.lit(1).alias("_one"))  # one row
    d = counts.withColumn("_one", F.lit(1)).join(F.broadcast(total), "_one")
    return d.select(target, (F.col("_n") / (F.col("_k") * F.col("_nc"))).alias(col))


def class_weights(df: DataFrame, target: str, col: str = "weight", few: bool = False) -> DataFrame:
    """Balanced weights as a column (M5, M6): the table of the classes joined back on
    the class value; broadcast if the classes are known to be ``few``, else the rows of a class meet in a task."""
    weights = weight_table(df, target, col)
    return df.join(F.broadcast(weights) if few else weights, target, "left")
