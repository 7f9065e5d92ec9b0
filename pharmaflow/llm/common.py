"""Registry and small helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_path
from ..sources.tables import read_table

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}

# Word separators of every operator here: space, tab, LF, VT, FF, CR.
WS = " \t\n\x0b\x0c\r"
WORD_RE = r"[^\x20\x09-\x0D]+"


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name`` with its oracle SQL."""
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query name {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def words(text: Column) -> Column:
    """Words of a text: maximal runs without white space; NULL text has none."""
    spaced = F.translate(F.coalesce(text, F.lit("")), WS, " " * len(WS))
    return F.array_remove(F.split(spaced, " "), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def has_word(s: Column) -> Column:
    return F.translate(s, WS, "") != ""


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` under the session's shared checkpoint folder and read it
    back: later steps neither recompute it nor depend on the executors that
    made it."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{label}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


_WRITTEN: list[str] = []  # folders of ``saved`` that are still there


def saved_alone(make: Callable[[], DataFrame], label: str) -> DataFrame:
    """``saved(make(), label)``; the folders written on the way to it are deleted once it is there."""
    before = len(_WRITTEN)
    out = saved(make(), label)
    jvm = out.sparkSession.sparkContext._jvm
    for path in _WRITTEN[before:-1]:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(out.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    del _WRITTEN[before:-1]
    return out


def broadcast_if(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """A broadcast hint for a written table of narrow rows, once they are counted and
    few; beyond ``rows`` Spark plans a shuffled join."""
    return F.broadcast(df) if df.count() <= rows else df


def evaluated(df: DataFrame) -> DataFrame:
    """``df`` behind an explode of one struct. Spark moves a later filter below
    projections by repeating their expressions at every mention, which for nested
    array functions is worse than linear; it does not move one below a generator."""
    return df.select(F.explode(F.array(F.struct("*"))).alias("_row")).select("_row.*")


def carry(df: DataFrame, *extra: Column) -> DataFrame:
    """All input columns packed into ``row`` beside ``extra``, so that no input
    name can clash with a working column; ``unpack`` restores them."""
    return df.select(F.struct("*").alias("row"), *extra)


def unpack(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col("row").getField(c).alias(c) for c in columns])
