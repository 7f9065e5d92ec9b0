"""Query registry shared by the plan modules."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import path_exists, scratch_path
from ..sources.tables import read_table

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name`` with its oracle SQL."""
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query name {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def r6(c):
    """Round a computed double to 6 places (same rounding in the oracle SQL)."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new folder under the session's shared checkpoint dir."""
    return scratch_path(spark, f"{label}-{uuid.uuid4().hex[:12]}")


def shared_input(spark: SparkSession, sf_dir: str, label: str, write: Callable[[str], None]) -> str:
    """The folder of input files that ``write(path)`` makes from the tables of ``sf_dir``: written by the
    first query of an application that needs them and read by all (its ``_SUCCESS`` file tells)."""
    app = spark.sparkContext.applicationId
    path = scratch_path(spark, f"{label}-{app}-{zlib.crc32(sf_dir.encode()):08x}")
    if not path_exists(spark, f"{path}/_SUCCESS"):
        write(path)
    return path
