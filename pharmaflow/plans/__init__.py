"""Registered queries over the driver tables, each paired with DuckDB SQL.

``REGISTRY[name] = (fn(spark, sf_dir) -> DataFrame, oracle_sql or None)``.
Importing this package registers every plan module.
"""

from .registry import REGISTRY, register  # noqa: F401
from . import relational, etl, quality_drift, ml_plans  # noqa: F401
