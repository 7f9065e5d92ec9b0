"""Operators of a training-data pipeline over documents, pages and embeddings.

``REGISTRY[name] = (fn(spark, sf_dir) -> DataFrame, oracle_sql or None)``.
Nothing outside this subpackage imports it, but for ``__spark_entry__`` and
``corpus_pipeline``.
"""

from .common import REGISTRY  # noqa: F401
from . import (quality_rules, line_dedup, minhash, mixing, sentencepiece_scan, embedding_dedup, warc, pii, quality_gam,  # noqa: F401
               html_gbt, filter_audit, exact_dedup, periodic_runs)  # noqa: F401
