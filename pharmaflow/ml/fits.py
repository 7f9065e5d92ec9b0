"""Several fits at once, each as a job group of its own."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

PARALLELISM = 3


def run_fits(spark: SparkSession, fits: Mapping[str, Callable[[], object]], parallelism: int = PARALLELISM) -> dict:
    """{name: (result, None or the error, seconds)} of all ``fits``, in their order.

    Up to ``parallelism`` run at a time, so that the small jobs of one fit fill the gaps of another. Each
    has its own scheduler pool (they share the cores evenly where ``spark.scheduler.mode`` is FAIR)
    and job group. A fit that fails is recorded, the jobs it has left are cancelled, and the
    others go on.
    """
    sc = spark.sparkContext

    def one(name: str, fit: Callable[[], object]):
        group = f"fit-{name}-{uuid.uuid4().hex[:8]}"
        sc.setJobGroup(group, f"fit {name}", interruptOnCancel=True)
        sc.setLocalProperty("spark.scheduler.pool", f"fit-{name}")
        began = time.time()
        try:
            return fit(), None, time.time() - began
        except Exception as e:  # recorded, not raised
            sc.cancelJobGroup(group)
            return None, e, time.time() - began
        finally:
            sc.setLocalProperty("spark.scheduler.pool", None)
            sc.setLocalProperty("spark.jobGroup.id", None)

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        waiting = {name: pool.submit(inheritable_thread_target(spark)(one), name, fit) for name, fit in fits.items()}
        return {name: w.result() for name, w in waiting.items()}
