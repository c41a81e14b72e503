"""Submission of independent Spark jobs from one driver."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

_POOL = "spark.scheduler.pool"


def run_each(spark: SparkSession, function: Callable[[Any], Any], items: Iterable[Any], parallel: int = 1) -> list:
    """Results of ``function`` in the order of ``items``; up to ``parallel`` calls submit their jobs at a time.

    Each call has a scheduler pool of its own. In a session with ``spark.scheduler.mode=FAIR`` pools share the executors
    evenly, so a small call ends while a large one goes on; with the default mode jobs run first come, first served.
    """
    if parallel <= 1:
        return [function(item) for item in items]

    def pooled(numbered: tuple[int, Any]) -> Any:
        context = spark.sparkContext
        context.setLocalProperty(_POOL, f"twincheck-{numbered[0]}")
        try:
            return function(numbered[1])
        finally:
            context.setLocalProperty(_POOL, None)

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        # Wrapped one by one: calls that share a wrapper also share its local properties.
        calls = [pool.submit(inheritable_thread_target(spark)(pooled), item) for item in enumerate(items)]
        return [call.result() for call in calls]
