"""Independent Spark jobs at the same time."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def together(spark: SparkSession, *jobs: Callable[[], object]) -> None:
    """Run jobs that do not depend on each other concurrently, so that one job's last tasks and
    commit do not leave the executors idle. Raises the first error after all have ended."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    for job in running:
        job.result()
