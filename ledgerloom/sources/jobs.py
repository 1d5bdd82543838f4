"""Independent jobs side by side, and what they leave behind."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Result = TypeVar("Result")
POOL = "spark.scheduler.pool"
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_lock = threading.Lock()
_inside: dict[SparkSession, tuple[int, str | None]] = {}  # how many, and the setting before them


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within, a job's shuffle files go when it ends, not when the driver collects its
    garbage, which may be never.

    A setting of the session, put back by the last of several that overlap.
    """
    with _lock:
        count, before = _inside.get(spark, (0, None))
        if not count:
            before = spark.conf.get(CLEAN_UP, None)
            spark.conf.set(CLEAN_UP, "true")
        _inside[spark] = count + 1, before
    try:
        yield
    finally:
        with _lock:
            count, before = _inside.pop(spark)
            if count > 1:
                _inside[spark] = count - 1, before
            elif before is None:
                spark.conf.unset(CLEAN_UP)
            else:
                spark.conf.set(CLEAN_UP, before)


def side_by_side(spark: SparkSession, jobs: Mapping[str, Callable[[], Result]]) -> dict[str, Result]:
    """The result of every job, by name; all of them are submitted at once.

    Each runs in the scheduler pool of its name: with ``spark.scheduler.mode``
    FAIR they share the executors evenly, without it a job fills what the ones
    before it leave free.  If some fail, the others still end, and the first
    error in the order of ``jobs`` is raised.
    """
    context = spark.sparkContext

    def pooled(name: str, job: Callable[[], Result]) -> Callable[[], Result]:
        def run() -> Result:
            context.setLocalProperty(POOL, name)
            try:
                return job()
            finally:
                context.setLocalProperty(POOL, None)

        return inheritable_thread_target(spark)(run)

    with ThreadPoolExecutor(max(len(jobs), 1), "side-by-side") as threads:
        running = {name: threads.submit(pooled(name, job)) for name, job in jobs.items()}
    return {name: done.result() for name, done in running.items()}
