"""Independent writes at the same time."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")

AT_ONCE = 4


def together(spark: SparkSession, steps: Mapping[str, Callable[[], T]], at_once: int = AT_ONCE) -> dict[str, T]:
    """Run steps that don't need one another, a few at a time, and give their results in the given order.

    The jobs of one step fill the executors that the last tasks of another leave idle. All steps that were
    begun come to their end; those not begun when one fails are left out, and the first failure is raised.
    """
    failed = False

    def run(step: Callable[[], T]) -> T | None:
        nonlocal failed
        if failed:
            return None
        try:
            return step()
        except BaseException:
            failed = True
            raise

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        begun = {name: pool.submit(inheritable_thread_target(spark)(run), step) for name, step in steps.items()}
    for future in begun.values():
        if future.exception() is not None:
            raise future.exception()
    return {name: future.result() for name, future in begun.items()}
