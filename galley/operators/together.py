"""Independent Spark jobs submitted at the same time."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Result = TypeVar("Result")


def together(actions: Mapping[str, Callable[[], Result]], at_once: int = 8) -> dict[str, Result]:
    """Run named actions side by side and return their results by name.

    Small tables then do not wait for one another; the cluster shares its slots among the
    jobs as it does among any others. The first error is raised once all have ended.
    """
    session = SparkSession.getActiveSession()
    inherit = inheritable_thread_target(session) if session else (lambda action: action)
    with ThreadPoolExecutor(at_once) as pool:
        running = {name: pool.submit(inherit(action)) for name, action in actions.items()}
    return {name: future.result() for name, future in running.items()}
