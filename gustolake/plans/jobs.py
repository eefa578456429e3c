"""Submit independent Spark actions concurrently.

A SparkContext accepts jobs from several driver threads at once; independent
writes (the three bronze tables, the three silver tables, the gold tables once
their shared inputs are staged) then share the executors instead of waiting
for each other's small final stages. The first failure is re-raised.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

R = TypeVar("R")
DEFAULT_CONCURRENCY = 8


def run_all(tasks: dict[str, Callable[[], R]], max_workers: int = DEFAULT_CONCURRENCY) -> dict[str, R]:
    if max_workers <= 1 or len(tasks) <= 1:
        return {name: fn() for name, fn in tasks.items()}
    with ThreadPoolExecutor(max_workers=max_workers, thread_name_prefix="gustolake-job") as pool:
        futures = {name: pool.submit(fn) for name, fn in tasks.items()}
        return {name: f.result() for name, f in futures.items()}
