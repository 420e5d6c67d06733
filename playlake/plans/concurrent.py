"""Submit independent Spark jobs together.

The three endpoints of a layer (or the three Gold tables) do not depend on
each other. Started from separate driver threads, their jobs share the
executors instead of queueing behind each other's last, straggling tasks.
The driver only coordinates; all data work stays in the executors.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

T = TypeVar("T")


def run_all(jobs: Mapping[str, Callable[[], T]], max_parallel: int = 4) -> dict[str, T]:
    """Run every job, at most ``max_parallel`` at a time; re-raise the first failure."""
    if len(jobs) <= 1 or max_parallel <= 1:
        return {name: job() for name, job in jobs.items()}
    with ThreadPoolExecutor(max_workers=min(max_parallel, len(jobs))) as pool:
        futures = {name: pool.submit(job) for name, job in jobs.items()}
        return {name: fut.result() for name, fut in futures.items()}
