"""Submit independent Spark jobs side by side.

Jobs that share no data (the three feed landings, the four gold tables) are
submitted from a small thread pool; the scheduler runs their stages
concurrently, so one job's planning, commit and straggler tail overlap the
others' work instead of leaving executors idle.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor


def run_all(jobs: dict[str, Callable[[], object]], max_workers: int = 4) -> dict[str, float]:
    """Run every job; return each one's wall time. Re-raises the first error."""

    def timed(fn: Callable[[], object]) -> float:
        t0 = time.perf_counter()
        fn()
        return time.perf_counter() - t0

    if not jobs:
        return {}
    with ThreadPoolExecutor(max_workers=min(max_workers, len(jobs))) as pool:
        futures = {name: pool.submit(timed, fn) for name, fn in jobs.items()}
        return {name: f.result() for name, f in futures.items()}
