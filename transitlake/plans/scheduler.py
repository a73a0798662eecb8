"""Timed jobs on threads of the driver; each submits Spark jobs of its own, in a fair pool."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, field

logger = logging.getLogger(__name__)

#: (seconds, function, name, keyword arguments)
Schedule = tuple[float, Callable, str, dict]


@dataclass
class _Job:
    seconds: float
    run: Callable
    name: str
    kwargs: dict
    due: float
    future: Future | None = field(default=None)


class Scheduler:
    """Runs each job every so many seconds, the first time after as many. A job that still runs is not begun again.

    ``lifecycle`` has (name, callback) pairs that are called after every tick; one that returns something false ends it.
    """

    def __init__(self, lifecycle: list[tuple[str, Callable[[], bool]]] | None = None, workers: int = 8, clock: Callable[[], float] = time.monotonic, pause: float = 1.0):
        self.lifecycle, self.clock, self.pause = lifecycle or [], clock, pause
        self.jobs: list[_Job] = []
        self.running = False
        self._pool = ThreadPoolExecutor(workers, thread_name_prefix="lake")

    def add_schedules(self, schedules: list[Schedule]) -> None:
        for seconds, run, name, kwargs in schedules:
            self.jobs.append(_Job(seconds, run, name, kwargs, self.clock() + seconds))
            logger.info("%s every %s seconds", name, seconds)

    def _begin(self, job: _Job) -> None:
        def guarded() -> None:
            try:
                job.run(**job.kwargs)
            except Exception:
                logger.exception("%s failed", job.name)

        job.future = self._pool.submit(guarded)

    def tick(self) -> int:
        """Begins what is due; how many jobs that were."""
        begun, now = 0, self.clock()
        for job in self.jobs:
            if now >= job.due:
                job.due = now + job.seconds
                if job.future is None or job.future.done():
                    self._begin(job)
                    begun += 1
        return begun

    def start(self) -> None:
        """Ticks until stopped, by ``stop``, a callback or an interrupt."""
        self.running = True
        try:
            while self.running:
                self.tick()
                time.sleep(self.pause)
                for name, callback in self.lifecycle:
                    if not callback():
                        logger.info("%s ends the run", name)
                        self.stop()
                        break
        except KeyboardInterrupt:
            self.stop()

    def stop(self) -> None:
        """Forgets all jobs, and waits a little for those that run."""
        self.running = False
        futures = [j.future for j in self.jobs if j.future is not None]
        self.jobs = []
        for f in futures:
            f.cancel()
        end = time.monotonic() + 5
        while time.monotonic() < end and not all(f.done() for f in futures):
            time.sleep(0.05)
        self._pool.shutdown(wait=False, cancel_futures=True)
