"""Restart streaming queries that fail."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

POOL = "spark.scheduler.pool"


@dataclass
class Supervised:
    """A query under supervision: how to start it, and what became of it.

    ``start`` must give a query with a checkpoint, always the same one: a restart goes
    on where the failed run stopped, and what that run had not committed runs again.
    """

    start: Callable[[], StreamingQuery]
    query: StreamingQuery | None = None
    failures: int = 0
    errors: list[str] = field(default_factory=list)
    wake_at: float | None = None
    done: bool = False


class Supervisor:
    """Run named queries, each in a scheduler pool of its own, until they end.

    A query that fails is started again after ``first_wait`` seconds, twice that after
    the next failure in a row, and so on up to ``longest_wait``; a batch in between
    begins the count anew. After ``limit`` failures in a row it is given up, the other
    queries are stopped and its error is raised. With the fair scheduler
    (``spark.scheduler.mode=FAIR``) the pools share the executors evenly; else they have
    no effect.
    """

    def __init__(
        self,
        spark: SparkSession,
        starts: Mapping[str, Callable[[], StreamingQuery]],
        limit: int = 5,
        first_wait: float = 1.0,
        longest_wait: float = 60.0,
    ) -> None:
        self.spark, self.limit = spark, limit
        self.first_wait, self.longest_wait = first_wait, longest_wait
        self.jobs = {name: Supervised(start) for name, start in starts.items()}

    def _start(self, name: str, job: Supervised) -> None:
        context = self.spark.sparkContext
        before = context.getLocalProperty(POOL)
        # A query's thread takes over the properties of the thread that starts it.
        context.setLocalProperty(POOL, name)
        try:
            job.query, job.wake_at = job.start(), None
        finally:
            context.setLocalProperty(POOL, before)

    def start(self) -> None:
        for name, job in self.jobs.items():
            self._start(name, job)

    def look(self) -> None:
        """Once over all queries: note what ended, start what is due."""
        now = time.monotonic()
        for name, job in self.jobs.items():
            if job.done:
                continue
            if job.wake_at is not None:
                if now >= job.wake_at:
                    self._start(name, job)
                continue
            if job.query.isActive:
                continue
            error = job.query.exception()
            if error is None:
                job.done = True
                continue
            job.failures = 1 if job.query.lastProgress is not None else job.failures + 1
            job.errors.append(str(error))
            if job.failures >= self.limit:
                raise error
            wait = min(self.longest_wait, self.first_wait * 2 ** (job.failures - 1))
            job.wake_at = now + wait

    def run(self, poll_seconds: float = 0.5) -> None:
        """Until every query has ended by itself, or one is given up."""
        self.start()
        try:
            while True:
                self.look()
                if all(job.done for job in self.jobs.values()):
                    return
                time.sleep(poll_seconds)
        finally:
            self.stop()

    def stop(self) -> None:
        for job in self.jobs.values():
            if job.query is not None:
                job.query.stop()
