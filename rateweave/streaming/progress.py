"""Latency and volume of streaming queries, batch by batch."""

from __future__ import annotations

import datetime as dt
import threading
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

PROGRESS_SCHEMA = (
    "query string, run_id string, batch_id bigint, num_input_rows bigint, trigger_ms bigint, "
    "add_batch_ms bigint, state_rows bigint, rows_dropped_late bigint, started timestamp"
)
EVERY_ROWS, EVERY_SECONDS = 500, 60.0


class ProgressTable(StreamingQueryListener):
    """Append the progress of every micro-batch, as Spark reports it, to a table.

    It does not matter how many batches of progress the session itself remembers. Rows
    are written ``every_rows`` together, or when the first of them is ``every_seconds``
    old and Spark reports anything, and whenever a query ends; so a day of many queries
    gives some thousand files, not one for each batch. ``only`` limits it to queries of
    these names. Start it before the queries, and :meth:`wait` for the last rows, since
    Spark reports a batch some time after its end. :meth:`stop` writes what is left.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        only: Sequence[str] = (),
        every_rows: int = EVERY_ROWS,
        every_seconds: float = EVERY_SECONDS,
    ) -> None:
        self.spark, self.path, self.only = spark, path, frozenset(only)
        self.every_rows, self.every_seconds = every_rows, every_seconds
        self.reported: dict[str, int] = {}
        self.change = threading.Condition()
        self.rows: list[tuple] = []
        self.since = time.monotonic()
        self._write([])
        spark.streams.addListener(self)

    def _write(self, rows: list[tuple]) -> None:
        frame = self.spark.createDataFrame(rows, PROGRESS_SCHEMA)
        frame.coalesce(1).write.mode("append").parquet(self.path)

    def flush(self) -> None:
        """Write the rows that wait."""
        with self.change:
            rows, self.rows = self.rows, []
        if rows:
            self._write(rows)

    def _flush_if_due(self) -> None:
        with self.change:
            old = time.monotonic() - self.since >= self.every_seconds
            due = bool(self.rows) and (old or len(self.rows) >= self.every_rows)
        if due:
            self.flush()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        self._flush_if_due()

    def onQueryProgress(self, event) -> None:
        step = event.progress
        if self.only and step.name not in self.only:
            return
        run = str(step.runId)
        times = step.durationMs
        row = (
            step.name, run, step.batchId, step.numInputRows, times.get("triggerExecution"),
            times.get("addBatch"), sum(state.numRowsTotal for state in step.stateOperators),
            sum(state.numRowsDroppedByWatermark for state in step.stateOperators),
            dt.datetime.fromisoformat(step.timestamp),
        )
        with self.change:
            if not self.rows:
                self.since = time.monotonic()
            self.rows.append(row)
            self.reported[run] = step.batchId
            self.change.notify_all()
        self._flush_if_due()

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def wait(self, queries: Sequence[StreamingQuery], seconds: float = 60) -> None:
        """Until the last batch of each query has its row in the table."""
        until = time.monotonic() + seconds
        for query in queries:
            last = query.lastProgress
            while last is not None:
                with self.change:
                    if self.reported.get(str(query.runId), -1) >= last.batchId:
                        break
                    if not self.change.wait(max(0.0, until - time.monotonic())):
                        raise TimeoutError(f"no progress reported for query {query.name}")
        self.flush()

    def stop(self) -> None:
        self.spark.streams.removeListener(self)
        self.flush()


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """One row per micro-batch; a trigger that found no data has none of its own."""
    return spark.read.schema(PROGRESS_SCHEMA).parquet(path)
