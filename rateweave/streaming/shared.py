"""Several outputs from one streaming query.

Outputs with the same aggregation and output mode share a query: the source is
read and parsed once for all of them and the windowed state is held once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from rateweave.streaming.sinks import BatchHandler

# The folder that holds a table's schema before, and besides, its batches.
NO_BATCH = -1


@dataclass(frozen=True)
class Output:
    """What to derive from a micro-batch and where it goes."""

    derive: Callable[[DataFrame], DataFrame]
    handle: BatchHandler


def unchanged(batch: DataFrame) -> DataFrame:
    return batch


@dataclass(frozen=True)
class WriteBatch:
    """Write each batch below ``path/batch_id=<id>``.

    A batch that runs again replaces its own folder, so every row is there once.
    ``skip_empty`` saves the file of a batch without rows, but looks at the frame
    an extra time: for frames that are cheap to derive from a kept batch.
    """

    path: str
    skip_empty: bool = False

    def prepare(self, frame: DataFrame) -> None:
        """Create the table, without rows, so that it can be read before any batch."""
        empty = frame.sparkSession.createDataFrame([], frame.schema)
        empty.write.mode("ignore").parquet(f"{self.path}/batch_id={NO_BATCH}")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if not (self.skip_empty and batch.isEmpty()):
            batch.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")


def write_batch(path: str, skip_empty: bool = False) -> WriteBatch:
    return WriteBatch(path, skip_empty)


def show_batch(title: str, num_rows: int = 20) -> BatchHandler:
    """Print the first rows of each batch that has any."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            print(f"{title} (batch {batch_id})")
            batch.show(num_rows, truncate=False)

    return handle


class Share:
    """One handler for all outputs: the batch is computed once, then reused.

    Counting the batch computes all of it first, so that no output that looks at
    a few rows decides how much of the batch, and of its state, is computed.
    """

    def __init__(self, outputs: Sequence[Output]) -> None:
        self.outputs = tuple(outputs)

    def prepare(self, frame: DataFrame) -> None:
        """Let each output that makes a table create it; ``frame`` is the stream."""
        for output in self.outputs:
            prepare = getattr(output.handle, "prepare", None)
            if prepare is not None:
                prepare(output.derive(frame))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if kept.count() == 0:
                return
            for output in self.outputs:
                output.handle(output.derive(kept), batch_id)
        finally:
            kept.unpersist()


def share(outputs: Sequence[Output]) -> Share:
    return Share(outputs)
