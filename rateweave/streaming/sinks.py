"""Start one streaming query. Every query has a checkpoint, so it can resume."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

Trigger = Mapping[str, Any]
BatchHandler = Callable[[DataFrame, int], None]

EVERY_10_SECONDS: Trigger = {"processingTime": "10 seconds"}
EVERY_30_SECONDS: Trigger = {"processingTime": "30 seconds"}
# Work off what is there, then stop.
ONCE_THROUGH: Trigger = {"availableNow": True}


def _writer(
    frame: DataFrame, name: str, mode: str, checkpoint: str, trigger: Trigger
) -> DataStreamWriter:
    return (
        frame.writeStream.queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
    )


def to_console(
    frame: DataFrame,
    name: str,
    checkpoint: str,
    trigger: Trigger = EVERY_10_SECONDS,
    mode: str = "update",
    num_rows: int = 20,
) -> StreamingQuery:
    """Print up to ``num_rows`` whole rows of each micro-batch."""
    writer = _writer(frame, name, mode, checkpoint, trigger)
    return (
        writer.format("console").option("truncate", "false").option("numRows", num_rows).start()
    )


def to_parquet_append(
    frame: DataFrame,
    name: str,
    path: str,
    checkpoint: str,
    trigger: Trigger = EVERY_30_SECONDS,
) -> StreamingQuery:
    """Append final rows to a Parquet folder, each exactly once (file sink)."""
    writer = _writer(frame, name, "append", checkpoint, trigger)
    return writer.format("parquet").option("path", path).start()


def for_each_batch(
    frame: DataFrame,
    name: str,
    handler: BatchHandler,
    checkpoint: str,
    trigger: Trigger = EVERY_10_SECONDS,
    mode: str = "update",
) -> StreamingQuery:
    """Hand each micro-batch, as a static frame, to ``handler``.

    A batch may be handed over again after a failure: handlers must give the
    same result for the same batch id, and should compute the whole batch. Those
    made by :func:`rateweave.streaming.shared.share` do both. A handler with a
    ``prepare`` method creates its tables before the query starts.
    """
    prepare = getattr(handler, "prepare", None)
    if prepare is not None:
        prepare(frame)
    return _writer(frame, name, mode, checkpoint, trigger).foreachBatch(handler).start()
