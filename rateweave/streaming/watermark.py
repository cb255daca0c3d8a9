"""Late data."""

from __future__ import annotations

from pyspark.sql import DataFrame

DELAY = "1 minute"


def with_event_watermark(events: DataFrame, delay: str = DELAY) -> DataFrame:
    """Let windowed state go ``delay`` behind the latest event time.

    A windowed aggregation drops a row once its window's end is behind the
    watermark, which moves between micro-batches; stateless queries drop nothing.
    Append mode gives a window out once, when the watermark has passed its end.
    """
    return events.withWatermark("event_time", delay)
