"""Repeated and late events of a stream."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateweave.operators.window_metrics import SLIDE, WINDOW
from rateweave.streaming.shared import NO_BATCH, WriteBatch
from rateweave.streaming.watermark import DELAY

# What makes two records the same event.
EVENT = ("user_id", "item_id", "rating", "event_time")


def without_redelivered(events: DataFrame, keys: Sequence[str] = EVENT) -> DataFrame:
    """Each event once, however often the broker delivers it.

    For a stream with a watermark, ahead of a windowed aggregation in append mode. The
    state holds an event's keys until the watermark has passed it by the watermark's
    delay; what comes again after that is older than the watermark and dropped as late.
    So is a late event that comes for the first time, even if its window is still open.
    Publishing waits for all replicas and may repeat: together, each event counts once.
    """
    return events.dropDuplicatesWithinWatermark(list(keys))


@dataclass(frozen=True)
class LateRows:
    """Handler that keeps the rows a windowed aggregation drops as late.

    For :func:`rateweave.streaming.sinks.for_each_batch` on valid events without
    aggregation, as one of the outputs of :func:`rateweave.streaming.shared.share`, which
    keeps the batch that is looked at more than once. Spark drops a row from a window whose end is not after the watermark
    the *previous* batch had, which is the latest event time of all batches before that
    one, less the delay. This query keeps the latest event time of each of its batches
    in a table and judges by them, so a batch that runs again is judged alike. It agrees
    with an aggregation whose batches are the same: same source, trigger and start.

    Rows go to ``path/late``: the event's columns, ``window_start``, ``window_end``, the
    ``watermark`` that it missed and ``late_by_seconds``, one row for each window. The
    counts of each batch go to ``path/times``.
    """

    path: str
    size: str = WINDOW
    slide: str | None = SLIDE
    delay: str = DELAY

    TIMES = "n_events long, latest timestamp"

    def prepare(self, frame: DataFrame) -> None:
        """Create both tables, without rows."""
        spark = frame.sparkSession
        WriteBatch(f"{self.path}/times").prepare(spark.createDataFrame([], self.TIMES))
        empty = spark.createDataFrame([], frame.schema)
        WriteBatch(f"{self.path}/late").prepare(self.placed(empty, None))

    def placed(self, events: DataFrame, watermark_micros: int | None) -> DataFrame:
        """Each event with each of its windows, and how late it is for it."""
        mark = F.timestamp_micros(F.lit(watermark_micros).cast("long"))
        windowed = events.withColumn("window", F.window("event_time", self.size, self.slide))
        return windowed.select(
            *events.columns, F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"), mark.alias("watermark"),
            (F.unix_micros(mark) / 1e6 - F.unix_micros("window.end") / 1e6).alias("late_by_seconds"),
        )

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        times = batch.agg(F.count("*").alias("n_events"), F.max("event_time").alias("latest"))
        WriteBatch(f"{self.path}/times")(times, batch_id)
        before = spark.read.schema(f"{self.TIMES}, batch_id int").parquet(f"{self.path}/times")
        # The batches before the previous one.
        before = before.where(F.col("batch_id").between(NO_BATCH + 1, batch_id - 2))
        mark = F.unix_micros(F.max("latest") - F.expr(f"INTERVAL {self.delay}"))
        watermark = before.agg(mark.alias("watermark")).first().watermark
        if watermark is None:
            return
        late = self.placed(batch, watermark).where(F.col("window_end") <= F.col("watermark"))
        WriteBatch(f"{self.path}/late", skip_empty=True)(late, batch_id)
