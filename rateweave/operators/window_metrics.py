"""Sliding-window metrics per item and per user, and trending items.

The functions here take static or streaming frames. Averages and counts are
combined before the shuffle, so a very frequent item or user leaves each map
task as one row per window it touches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rateweave.functions.scores import trending

WINDOW = "30 seconds"
SLIDE = "10 seconds"


def _windowed(
    events: DataFrame, key: str, size: str, slide: str | None, metrics: dict[str, Column]
) -> DataFrame:
    # One shuffle on (window, key); without a slide the windows tumble.
    return (
        events.groupBy(F.window("event_time", size, slide), key)
        .agg(*[metric.alias(name) for name, metric in metrics.items()])
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            key,
            *metrics,
        )
    )


def item_window_metrics(
    events: DataFrame, size: str = WINDOW, slide: str | None = SLIDE
) -> DataFrame:
    """Average rating (3 digits) and number of interactions per item and window."""
    return _windowed(
        events,
        "item_id",
        size,
        slide,
        {
            "avg_rating": F.round(F.avg("rating"), 3),
            "interaction_count": F.count("*"),
        },
    )


def user_window_metrics(
    events: DataFrame, size: str = WINDOW, slide: str | None = SLIDE
) -> DataFrame:
    """Number of interactions and average rating given per user and window."""
    return _windowed(
        events,
        "user_id",
        size,
        slide,
        {
            "interaction_count": F.count("*"),
            "avg_rating_given": F.round(F.avg("rating"), 3),
        },
    )


def trending_score(item_metrics: DataFrame) -> DataFrame:
    """Add ``trending_score`` to item window metrics."""
    return item_metrics.withColumn(
        "trending_score", trending(F.col("avg_rating"), F.col("interaction_count"))
    )


def trending_top_k(scored: DataFrame, k: int = 5) -> DataFrame:
    """The k best scores; equal scores by window, then item.

    Planned as a top-k per task merged on the driver (k rows per task), not as
    a full sort. For static frames, or one micro-batch of a stream.
    """
    return scored.orderBy(
        F.col("trending_score").desc(), "window_start", "item_id"
    ).limit(k)
