"""Threshold alerts on window metrics (static or streaming)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateweave.functions.scores import item_alert_message, user_alert_message

ITEM_RATING_THRESHOLD = 4.5
ITEM_MIN_INTERACTIONS = 3
USER_ACTIVITY_THRESHOLD = 3


def item_alerts(
    item_metrics: DataFrame,
    threshold: float = ITEM_RATING_THRESHOLD,
    min_count: int = ITEM_MIN_INTERACTIONS,
) -> DataFrame:
    """Items whose (rounded) window average reaches the threshold.

    ``min_count`` keeps windows with hardly any vote from raising an alert.
    """
    return item_metrics.filter(
        (F.col("avg_rating") >= threshold) & (F.col("interaction_count") >= min_count)
    ).select(
        "window_start",
        "window_end",
        "item_id",
        "avg_rating",
        "interaction_count",
        item_alert_message(F.col("item_id"), F.col("avg_rating"), threshold).alias("alert_msg"),
    )


def user_alerts(user_metrics: DataFrame, threshold: int = USER_ACTIVITY_THRESHOLD) -> DataFrame:
    """Users with at least ``threshold`` interactions in a window."""
    return user_metrics.filter(F.col("interaction_count") >= threshold).select(
        "window_start",
        "window_end",
        "user_id",
        "interaction_count",
        user_alert_message(F.col("user_id"), F.col("interaction_count")).alias("alert_msg"),
    )
