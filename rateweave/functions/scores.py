"""Score and message expressions on windowed metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed texts of the alerts.
ITEM_ALERT = "ALERT: Item %s is trending — avg_rating = %s (threshold ≥ {threshold})"
USER_ALERT = "ALERT: User %s spike — %s interactions in window"


def trending(avg_rating: Column, interactions: Column) -> Column:
    """``avg * ln(1 + n)`` to 3 digits: needs both a good average and volume."""
    return F.round(avg_rating * F.log1p(interactions.cast("double")), 3)


def item_alert_message(item_id: Column, avg_rating: Column, threshold: float) -> Column:
    text = ITEM_ALERT.format(threshold=threshold)
    return F.format_string(text, item_id.cast("string"), avg_rating.cast("string"))


def user_alert_message(user_id: Column, interactions: Column) -> Column:
    return F.format_string(USER_ALERT, user_id.cast("string"), interactions.cast("string"))
