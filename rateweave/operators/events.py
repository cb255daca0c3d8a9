"""Broker records to validated events, and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateweave.functions.event_time import event_time
from rateweave.functions.once import computed_once
from rateweave.operators.cleaning import (
    HIGHEST_RATING,
    LOWEST_RATING,
    filter_rating_range,
)
from rateweave.schemas import EVENT_JSON


def parse_events(envelope: DataFrame) -> DataFrame:
    """Envelope -> ``user_id, item_id, rating, event_time``.

    Text that is not the expected JSON gives null fields, never an error.
    """
    bodies = envelope.select(
        F.from_json(F.col("value").cast("string"), EVENT_JSON).alias("body"),
        F.col("timestamp").alias("ingest_time"),
    )
    return computed_once(
        bodies,
        "body.user_id",
        "body.item_id",
        "body.rating",
        event_time(F.col("body.timestamp"), F.col("ingest_time")).alias("event_time"),
    )


def valid_events(
    events: DataFrame, lo: float = LOWEST_RATING, hi: float = HIGHEST_RATING
) -> DataFrame:
    """Keep events with every field present and a rating in ``[lo, hi]``."""
    complete = events.dropna(subset=["user_id", "item_id", "rating", "event_time"])
    return filter_rating_range(complete, lo, hi)


def to_kafka_envelope(records: DataFrame, num_partitions: int) -> DataFrame:
    """Event records -> ``key, value, partition`` as the Kafka sink takes them.

    The key is the user id as text, and all events of a user go to partition
    ``user_id mod num_partitions``, so the broker keeps their order.
    """
    return records.select(
        F.col("user_id").cast("string").alias("key"),
        F.to_json(F.struct(*EVENT_JSON.fieldNames())).alias("value"),
        F.pmod(F.col("user_id"), F.lit(num_partitions)).cast("int").alias("partition"),
    )
