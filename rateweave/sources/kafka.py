"""Event topics. Needs the ``spark-sql-kafka-0-10`` connector on the class path."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def kafka_options(
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
    min_partitions: int | None = None,
    max_offsets_per_trigger: int | None = None,
    more: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader options. By default start at the end of the topic and tolerate
    records the broker has already dropped. ``more`` are any other options of the
    connector, such as ``kafka.security.protocol``; they override the rest.

    ``min_partitions`` above the number of topic partitions splits large ones
    over several tasks, which also evens out a topic keyed by a frequent user.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options | dict(more or {})


def read_kafka_events(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Streaming envelope of a topic; see :func:`kafka_options`."""
    return (
        spark.readStream.format("kafka")
        .options(**kafka_options(servers, topic, **options))
        .load()
        .select("key", "value", "timestamp")
    )
