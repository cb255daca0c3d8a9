"""Batch writers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_ratings(ratings: DataFrame, path: str, num_files: int | None = None) -> None:
    """Overwrite a Parquet table of ratings.

    Without ``num_files`` the files follow the partitions of the deduplication,
    which AQE has already sized; a number costs one more shuffle.
    """
    sized = ratings if num_files is None else ratings.repartition(num_files)
    sized.write.mode("overwrite").parquet(path)


def write_metrics(spark: SparkSession, path: str, **metrics: float) -> None:
    """Overwrite a one-row JSON table of named numbers, to 4 digits."""
    row = spark.range(1).select(
        *[F.round(F.lit(float(value)), 4).alias(name) for name, value in metrics.items()]
    )
    row.write.mode("overwrite").json(path)


def kafka_writer_options(
    servers: str, topic: str, more: Mapping[str, str] | None = None
) -> dict[str, str]:
    """Writer options: wait for all replicas. ``more`` overrides."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all"}
    return options | dict(more or {})


def write_kafka(
    envelope: DataFrame, servers: str, topic: str, more: Mapping[str, str] | None = None
) -> None:
    """Publish ``key, value, partition`` rows to a topic."""
    envelope.write.format("kafka").options(**kafka_writer_options(servers, topic, more)).save()
