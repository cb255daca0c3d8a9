"""Shape order and event tables as rating lines and broker records.

Both adapters add defects (bad or missing fields, broken text, unusable
timestamps) by key, so that the cleaning steps have something to reject. No row
is left out. They are row-wise, so the second also works on a stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def lines_from_orders(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """One ``customer::part::quantity/10::order time`` line per line item."""
    rating = (
        F.when(F.col("l_orderkey") % 97 == 0, F.lit("bad"))
        .when(F.col("l_orderkey") % 101 == 0, F.lit("NaN"))
        .otherwise((F.col("l_quantity") / 10).cast("string"))
    )
    # concat_ws leaves nulls out: these lines have three fields.
    ordered_at = F.when(
        F.col("l_orderkey") % 89 != 0,
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")).cast("string"),
    )
    joined = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        F.concat_ws(
            "::",
            F.col("o_custkey").cast("string"),
            F.col("l_partkey").cast("string"),
            rating,
            ordered_at,
        ).alias("value")
    )


def rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`lines_from_orders` on the tables in ``sf_dir``."""
    return lines_from_orders(
        spark.read.parquet(f"{sf_dir}/lineitem.parquet"),
        spark.read.parquet(f"{sf_dir}/orders.parquet"),
    )


def records_from_events(events: DataFrame) -> DataFrame:
    """Event rows -> ``event_id, ts, user_id, item_id, rating, timestamp`` (JSON fields).

    Ratings are half stars that fall with ``value``; high values give ratings
    below the valid range.
    """
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("user_id").cast("int").alias("user_id"),
        F.get_json_object("props", "$.k").cast("int").alias("item_id"),
        (F.lit(5.0) - F.floor(F.col("value") / 10) / 2).cast("float").alias("rating"),
        F.concat(
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00")
        ).alias("timestamp"),
    )


def envelope_from_events(events: DataFrame) -> DataFrame:
    """Event rows as broker records, taken in five seconds after the event."""
    defect = F.col("event_id") % 50
    body = F.to_json(
        F.struct(
            "user_id",
            "item_id",
            # to_json leaves null fields out.
            F.when(defect != 2, F.col("rating")).alias("rating"),
            F.when(defect == 3, F.lit("n/a")).otherwise(F.col("timestamp")).alias("timestamp"),
        )
    )
    return records_from_events(events).select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.when(defect == 1, F.lit("not json")).otherwise(body).cast("binary").alias("value"),
        (F.col("ts") + F.expr("INTERVAL 5 SECONDS")).alias("timestamp"),
    )


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`envelope_from_events` on the table in ``sf_dir``."""
    return envelope_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))
