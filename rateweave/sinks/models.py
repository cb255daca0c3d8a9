"""Model writers."""

from __future__ import annotations

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def save_model(model: ALSModel, path: str) -> None:
    """Save a factor model, replacing one at the same path."""
    model.write().overwrite().save(path)


# Folders of a small model's candidates; take more where they are large.
BUCKETS = 64


def user_bucket(buckets: int) -> Column:
    """Which folder a user's candidates are in."""
    return F.pmod(F.hash("user_id"), F.lit(buckets)).alias("bucket")


def save_recommendations(
    recommendations: DataFrame, path: str, depth: int, buckets: int = BUCKETS
) -> None:
    """Write ``user_id, recommendations`` once per model, for lookup by user.

    A folder per bucket of users, so that a lookup reads the buckets of its users
    only. ``depth`` is how many items per user were asked for; it is kept beside
    the rows, with the number of buckets.
    """
    bucketed = recommendations.withColumn("bucket", user_bucket(buckets))
    (
        bucketed.repartition(buckets, "bucket")
        .write.mode("overwrite")
        .partitionBy("bucket")
        .parquet(f"{path}/candidates")
    )
    about = recommendations.sparkSession.range(1).select(
        F.lit(depth).alias("depth"), F.lit(buckets).alias("buckets")
    )
    about.write.mode("overwrite").parquet(f"{path}/about")


# Rows of a page, the least that a lookup by user reads.
PAGE_ROWS = 512


def save_ranked(lists: DataFrame, path: str, depth: int, digits: int | None) -> None:
    """Write ``user_id, recommendations`` for point lookups, clustered by user.

    Files, row groups and pages hold a range of users each, and row groups a Bloom
    filter of them: a reader that asks for a few ids skips the rest. There are as many
    files as the shuffle has partitions of the advised size, whatever the size. The
    lists have ``depth`` items in ranking order, with ratings rounded to ``digits``.
    """
    in_order = lists.select("user_id", "recommendations").repartitionByRange("user_id")
    (
        in_order.sortWithinPartitions("user_id")
        .write.mode("overwrite")
        .option("parquet.bloom.filter.enabled#user_id", "true")
        .option("parquet.page.row.count.limit", PAGE_ROWS)
        .parquet(f"{path}/ranked")
    )
    about = lists.sparkSession.range(1).select(
        F.lit(depth).alias("depth"), F.lit(digits).cast("int").alias("digits")
    )
    about.write.mode("overwrite").parquet(f"{path}/about")
