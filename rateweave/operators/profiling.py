"""Descriptive statistics of a rating table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dataset_cardinality(ratings: DataFrame) -> DataFrame:
    """One row: ratings, distinct users, distinct items and matrix sparsity.

    Sparsity is null for an empty table.
    """
    counts = ratings.agg(
        F.count("*").alias("n_ratings"),
        F.count_distinct("user_id").alias("n_users"),
        F.count_distinct("item_id").alias("n_items"),
    )
    cells = F.col("n_users").cast("double") * F.col("n_items").cast("double")
    filled = F.try_divide(F.col("n_ratings").cast("double"), cells)
    return counts.withColumn("sparsity", F.lit(1.0) - filled)


def rating_summary(ratings: DataFrame) -> DataFrame:
    """One typed row: count, mean, sample standard deviation, min and max."""
    rating = F.col("rating").cast("double")
    return ratings.agg(
        F.count(rating).alias("n"),
        F.avg(rating).alias("mean"),
        F.stddev_samp(rating).alias("stddev"),
        F.min(rating).alias("min_rating"),
        F.max(rating).alias("max_rating"),
    )


def rating_distribution(ratings: DataFrame) -> DataFrame:
    """``rating, count`` in rating order."""
    return ratings.groupBy("rating").count().orderBy("rating")


def distinct_counts(ratings: DataFrame, **columns: Sequence[str]) -> DataFrame:
    """One row: for each name how many different rows its columns have, rows with nulls left out.

    Each count is a pass and a shuffle of its own columns alone. ``ratings`` is read once
    for each: keep it where it is costly.
    """
    counts = [
        ratings.select(*names).dropna().distinct().agg(F.count("*").alias(name)) for name, names in columns.items()
    ]
    return reduce(DataFrame.crossJoin, counts)
