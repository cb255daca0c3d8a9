"""Saved models."""

from __future__ import annotations

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, StructField, StructType

from rateweave.schemas import RANKED, RECOMMENDATIONS


def load_model(path: str) -> ALSModel:
    """Load a saved factor model."""
    return ALSModel.load(path)


def read_recommendations(spark: SparkSession, path: str) -> DataFrame:
    """``user_id, recommendations, bucket`` as saved by :func:`save_recommendations`."""
    schema = StructType([*RECOMMENDATIONS.fields, StructField("bucket", IntegerType())])
    return spark.read.schema(schema).parquet(f"{path}/candidates")


def saved_depth(spark: SparkSession, path: str) -> tuple[int, int]:
    """Items per user and number of buckets of saved recommendations."""
    about = spark.read.parquet(f"{path}/about").first()
    return about["depth"], about["buckets"]


def read_ranked(spark: SparkSession, path: str) -> DataFrame:
    """``user_id, recommendations`` as saved by :func:`save_ranked`."""
    return spark.read.schema(RANKED).parquet(f"{path}/ranked")


def ranked_depth(spark: SparkSession, path: str) -> tuple[int, int | None]:
    """Items per user, and digits of the ratings, of saved ranked lists."""
    about = spark.read.parquet(f"{path}/about").first()
    return about["depth"], about["digits"]
