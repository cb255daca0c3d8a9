"""Rating tables and files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateweave.schemas import RATING


def read_rating_lines(spark: SparkSession, path: str) -> DataFrame:
    """Delimited text, one rating per line, as ``value string``."""
    return spark.read.text(path)


def read_lines_with_place(spark: SparkSession, path: str) -> DataFrame:
    """``value``, its ``file`` and the ``block_start`` (byte) of the part a task read.

    ``read_order`` rises by one from line to line of a block; :func:`line_numbers` turns
    it into the line's number.
    """
    return spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("read_order"),
    )


def line_numbers(some: DataFrame, lines: DataFrame) -> DataFrame:
    """``some`` of the ``lines`` read with their place, each with its ``line`` in its block.

    Lines count from 0. One more scan finds where each block begins: a row per block.
    """
    block = ["file", "block_start"]
    first = lines.groupBy(*block).agg(F.min("read_order").alias("first"))
    numbered = some.join(first, block).withColumn("line", F.col("read_order") - F.col("first"))
    return numbered.drop("read_order", "first")


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Cleaned ratings from Parquet, with the declared schema."""
    return spark.read.schema(RATING).parquet(path)
