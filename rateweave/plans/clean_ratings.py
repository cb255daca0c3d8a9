"""Batch job: rating lines to a clean table and its profile."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateweave.operators.cleaning import (
    dedup_latest,
    drop_null_ratings,
    filter_rating_range,
    parse_rating_lines,
    stage_counts,
)
from rateweave.operators.profiling import (
    dataset_cardinality,
    rating_distribution,
    rating_summary,
)
from rateweave.session import sized_for
from rateweave.sinks.tables import write_ratings
from rateweave.sources.ratings import read_rating_lines, read_ratings


@dataclass(frozen=True)
class CleanReport:
    """Small frames, computed from the lines and the written table."""

    funnel: DataFrame
    cardinality: DataFrame
    summary: DataFrame
    distribution: DataFrame


def clean_ratings(
    spark: SparkSession,
    lines_path: str,
    out_path: str,
    num_files: int | None = None,
    delimiter: str = "::",
) -> CleanReport:
    """Parse, validate, deduplicate and write; report on what was written.

    The data is shuffled once, for the deduplication. The profile reads single
    columns of the written table; the funnel needs one scan of the lines and the
    row count in the Parquet footers.
    """
    lines = read_rating_lines(spark, lines_path)
    parsed = parse_rating_lines(lines, delimiter)
    kept = filter_rating_range(drop_null_ratings(parsed))
    with sized_for(lines):
        write_ratings(dedup_latest(kept), out_path, num_files)

    ratings = read_ratings(spark, out_path)
    final_count = F.lit(ratings.count()).cast("bigint")
    funnel = stage_counts(parsed).select(
        "raw_count",
        "null_dropped",
        "range_dropped",
        (F.col("valid_count") - final_count).alias("duplicate_dropped"),
        final_count.alias("final_count"),
    )
    # Distinct counts and groups shuffle the table: they run in its sizing too.
    with sized_for(lines):
        return CleanReport(
            funnel=_computed(funnel),
            cardinality=_computed(dataset_cardinality(ratings)),
            summary=_computed(rating_summary(ratings)),
            distribution=_computed(rating_distribution(ratings)),
        )


def _computed(report: DataFrame) -> DataFrame:
    """A report of one row, or one per rating value, as a frame of its own."""
    return report.sparkSession.createDataFrame(report.collect(), report.schema)
