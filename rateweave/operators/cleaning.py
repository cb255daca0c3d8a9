"""Parse, validate and deduplicate ratings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rateweave.functions.once import computed_once
from rateweave.functions.text import rating_fields, split_line
from rateweave.schemas import RATING

LOWEST_RATING = 0.5
HIGHEST_RATING = 5.0


def parse_rating_lines(lines: DataFrame, delimiter: str = "::") -> DataFrame:
    """``value string`` -> ``user_id, item_id, rating, timestamp``; bad fields are null."""
    parts = lines.select(split_line(F.col("value"), delimiter).alias("parts"))
    return computed_once(parts, *rating_fields(F.col("parts")))


def drop_null_ratings(ratings: DataFrame) -> DataFrame:
    """Keep rows whose four fields are all present; a NaN rating counts as missing."""
    return ratings.dropna(subset=RATING.fieldNames())


def filter_rating_range(
    ratings: DataFrame, lo: float = LOWEST_RATING, hi: float = HIGHEST_RATING
) -> DataFrame:
    """Keep ratings in ``[lo, hi]``, bounds included."""
    return ratings.filter(F.col("rating").between(lo, hi))


def dedup_latest(ratings: DataFrame) -> DataFrame:
    """One row per (user, item): the latest, and of equal times the highest rating.

    One shuffle on the pair. The maximum is also taken before the shuffle, so a
    pair that holds much of the table leaves each map task as a single row.
    """
    latest = F.max(F.struct("timestamp", "rating")).alias("latest")
    return (
        ratings.groupBy("user_id", "item_id")
        .agg(latest)
        .select("user_id", "item_id", "latest.rating", "latest.timestamp")
    )


def clean(lines: DataFrame, delimiter: str = "::") -> DataFrame:
    """All four cleaning steps in order."""
    parsed = parse_rating_lines(lines, delimiter)
    return dedup_latest(filter_rating_range(drop_null_ratings(parsed)))


def _has_null() -> Column:
    """What :func:`drop_null_ratings` drops; it takes NaN for missing too."""
    present = ~F.coalesce(F.isnan("rating"), F.lit(False))
    for name in RATING.fieldNames():
        present = present & F.col(name).isNotNull()
    return ~present


def _rejected_by(lo: float, hi: float) -> Column:
    """Which step drops a parsed row; null for rows that pass both filters."""
    return F.when(_has_null(), "null").when(~F.col("rating").between(lo, hi), "range")


def rejected_lines(
    lines: DataFrame,
    delimiter: str = "::",
    lo: float = LOWEST_RATING,
    hi: float = HIGHEST_RATING,
) -> DataFrame:
    """The lines that cleaning drops, with the reason, the fields at fault and their place.

    ``lines`` are those of :func:`rateweave.sources.ratings.read_lines_with_place`, whose
    other columns are kept. The reason is ``null`` or ``range``, as in the funnel: what
    the funnel counts as dropped at these steps is here, and every other line is kept.
    """
    place = [name for name in lines.columns if name != "value"]
    parts = lines.select("value", *place, split_line(F.col("value"), delimiter).alias("parts"))
    parsed = computed_once(parts, "value", *place, *rating_fields(F.col("parts")))
    missing = [
        F.when(F.col(name).isNull() | (F.isnan(name) if name == "rating" else F.lit(False)), F.lit(name))
        for name in RATING.fieldNames()
    ]
    reason = _rejected_by(lo, hi)
    fields = F.when(reason == "range", F.array(F.lit("rating"))).otherwise(
        F.array_compact(F.array(*missing))
    )
    judged = parsed.select("value", *place, reason.alias("reason"), fields.alias("fields"))
    return judged.where(F.col("reason").isNotNull())


def stage_counts(
    parsed: DataFrame, lo: float = LOWEST_RATING, hi: float = HIGHEST_RATING
) -> DataFrame:
    """One row ``raw_count, null_dropped, range_dropped, valid_count``.

    A scan and partial counts, no shuffle of the data.
    """
    reason = _rejected_by(lo, hi)
    return parsed.agg(
        F.count("*").alias("raw_count"),
        F.count_if(reason == "null").alias("null_dropped"),
        F.count_if(reason == "range").alias("range_dropped"),
        F.count_if(reason.isNull()).alias("valid_count"),
    )


def preprocess_funnel(
    parsed: DataFrame, lo: float = LOWEST_RATING, hi: float = HIGHEST_RATING
) -> DataFrame:
    """Rows lost at each cleaning step, in one pass over the parsed rows.

    Rejected rows share one group per reason; valid rows are counted per pair.
    The second level then only adds up group sizes.
    """
    reason = _rejected_by(lo, hi)
    groups = (
        parsed.select(
            reason.alias("reason"),
            F.when(reason.isNull(), F.col("user_id")).alias("user_id"),
            F.when(reason.isNull(), F.col("item_id")).alias("item_id"),
        )
        .groupBy("reason", "user_id", "item_id")
        .count()
    )
    n = F.col("count")
    valid = F.col("reason").isNull()

    def total(rows: Column, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(rows, value)), F.lit(0)).cast("bigint")

    return groups.agg(
        F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("raw_count"),
        total(F.col("reason") == "null", n).alias("null_dropped"),
        total(F.col("reason") == "range", n).alias("range_dropped"),
        total(valid, n - 1).alias("duplicate_dropped"),
        F.count_if(valid).alias("final_count"),
    )
