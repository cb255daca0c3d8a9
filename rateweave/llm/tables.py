"""Intermediate tables in the shared folder."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rateweave.session import INITIAL_PARTITIONS, new_scratch, partition_plan, scan_bytes

# Frames without statistics claim to be larger than any table.
UNKNOWN_BYTES = 1 << 60
# Equal rows that stay together.
EQUAL_ROWS = 256


def keep(frame: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """Write a frame to the folder that all executors share, and read it back.

    Later steps then start from files: nothing above is computed twice, values
    drawn per task stay as they are, and a lost executor costs no history.
    """
    path = new_scratch(frame.sparkSession, label)
    frame.write.option("compression", codec).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def id_text(name: str) -> Column:
    """An integer id as text: pandas would make doubles of a column with nulls."""
    return F.col(name).cast("long").cast("string").alias(name)


def text_mark(name: str = "text") -> Column:
    """64-bit hash of a text; tells texts apart that share an id."""
    return F.xxhash64(F.coalesce(F.col(name), F.lit("")))


def whole_rows(docs: DataFrame) -> DataFrame:
    """``row`` with all columns of a document, and ``id`` and ``mark`` to join it by.

    Whatever the documents' columns are called, they cannot clash with a join's own.
    """
    return docs.select(F.struct("*").alias("row"), join_id().alias("id"), text_mark().alias("mark"))


def join_id(name: str = "doc_id") -> Column:
    """An id as text, empty for null: equal where the ids are, with plain equality.

    A null-safe comparison would join by other expressions than the columns
    themselves, and grouping by them afterwards would shuffle the texts again.
    """
    return F.coalesce(F.col(name).cast("long").cast("string"), F.lit(""))


def counted_chunks(frame: DataFrame, keys: Sequence[str], most: int = EQUAL_ROWS) -> DataFrame:
    """``keys``, ``chunk`` and ``times``: equal rows counted, and cut in chunks of at most ``most``.

    A task sends equal rows on as one, and the chunks of a row that is a third of
    the table can be dealt to many groups.
    """
    counted = frame.groupBy(*keys).agg(F.count("*").alias("times"))
    return in_chunks(counted, "times", most)


def in_chunks(counted: DataFrame, times: str, most: int = EQUAL_ROWS) -> DataFrame:
    """A row per ``most`` of the number in column ``times``, numbered by ``chunk``; none for 0."""
    last = F.floor((F.col(times) - 1) / F.lit(most)).cast("long")
    starts = F.when(F.col(times) > 0, F.sequence(F.lit(0).cast("long"), last))
    cut = counted.select("*", F.explode(starts).alias("chunk"))
    return cut.withColumn(times, F.least(F.lit(most), F.col(times) - F.col("chunk") * most).cast("int"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pieces(rows: int, per_piece: int) -> int:
    """Number of groups that hold some ``per_piece`` rows each."""
    return max(1, -(-rows // per_piece))


@contextmanager
def shuffles_sized_for(frame: DataFrame, times: int = 1) -> Iterator[None]:
    """Let shuffles inside start from one partition per 128 MB of ``times`` the input.

    Scans keep the session's split size. AQE merges what turns out small.
    """
    conf, size = frame.sparkSession.conf, times * scan_bytes(frame)
    before = conf.get(INITIAL_PARTITIONS, None)
    if size < UNKNOWN_BYTES:
        own = int(conf.get("spark.sql.shuffle.partitions"))
        conf.set(INITIAL_PARTITIONS, partition_plan(size, own)[INITIAL_PARTITIONS])
    try:
        yield
    finally:
        if before is not None:
            conf.set(INITIAL_PARTITIONS, before)
        else:
            conf.unset(INITIAL_PARTITIONS)
