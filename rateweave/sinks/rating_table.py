"""A table of latest ratings that new lines are merged into.

The table is bucketed by user and item. A merge shuffles the new ratings only: old ones
are read where they lie, bucket by bucket, and of their folders only those are read and
written again that new ratings belong to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rateweave.operators.cleaning import dedup_latest
from rateweave.schemas import RATING

PAIR = ("user_id", "item_id")
FOLDERS = 16
BUCKETS = 32


class RatingTable:
    """Latest ratings under ``path``, known to the session as ``name``.

    ``folders`` (by user) bounds how much of the table a small merge touches,
    ``buckets`` (by pair) are the tasks of a large one; both are fixed when the table is
    made, and files are one per folder and bucket: choose them for the size the table
    will have. Open it with the numbers it was made with.
    """

    def __init__(
        self, spark: SparkSession, name: str, path: str, folders: int = FOLDERS, buckets: int = BUCKETS
    ) -> None:
        self.spark, self.name, self.folders = spark, name, folders
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RATING.fields)
        pair = ", ".join(PAIR)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}, folder INT) USING parquet "
            f"PARTITIONED BY (folder) CLUSTERED BY ({pair}) SORTED BY ({pair}) INTO {buckets} BUCKETS "
            f"LOCATION '{path}'"
        )
        # Nothing is added, but the path is there then, to look for folders in.
        spark.createDataFrame([], spark.table(name).schema).write.insertInto(name)
        spark.catalog.recoverPartitions(name)

    def read(self) -> DataFrame:
        """All latest ratings."""
        return self.spark.table(self.name).drop("folder")

    def folder(self) -> Column:
        return F.pmod(F.hash("user_id"), F.lit(self.folders)).alias("folder")

    def merged(self, ratings: DataFrame, folders: list[int]) -> DataFrame:
        """Old rows of some folders and new ones, the latest of each pair.

        The old side of the join has no exchange: it is bucketed by the join's keys.
        """
        old = self.spark.table(self.name).where(F.col("folder").isin(folders))
        old = old.select(*PAIR, F.struct("timestamp", "rating").alias("old"))
        new = dedup_latest(ratings).select(*PAIR, F.struct("timestamp", "rating").alias("new"))
        both = old.join(new, list(PAIR), "full_outer")
        latest = F.greatest("old", "new").alias("latest")
        return both.select(*PAIR, latest).select(
            *PAIR, "latest.rating", "latest.timestamp", self.folder()
        )

    def merge(self, ratings: DataFrame) -> list[int]:
        """Take in ratings, cleaned but for repeats; the folders written.

        Of each pair the latest rating stays, of equal times the highest. A folder is
        replaced as a whole; merging the same ratings again changes nothing, so a merge
        that failed half way is simply repeated. Ratings are read twice: keep them where
        they are costly.
        """
        touched = [row.folder for row in ratings.select(self.folder()).distinct().collect()]
        if touched:
            before = self.spark.conf.get("spark.sql.sources.partitionOverwriteMode")
            self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
            try:
                self.merged(ratings, touched).write.insertInto(self.name, overwrite=True)
            finally:
                self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
            self.spark.catalog.refreshTable(self.name)
        return sorted(touched)
