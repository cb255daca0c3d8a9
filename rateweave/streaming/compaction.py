"""Merge the many small folders of a stream table into few large files."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from rateweave.streaming.shared import NO_BATCH

FILE_BYTES = 256 << 20
VERSIONS = "version int, first int, upto int, n_rows long, bytes long"


class CompactedTable:
    """Reads a table of ``batch_id`` folders whose closed batches have been merged.

    A merge writes the batches since the last one together, with their ``batch_id`` as a
    column, as files of about ``file_bytes``; a last segment smaller than that is merged
    with them, so no row is written again for ever. A segment counts from the moment its
    row is in the table of versions, and then stands for all its batches at once:
    readers see each row in one place before, during and after. What a segment stands
    for stays where it is until :meth:`forgettable` names it for removal.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, file_bytes: int = FILE_BYTES) -> None:
        self.spark, self.path, self.file_bytes = spark, path, file_bytes
        self.with_batch = StructType([*schema.fields, StructField("batch_id", IntegerType())])
        self.versions = f"{path}.versions"
        spark.createDataFrame([], VERSIONS).write.mode("ignore").parquet(self.versions)

    def _listed(self) -> list[Row]:
        listed = self.spark.read.schema(VERSIONS).parquet(self.versions)
        return sorted(listed.collect(), key=lambda row: -row.version)

    def segments(self) -> list[Row]:
        """Those in force, in the order of their batches: no newer one covers them."""
        live: list[Row] = []
        for row in self._listed():
            if not any(newer.first <= row.first and row.upto <= newer.upto for newer in live):
                live.append(row)
        return sorted(live, key=lambda row: row.first)

    def _batches(self, after: int) -> DataFrame:
        batches = self.spark.read.schema(self.with_batch).parquet(self.path)
        return batches.where(F.col("batch_id") > after)

    def _folder(self, version: int) -> str:
        return f"{self.path}.segments/{version}"

    def _merged(self, segments: list[Row]) -> DataFrame:
        folders = [self._folder(row.version) for row in segments]
        return self.spark.read.schema(self.with_batch).parquet(*folders)

    def read(self) -> DataFrame:
        """All rows, with their ``batch_id``: merged ones, and batches since then."""
        live = self.segments()
        if not live:
            return self._batches(NO_BATCH)
        return self._merged(live).unionAll(self._batches(live[-1].upto))

    def merge(self, upto: int) -> int:
        """Merge what is new up to batch ``upto``, which must be closed; rows written.

        A batch is closed when the query has committed it: see :func:`last_committed`.
        A merge that fails leaves what was in force, and can be repeated.
        """
        live = self.segments()
        done = live[-1].upto if live else NO_BATCH
        if upto <= done:
            return 0
        first, rows = done + 1, self._batches(done).where(F.col("batch_id") <= upto)
        size = _bytes(rows)
        if live and live[-1].bytes < self.file_bytes:
            first, size = live[-1].first, size + live[-1].bytes
            rows = self._merged(live[-1:]).unionAll(rows)
        version = max((row.version for row in self._listed()), default=0) + 1
        files = max(1, -(-size // self.file_bytes))
        rows.repartition(files).write.mode("overwrite").parquet(self._folder(version))
        written = self.spark.read.schema(self.with_batch).parquet(self._folder(version))
        n = written.count()
        row = [(version, first, upto, n, _bytes(written))]
        about = self.spark.createDataFrame(row, VERSIONS)
        about.coalesce(1).write.mode("append").parquet(self.versions)
        return n

    def forgettable(self) -> list[str]:
        """Folders that no reader who starts now looks at."""
        live = self.segments()
        if not live:
            return []
        batches = self.spark.read.schema(self.with_batch).parquet(self.path)
        old = batches.where(F.col("batch_id").between(NO_BATCH + 1, live[-1].upto))
        own = [f"{self.path}/batch_id={r.batch_id}" for r in old.select("batch_id").distinct().collect()]
        in_force = {row.version for row in live}
        return sorted(own) + sorted(
            self._folder(row.version) for row in self._listed() if row.version not in in_force
        )


def _bytes(frame: DataFrame) -> int:
    """Bytes of the files that hold the rows of a frame that only reads."""
    files = frame.select("_metadata.file_path", "_metadata.file_size").distinct()
    return files.agg(F.coalesce(F.sum("file_size"), F.lit(0))).first()[0]


def last_committed(spark: SparkSession, checkpoint: str) -> int:
    """The last batch that a query has committed, from its checkpoint; -1 for none."""
    commits = spark.read.option("pathGlobFilter", "[0-9]*").text(f"{checkpoint}/commits")
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)$", 1).try_cast("int")
    return commits.agg(F.coalesce(F.max(name), F.lit(NO_BATCH))).first()[0]
