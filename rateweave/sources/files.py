"""File streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def stream_parquet(
    spark: SparkSession,
    path: str,
    schema: StructType,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Stream the Parquet file, or folder of files, at ``path``.

    The last letter is written as a one-letter glob: a file stream takes a plain
    path for a folder, a glob for whatever matches.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    trimmed = path.rstrip("/")
    return reader.parquet(f"{trimmed[:-1]}[{trimmed[-1]}]")
