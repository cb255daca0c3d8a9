"""Event time of a record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed format: ISO date and time with optional fraction (1 to 6 digits) and
# optional offset. The optional sections stand for four exact patterns (with or
# without either), so that a string is parsed once, not up to four times.
EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]"


def event_time(text: Column, ingest_time: Column) -> Column:
    """Time stated in the record, else the time the broker took it in."""
    return F.coalesce(F.try_to_timestamp(text, F.lit(EVENT_TIME_FORMAT)), ingest_time)
