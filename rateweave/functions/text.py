"""Expressions over delimited rating lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rateweave.schemas import RATING


def split_line(line: Column, delimiter: str = "::") -> Column:
    """The parts of a line; the delimiter is literal text, quoted for the splitter."""
    return F.split(line, rf"\Q{delimiter}\E")


def rating_fields(parts: Column) -> list[Column]:
    """The four typed fields of a split line; a missing or bad field is null.

    ``get`` and ``try_cast`` keep short and malformed lines as nulls with ANSI
    mode on.
    """
    return [
        F.get(parts, F.lit(position)).try_cast(field.dataType).alias(field.name)
        for position, field in enumerate(RATING.fields)
    ]
