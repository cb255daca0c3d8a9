"""Reproducible sampling expressions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def unit_hash(keys: Sequence[str], seed: int) -> Column:
    """A value in [0, 1) that depends on the keys and the seed alone.

    Unlike ``rand(seed)`` it does not depend on partitioning or row order, so a
    task that runs again after an executor is lost draws the same value. 32 bits
    of MD5 are uniform enough to split on and any SQL engine can recompute them.
    """
    return F.conv(F.substring(_digest(keys, seed), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def drawn_below(keys: Sequence[str], seed: int, limit: float) -> Column:
    """``unit_hash(keys, seed) < limit``, told from the digits as they are written."""
    least = math.ceil(limit * 2**32)
    if not 0 < least < 2**32:
        return F.lit(least > 0)
    return _digest(keys, seed) < F.lit(f"{least:08x}")


def _digest(keys: Sequence[str], seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
