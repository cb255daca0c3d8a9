"""Run several streaming queries together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql.streaming import StreamingQuery


def stop_all(queries: Sequence[StreamingQuery]) -> None:
    for query in queries:
        query.stop()


def run_until_any_stops(queries: Sequence[StreamingQuery], poll_seconds: float = 1.0) -> None:
    """Wait until one of ``queries`` ends, then stop the rest; its error is raised."""
    try:
        while all(query.isActive for query in queries):
            queries[0].awaitTermination(poll_seconds)
        for query in queries:
            if query.exception() is not None:
                raise query.exception()
    finally:
        stop_all(queries)


def run_to_end(queries: Sequence[StreamingQuery]) -> None:
    """Wait for queries that end by themselves (``availableNow``)."""
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        stop_all(queries)
