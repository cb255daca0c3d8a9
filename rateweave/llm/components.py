"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateweave.llm.tables import keep


def components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable from each node that has an edge.

    ``edges`` has ``a`` and ``b`` (long, not null). Gives ``node``, ``root``, one
    row per node with an edge to another one; an empty table gives none.

    Rounds of two steps make stars of the graph: each node is linked to the least
    of its neighbours, first the larger neighbours (which only shortens paths),
    then the smaller ones. A round that changes nothing ends it. Each round is a
    table in the shared folder. Rows never exceed the edges given. A node with very
    many neighbours is only aggregated and joined on, never gathered.
    """
    now = keep(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "component-edges",
    )
    before = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select(F.col("a").alias("node"), F.least("a", "m").alias("m"))
        large = (
            now.join(least, F.col("b") == F.col("node"))
            .select(F.col("a"), F.col("m").alias("b"))
            .distinct()
        )
        large = keep(large, "component-large")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low.withColumnRenamed("a", "node"), F.col("a") == F.col("node"))
            .where("b > m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(low.select("a", F.col("m").alias("b")))
            .distinct()
        )
        now = keep(small, "component-small")
        state = now.agg(
            F.count("*").alias("n"),
            F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)).alias("mark"),
            F.sum(F.col("b").cast("decimal(38,0)")).alias("sum"),
        ).first()
        if state == before:
            break
        before = state
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
