"""Exact top-k by inner product with a KD-tree per shard.

Each shard's tree is split at medians and has a tight bounding box per node. A
query visits nodes best first: no vector of a node scores above its box's bound,
so the search of a shard ends where the next bound is below the k-th score so far.
That score is first taken from one shard and passed on to all others.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rateweave.llm.tables import keep, pieces
from rateweave.session import new_scratch

K = 10
SCALE = 1024
EVERY = 100
SHARD_ROWS = 8192
LEAF_ROWS = 128
QUERY_BLOCK = 4096
# A vector's product with itself: below it every score of two vectors is a long.
MOST_SQUARES = float(2**62)
# Sums of integers up to here are exact as doubles.
EXACT = 2**53
# More than doubles lose, in proportion, in a sum of products; bounds stay bounds.
SLACK = 1e-9
# No score known yet: below all scores.
NONE = -(2**63)

TREE = (
    "dim int, shard long, ids binary, vectors binary, first binary, last binary, "
    "child binary, low binary, high binary"
)
HIT = "query_id long, vec_id long, score long"


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``v``, the components as ``floor(scale * x)``; unusable rows left out."""
    x = F.col("embedding")
    usable = (
        F.col("vec_id").isNotNull()
        & x.isNotNull()
        & F.coalesce(
            F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))), F.lit(False)
        )
        & (F.size(x) > 0)
    )
    squares = F.aggregate(
        x, F.lit(0.0), lambda total, e: total + F.pow(F.floor(F.lit(scale) * e.cast("double")).cast("double"), 2)
    )
    usable = F.when(usable, squares < MOST_SQUARES).otherwise(False)
    return vectors.where(usable).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(x, lambda e: F.floor(F.lit(scale) * e.cast("double")).cast("long")).alias("v"),
    )


def build(ids: np.ndarray, vectors: np.ndarray, leaf_rows: int = LEAF_ROWS) -> dict[str, np.ndarray]:
    """Tree over the rows: nodes with row ranges, children and bounding boxes."""
    order = np.arange(len(ids))
    first, last, child, low, high = [0], [len(ids)], [0], [], []
    at = 0
    while at < len(first):
        rows = order[first[at] : last[at]]
        part = vectors[rows]
        low.append(part.min(axis=0))
        high.append(part.max(axis=0))
        spread = high[at] - low[at]
        if len(rows) > leaf_rows and spread.any():
            axis, half = int(spread.argmax()), len(rows) // 2
            order[first[at] : last[at]] = rows[np.argpartition(part[:, axis], half)]
            middle = first[at] + half
            child[at] = len(first)
            first += [first[at], middle]
            last += [middle, last[at]]
            child += [0, 0]
        at += 1
    return {
        "ids": ids[order], "vectors": vectors[order],
        "first": np.array(first), "last": np.array(last), "child": np.array(child),
        "low": np.array(low), "high": np.array(high),
    }


def _build_shard(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.assign(order=rows.v.map(tuple)).sort_values(["vec_id", "order"])
    rows = rows.loc[rows.index.repeat(rows.times)]
    tree = build(rows.vec_id.to_numpy(np.int64), np.array(rows.v.tolist(), np.int64))
    out = {name: [array.astype(np.int64).tobytes()] for name, array in tree.items()}
    return pd.DataFrame({"dim": [rows.dim.iloc[0]], "shard": [rows.shard.iloc[0]], **out})


def search(
    tree: dict[str, np.ndarray], query: np.ndarray, bounds: np.ndarray, own: int, k: int, least: int
) -> list[tuple[int, int]]:
    """(score, vec_id) of the best k of a tree that reach ``least``, best first."""
    best: list[tuple[int, int]] = []  # heap of (score, -id): the worst on top
    heap = [(-bounds[0], 0)]
    while heap:
        bound, node = heapq.heappop(heap)
        worst = best[0][0] if len(best) == k else NONE
        if -bound < max(worst, least):
            break
        below = int(tree["child"][node])
        if below:
            for n in (below, below + 1):
                heapq.heappush(heap, (-bounds[n], n))
            continue
        rows = slice(tree["first"][node], tree["last"][node])
        scores = tree["vectors"][rows] @ query
        for i in np.flatnonzero(scores >= max(worst, least)):
            entry = (int(scores[i]), -int(tree["ids"][rows][i]))
            if entry[1] == -own:
                continue
            if len(best) < k:
                heapq.heappush(best, entry)
            elif entry > best[0]:
                heapq.heapreplace(best, entry)
    return [(score, -i) for score, i in sorted(best, reverse=True)]


def _search_trees(batches: Iterator[pd.DataFrame], block, k: int) -> Iterator[pd.DataFrame]:
    ids, queries, least = block
    for batch in batches:
        for row in batch.itertuples(index=False):
            if row.dim != queries.shape[1]:
                continue
            whole = {n: np.frombuffer(getattr(row, n), np.int64) for n in TREE_ARRAYS}
            for name in ("vectors", "low", "high"):
                whole[name] = whole[name].reshape(-1, row.dim)
            low, high, sought = (a.astype(np.float64) for a in (whole["low"], whole["high"], queries))
            up, down = np.maximum(sought, 0), np.minimum(sought, 0)
            bounds = up @ high.T + down @ low.T
            largest = np.maximum(np.abs(low), np.abs(high)).max(axis=0)
            if float((np.abs(sought) @ largest).max()) < EXACT:
                # Doubles hold these sums exactly and multiply faster than integers.
                whole["vectors"] = whole["vectors"].astype(np.float64)
            else:
                sought = queries
                bounds += SLACK * (up @ np.abs(high).T - down @ np.abs(low).T)
            out = [
                (own, i, score)
                for own, query, bound, floor in zip(ids, sought, bounds, least, strict=True)
                for score, i in search(whole, query, bound, int(own), k, int(floor))
            ]
            yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"], dtype="int64")


TREE_ARRAYS = ("ids", "vectors", "first", "last", "child", "low", "high")


def _blocks(rows: Iterator, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Query ids and vectors, in blocks of one dimension each."""
    for _, group in itertools.groupby(rows, key=lambda r: len(r.v)):
        while some := list(itertools.islice(group, size)):
            yield np.array([r.vec_id for r in some]), np.array([r.v for r in some], np.int64)


def top_k(
    vectors: DataFrame,
    k: int = K,
    every: int = EVERY,
    scale: int = SCALE,
    shard_rows: int = SHARD_ROWS,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """The k highest inner products of each query row against all other rows.

    ``vectors`` has ``vec_id`` and ``embedding``; other columns are ignored. Queries
    are the rows whose id is divisible by ``every``. Gives query_id, rank, vec_id,
    score; ties go to the smaller id. Rows without id, null or empty vectors, and
    vectors with a null or non-finite component take no part, nor do those whose
    product with themselves passes 62 bits, since scores are longs; all scores are
    exact. Repeated rows are candidates of their own, but an id is one query (that of
    the least vector) and no candidate of its own; vectors of another length are
    not compared; an empty table gives no rows.

    Equal rows are counted before they are dealt to shards, and a shard holds no
    more than ``k`` of them, so a row that is a third of the table is not one task's.
    The trees are a table, a row per shard. Queries pass through the driver in
    blocks of ``query_block``; each block is searched in all shards, first in one of
    them to get the scores that the others must reach.
    """
    spark = vectors.sparkSession
    whole = whole_vectors(vectors, scale).withColumn("dim", F.size("v"))
    alike = whole.groupBy("dim", "vec_id", "v").agg(F.least(F.count("*"), F.lit(k)).alias("times"))
    alike = keep(alike, "kd-rows")
    shards = pieces(alike.agg(F.coalesce(F.sum("times"), F.lit(0))).first()[0], shard_rows)
    shard = F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards))
    trees = keep(
        alike.withColumn("shard", shard).groupBy("dim", "shard").applyInPandas(_build_shard, TREE), "kd-trees"
    )
    queries = keep(
        alike.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v")), "kd-queries"
    )
    ordered = queries.orderBy(F.size("v"), "vec_id")
    found = new_scratch(spark, "kd-hits")
    spark.createDataFrame([], HIT).write.parquet(found)
    for ids, block in _blocks(ordered.toLocalIterator(), query_block):
        least = np.full(len(ids), NONE, np.int64)
        shared = spark.sparkContext.broadcast((ids, block, least))
        one = trees.where(F.col("shard") == 0).mapInPandas(
            lambda it, s=shared: _search_trees(it, s.value, k), HIT
        )
        seen = one.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("score"))
        where = {i: n for n, i in enumerate(ids.tolist())}
        for row in seen.where(F.col("n") == k).collect():
            least[where[row.query_id]] = row.score
        bounded = spark.sparkContext.broadcast((ids, block, least))
        hits = trees.mapInPandas(lambda it, s=bounded: _search_trees(it, s.value, k), HIT)
        hits.write.mode("append").parquet(found)
        shared.destroy()
        bounded.destroy()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    hits = spark.read.schema(HIT).parquet(found)
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
