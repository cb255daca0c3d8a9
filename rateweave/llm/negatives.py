"""Hard negatives by inner products that are looked up, not multiplied (Four Russians).

An anchor's components are taken eight at a time, and for each group the sums of all
256 subsets are tabled. Candidates are kept as bit planes: for each group and each bit
of their numbers, one byte that says which of the eight components have that bit. The
byte is the index of the subset sum; sums of the groups are added, those of the planes
shifted and added from the highest, which counts negatively, down. Scores are exact.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rateweave.llm.tables import keep
from rateweave.session import new_scratch

SCALE = 256
EVERY = 50
POSITIVES = 5
NEGATIVES = 3
# Percent of the positive's score that a negative must reach, and must not pass.
LOWEST, HIGHEST = 50, 95
RELABELLED = 7
N_LABELS = 10

GROUP = 8
BLOCK_ROWS = 4096
FILE_BLOCKS = 8
ANCHOR_BLOCK = 8192
# Anchors whose tables are used together; they stay in the processor's cache.
TABLED = 64
# Sums of squares below this keep every inner product within 64 bits, whatever the vectors.
MOST_SQUARES = float(2**62)

BLOCK = "dim int, n int, bits int, ids binary, labels binary, planes binary"
POSITIVE = "anchor_id long, positive_id long, positive_score long"
NEGATIVE = "anchor_id long, place int, negative_id long, negative_score long"


def usable_vectors(vectors: DataFrame, scale: int, relabelled: int, n_labels: int) -> DataFrame:
    """``vec_id, label, v`` of the rows that take part; ``v`` is ``floor(scale * x)``."""
    x = F.col("embedding")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    floor = F.transform(x, lambda e: F.floor(F.lit(scale) * e.cast("double")))
    squares = F.aggregate(x, F.lit(0.0), lambda sum, e: sum + F.pow(F.floor(F.lit(scale) * e.cast("double")), 2))
    own = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % relabelled == 0, (own + 1) % n_labels).otherwise(own)
    whole = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull())
    whole = whole.where(F.coalesce(finite, F.lit(False)))
    return whole.where(squares < MOST_SQUARES).select(
        F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), floor.alias("v")
    )


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """For each group and byte, the sum of the anchors' components that the byte names.

    ``anchors`` has a row per anchor, a multiple of eight wide; the result is indexed by
    group, byte and anchor, in the narrowest integers that hold the sum of all groups.
    """
    n, wide = anchors.shape
    groups = anchors.T.reshape(wide // GROUP, GROUP, n)
    # With plain integers, so that no sum can leave 64 bits unseen.
    most = max((sum(map(abs, row)) for row in anchors.tolist()), default=0)
    kind = np.int16 if most < 2**15 else np.int32 if most < 2**31 else np.int64
    sums = np.zeros((wide // GROUP, 1 << GROUP, n), kind)
    for bit in range(GROUP):
        size = 1 << bit
        sums[:, size : 2 * size] = sums[:, :size] + groups[:, bit, None].astype(kind)
    return sums


def bit_planes(vectors: np.ndarray) -> np.ndarray:
    """Bytes by plane, group and vector, the highest plane (the sign) first."""
    n, wide = vectors.shape
    most = max(int(vectors.max(initial=0)), ~int(vectors.min(initial=0)))
    bits = most.bit_length() + 1
    planes = np.empty((bits, wide // GROUP, n), np.uint8)
    for b in range(bits):
        on = ((vectors >> (bits - 1 - b)) & 1).astype(np.uint8).reshape(n, wide // GROUP, GROUP)
        planes[b] = np.packbits(on, axis=2, bitorder="little")[:, :, 0].T
    return planes


def scores(sums: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products by anchor and vector."""
    bits, groups, n = planes.shape
    limit = int(np.abs(sums.astype(object)).max(initial=0)) * groups << bits
    kind = np.int32 if limit < 2**31 else np.int64
    total = np.zeros((n, sums.shape[2]), kind)
    some, found = np.empty((n, sums.shape[2]), sums.dtype), np.empty((n, sums.shape[2]), sums.dtype)
    for b in range(bits):
        found[:] = 0
        for g in range(groups):
            np.take(sums[g], planes[b, g], axis=0, out=some, mode="clip")
            found += some
        total <<= 1
        total += found if b else -found.astype(kind)
    return total.T


def _padded(vectors: list, dim: int) -> np.ndarray:
    out = np.zeros((len(vectors), -(-dim // GROUP) * GROUP), np.int64)
    if len(vectors) and dim:
        out[:, :dim] = np.array(vectors, np.int64)
    return out


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks of candidates of one dimension, by label and id."""
    for batch in batches:
        dims = batch.v.map(len)
        for dim, rows in batch.groupby(dims, sort=False):
            for at in range(0, len(rows), BLOCK_ROWS):
                some = rows.iloc[at : at + BLOCK_ROWS].sort_values(["label", "vec_id"])
                planes = bit_planes(_padded(some.v.tolist(), dim))
                yield pd.DataFrame({
                    "dim": [dim], "n": [len(some)], "bits": [len(planes)],
                    "ids": [some.vec_id.to_numpy(np.int64).tobytes()],
                    "labels": [some.label.to_numpy(np.int64).tobytes()], "planes": [planes.tobytes()],
                })


def _opened(batches: Iterator[pd.DataFrame], dim: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for row in batch.itertuples(index=False):
            if row.dim == dim:
                planes = np.frombuffer(row.planes, np.uint8).reshape(row.bits, -1, row.n)
                yield np.frombuffer(row.ids, np.int64), np.frombuffer(row.labels, np.int64), planes


def best(values: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest values, of equal ones those of least id."""
    if len(values) > 4 * k:
        least = np.partition(values, len(values) - k)[len(values) - k]
        above = np.flatnonzero(values > least)
        equal = np.flatnonzero(values == least)
        if len(equal) > k:
            equal = equal[np.argsort(ids[equal], kind="stable")[:k]]
        places = np.concatenate([above, equal])
    else:
        places = np.arange(len(values))
    return places[np.lexsort((ids[places], -values[places].astype(np.int64)))][:k]


class Best:
    """The k best (score, id) seen so far."""

    def __init__(self, k: int) -> None:
        self.k, self.rows = k, []
        self.least = None  # what a further row must reach

    def add(self, values: np.ndarray, ids: np.ndarray) -> None:
        own = best(values, ids, self.k)
        rows = self.rows + [(int(-values[i]), int(ids[i])) for i in own]
        self.rows = sorted(rows)[: self.k]
        if len(self.rows) == self.k:
            self.least = -self.rows[-1][0]


def _positives(batches: Iterator[pd.DataFrame], block: tuple, k: int) -> Iterator[pd.DataFrame]:
    """Each anchor's best others of its label, among the rows of this task."""
    dim, ids, labels, vectors = block
    found = [Best(k) for _ in ids]
    by_label = {label: np.flatnonzero(labels == label) for label in np.unique(labels).tolist()}
    for own, marks, planes in _opened(batches, dim):
        for label, at, to in zip(*_runs(marks), strict=True):
            anchors = by_label.get(int(label), ())
            for some in itertools.batched(anchors, TABLED):
                values = np.ascontiguousarray(scores(subset_sums(vectors[list(some)]), planes[:, :, at:to]))
                for a, value in zip(some, values, strict=True):
                    least = found[a].least
                    if least is None or value.max() >= least:
                        other = own[at:to] != ids[a]
                        found[a].add(value[other], own[at:to][other])
    rows = [(int(ids[a]), i, -s) for a, seen in enumerate(found) for s, i in seen.rows]
    yield pd.DataFrame(rows, columns=["anchor_id", "positive_id", "positive_score"], dtype="int64")


def _runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each distinct value, and where its run begins and ends."""
    at = np.flatnonzero(np.diff(sorted_values, prepend=sorted_values[:1] - 1))
    return sorted_values[at], at, np.append(at[1:], len(sorted_values))


def _negatives(batches: Iterator[pd.DataFrame], block: tuple, ranges: list, k: int) -> Iterator[pd.DataFrame]:
    """Per anchor and range of scores, the best rows of other labels of this task."""
    dim, ids, labels, vectors = block
    found = [[(low, high, Best(k)) for low, high in own] for own in ranges]
    chosen = [a for a, own in enumerate(found) if own]
    for own, marks, planes in _opened(batches, dim):
        # Tables are made anew for each block: far fewer sums than lookups, and no room for all.
        for some in itertools.batched(chosen, TABLED):
            values = np.ascontiguousarray(scores(subset_sums(vectors[list(some)]), planes))
            for a, value in zip(some, values, strict=True):
                floor = min(low if seen.least is None else max(low, seen.least) for low, _, seen in found[a])
                top = max(high for _, high, _ in found[a])
                near = np.flatnonzero((value >= floor) & (value <= top) & (marks != labels[a]))
                if not len(near):
                    continue
                scored, names = value[near], own[near]
                for low, high, seen in found[a]:
                    fits = (scored >= low) & (scored <= high)
                    if fits.any():
                        seen.add(scored[fits], names[fits])
    rows = [
        (int(ids[a]), place, i, -s)
        for a, own in enumerate(found) for place, (_, _, seen) in enumerate(own) for s, i in seen.rows
    ]
    yield pd.DataFrame(rows, columns=["anchor_id", "place", "negative_id", "negative_score"], dtype="int64")


def allowed(positive_score: int, lowest: int = LOWEST, highest: int = HIGHEST) -> tuple[int, int]:
    """Least and largest whole score within the two percentages of the positive's."""
    return -(-lowest * positive_score // 100), highest * positive_score // 100


def _first(found: DataFrame, keys: list[str], score: str, name: str, k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(score), name)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _blocks(rows: Iterator, size: int) -> Iterator[tuple]:
    """Anchors of one dimension: dimension, ids, labels, vectors."""
    for dim, group in itertools.groupby(rows, key=lambda r: len(r.v)):
        for some in itertools.batched(group, size):
            yield (
                dim, np.array([r.vec_id for r in some]), np.array([r.label for r in some]),
                _padded([r.v for r in some], dim),
            )


def mine(
    vectors: DataFrame,
    every: int = EVERY,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lowest: int = LOWEST,
    highest: int = HIGHEST,
    scale: int = SCALE,
    relabelled: int = RELABELLED,
    n_labels: int = N_LABELS,
    anchor_block: int = ANCHOR_BLOCK,
) -> DataFrame:
    """The first rows of other labels that score within a range below each positive.

    ``vectors`` has ``vec_id``, ``embedding`` and ``label``; other columns are ignored.
    Where the id is divisible by ``relabelled``, the label becomes the next of
    ``n_labels``. Scores are inner products of ``floor(scale * x)``, best first, ties to
    the smaller id. Anchors are the rows whose id is divisible by ``every``, positives
    an anchor's first others of its label, negatives the first of other labels with
    ``lowest`` to ``highest`` percent of the positive's score. Gives anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score.

    Rows without id, label or vector, and vectors with a null or non-finite component,
    take no part, nor do those whose product with themselves passes 62 bits, since
    scores are 64-bit integers. Vectors of another length are not compared. A row with
    the anchor's id is the anchor itself; of rows that share an anchor's id, the one of
    least label and vector is it. Other repeated rows count each time. An empty table
    gives no rows.

    Candidates become a table of packed blocks where they are read: nothing is
    shuffled, so no key can be too frequent. Anchors pass through the driver in blocks
    of ``anchor_block``, which bounds what is broadcast; each is held against all
    candidates once for positives, of its own label, and once for negatives.
    """
    spark = vectors.sparkSession
    usable = usable_vectors(vectors, scale, relabelled, n_labels)
    packed = new_scratch(spark, "negatives-candidates")
    writer = usable.mapInPandas(_pack, BLOCK).write.option("compression", "zstd")
    writer.option("maxRecordsPerFile", FILE_BLOCKS).parquet(packed)
    candidates = spark.read.schema(BLOCK).parquet(packed)
    anchors = usable.where(F.col("vec_id") % every == 0).groupBy("vec_id")
    anchors = anchors.agg(F.min(F.struct("label", "v")).alias("row")).select("vec_id", "row.label", "row.v")
    anchors = keep(anchors, "negatives-anchors").orderBy(F.size("v"), "vec_id")

    pairs, hits = new_scratch(spark, "negatives-positives"), new_scratch(spark, "negatives-found")
    pair_schema = f"{POSITIVE}, place int"
    spark.createDataFrame([], pair_schema).write.parquet(pairs)
    spark.createDataFrame([], NEGATIVE).write.parquet(hits)
    for block in _blocks(anchors.toLocalIterator(), anchor_block):
        shared = spark.sparkContext.broadcast(block)
        near = candidates.mapInPandas(lambda it, s=shared: _positives(it, s.value, positives), POSITIVE)
        near = _first(near, ["anchor_id"], "positive_score", "positive_id", positives)
        # At most ``positives`` rows for each anchor of the block.
        near = near.select("anchor_id", "positive_id", "positive_score", (F.col("rank") - 1).alias("place")).toPandas()
        spark.createDataFrame(near, pair_schema).coalesce(1).write.mode("append").parquet(pairs)
        ranges = _ranges(near, block[1], lowest, highest)
        limits = spark.sparkContext.broadcast(ranges)
        found = candidates.mapInPandas(
            lambda it, s=shared, r=limits: _negatives(it, s.value, r.value, negatives), NEGATIVE
        )
        found = _first(found, ["anchor_id", "place"], "negative_score", "negative_id", negatives)
        found.drop("rank").write.mode("append").parquet(hits)
        shared.destroy()
        limits.destroy()
    found = spark.read.schema(NEGATIVE).parquet(hits)
    found = _first(found, ["anchor_id", "place"], "negative_score", "negative_id", negatives)
    joined = found.join(spark.read.schema(pair_schema).parquet(pairs), ["anchor_id", "place"])
    return joined.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def _ranges(near: pd.DataFrame, ids: np.ndarray, lowest: int, highest: int) -> list[list[tuple[int, int]]]:
    """Per anchor, in the order of ``ids``, the scores allowed for each positive."""
    own: dict[int, list] = {i: [] for i in ids.tolist()}
    for row in near.sort_values(["anchor_id", "place"]).itertuples():
        own[row.anchor_id].append(allowed(int(row.positive_score), lowest, highest))
    return list(own.values())
