"""Exact best items per user by factors, without scoring all pairs.

Items are taken by falling distance from the mean item, in units of how the items spread
in each direction, some thousands at a time, and those are split into blocks of like
direction. No item of a block scores above the mean's score plus the user's length in
those units times the block's longest distance times the cosine of the least angle between
the user and the block, so a user reads only blocks that can change the n best so far, the
most promising one first. Items a user has seen travel with the user and are left out of
the scores themselves: nothing is fetched in excess.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateweave.session import new_scratch

# The functions below travel to the executors by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ITEMS = 256
USERS_AT_ONCE = 2048
# Blocks that are split by direction together: first few, then twice as many, up to most.
FEWEST_BLOCKS = 4
MOST_BLOCKS = 1024
BOUNDS_AT_ONCE = 32
# Of the items, as many bytes as are sent to the executors at a time; each of their Python
# workers holds them.
GROUP_BYTES = 32 << 20
TASKS_PER_CORE = 2
LISTS = (
    "user_id int, recommendations array<struct<item_id: int, predicted_rating: float>>, blocks_read int"
)
STATE = "user_id int, features array<float>, seen array<int>, keys array<long>, open boolean, blocks_read int"
NOTHING = np.iinfo(np.int64).min
ITEM_MASK = (1 << 32) - 1
HIGHEST_ITEM = (1 << 31) - 1


def usable(factors: DataFrame, name: str) -> DataFrame:
    """``name, features`` of the rows with an id and finite factors."""
    finite = F.forall("features", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = factors.where(F.col("id").isNotNull() & F.col("features").isNotNull())
    return rows.where(F.coalesce(finite, F.lit(False))).select(F.col("id").alias(name), "features")


def rounded(scores: np.ndarray, digits: int | None) -> np.ndarray:
    """Scores as they are ranked: single precision, rounded half up as SQL rounds."""
    scores = scores.astype(np.float32)
    if digits is None:
        return scores
    wide = scores.astype(np.float64)
    return (np.copysign(np.floor(np.abs(wide) * 10**digits + 0.5), wide) / 10**digits).astype(np.float32)


def rank_keys(scores: np.ndarray, items: np.ndarray) -> np.ndarray:
    """Integers that order by score, then by falling item id; both can be read back."""
    bits = (scores + np.float32(0)).view(np.int32).astype(np.int64)
    rising = np.where(bits < 0, -(bits & HIGHEST_ITEM) - 1, bits)
    return (rising << 32) | (HIGHEST_ITEM - items)


def read_keys(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The scores and items of :func:`rank_keys`."""
    rising = keys >> 32
    bits = np.where(rising < 0, -(rising + 1) | np.int64(-(1 << 31)), rising)
    return bits.astype(np.int32).view(np.float32), HIGHEST_ITEM - (keys & ITEM_MASK)


class Spread(NamedTuple):
    """Mean of the items, and the root of their covariance."""

    mean: np.ndarray
    root: np.ndarray

    def scaled(self, factors: np.ndarray) -> np.ndarray:
        """From the mean, in units of the spread."""
        return np.linalg.solve(self.root, (factors - self.mean).T).T

    def distances(self, factors: np.ndarray) -> np.ndarray:
        return np.sqrt((self.scaled(factors) ** 2).sum(axis=1))

    def units(self, users: np.ndarray) -> np.ndarray:
        """Directions in which users' scores rise, in those units."""
        return _units(users @ self.root)

    def bound(self, users: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each user: the mean's score, what a unit of distance may add, and slack for rounding."""
        base, unit = users @ self.mean, np.sqrt(((users @ self.root) ** 2).sum(axis=1))
        terms = np.abs(users) @ np.abs(self.mean)
        return base, unit, 1e-6 * terms


def _sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Number, sum and sum of squares of a task's factors."""
    for batch in batches:
        if len(batch):
            factors = np.array(batch.features.tolist(), np.float64)
            yield pd.DataFrame({
                "n": [len(factors)], "sums": [factors.sum(axis=0).tobytes()], "squares": [(factors.T @ factors).tobytes()]
            })


def _added(rows: pd.DataFrame) -> pd.DataFrame:
    sums = sum(np.frombuffer(x) for x in rows.sums)
    squares = sum(np.frombuffer(x) for x in rows.squares)
    return pd.DataFrame({"n": [rows.n.sum()], "sums": [sums.tobytes()], "squares": [squares.tobytes()]})


def spread_of(items: DataFrame) -> Spread | None:
    """The spread of all items; none without items. Any values give right bounds."""
    schema = "n long, sums binary, squares binary"
    parts = items.select("features").mapInPandas(_sums, schema)
    tree = parts.groupBy(F.spark_partition_id().alias("part")).applyInPandas(_added, schema)
    total = tree.groupBy().applyInPandas(_added, schema).first()
    if total is None:
        return None
    mean = np.frombuffer(total.sums) / total.n
    cover = np.frombuffer(total.squares).reshape(len(mean), -1) / total.n - np.outer(mean, mean)
    values, vectors = np.linalg.eigh(cover)
    # Directions without spread get a little, so that distances can be told in them.
    least = max(1e-9 * values.max(initial=0.0), 1e-9 * float(mean @ mean), 1e-30)
    return Spread(mean, vectors * np.sqrt(np.maximum(values, least)))


def _measured(batches: Iterator[pd.DataFrame], spread: Spread) -> Iterator[pd.DataFrame]:
    for batch in batches:
        factors = np.array(batch.features.tolist(), np.float64)
        distances = spread.distances(factors) if len(batch) else np.zeros(0)
        yield batch.assign(length=distances)


def _pack(batches: Iterator[pd.DataFrame], size: int, kind: str, spread: Spread | None) -> Iterator[pd.DataFrame]:
    """Rows in order of falling distance, ``size`` to a block."""
    held, rows, wanted = [], 0, FEWEST_BLOCKS * size
    for batch in batches:
        held, rows = [*held, batch], rows + len(batch)
        while rows >= wanted:
            some = pd.concat(held, ignore_index=True)
            yield _blocks(some.iloc[:wanted], size, kind, spread)
            held, rows = [some.iloc[wanted:]], rows - wanted
            wanted = min(2 * wanted, MOST_BLOCKS * size)
    if rows:
        yield _blocks(pd.concat(held, ignore_index=True), size, kind, spread)


def _blocks(rows: pd.DataFrame, size: int, kind: str, spread: Spread) -> pd.DataFrame:
    """Rows as blocks of like direction, with their axis and the cosine of the widest angle to it."""
    factors, ids = np.array(rows.features.tolist(), kind), rows.item_id.to_numpy(np.int32)
    lengths, units = rows.length.to_numpy(), _units(spread.scaled(factors))
    out = []
    for own in _by_direction(units, size):
        axis = _units(units[own].sum(axis=0)[None])[0]
        least = (units[own] @ axis).min() if axis.any() else -1.0
        out.append((lengths[own].max(), ids[own].tobytes(), factors[own].tobytes(), axis.tobytes(), least))
    return pd.DataFrame(out, columns=["length", "ids", "factors", "axis", "least"])


def _units(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; those of length 0 stay."""
    lengths = np.sqrt((vectors**2).sum(axis=1, keepdims=True))
    return vectors / np.where(lengths > 0, lengths, 1)


def _by_direction(units: np.ndarray, size: int) -> list[np.ndarray]:
    """Places of rows, ``size`` at a time, split again and again where they differ most."""
    out, left = [], [np.arange(len(units))]
    while left:
        own = left.pop()
        if len(own) <= size:
            out.append(own)
            continue
        off = units[own] - units[own].mean(axis=0)
        along = off @ np.linalg.eigh(off.T @ off)[1][:, -1]
        order = np.argsort(along, kind="stable")
        half = size * (-(-len(own) // size) // 2)
        left += [own[order[half:]], own[order[:half]]]
    return out


class Items:
    """Some items on an executor: blocks by falling distance, and where each id is."""

    def __init__(self, blocks: list[tuple], spread: Spread | None, kind: str) -> None:
        self.spread = spread
        self.lengths = np.array([block[0] for block in blocks])
        self.ids = [np.frombuffer(block[1], np.int32) for block in blocks]
        self.factors = [
            np.frombuffer(block[2], kind).reshape(len(i), -1) for block, i in zip(blocks, self.ids, strict=True)
        ]
        self.axes = np.array([np.frombuffer(block[3]) for block in blocks])
        self.least = np.array([block[4] for block in blocks])
        listed = np.concatenate([*self.ids, np.zeros(0, np.int32)])
        self.order = np.argsort(listed, kind="stable").astype(np.int32)
        self.sorted = listed[self.order]
        self.starts = np.cumsum([0, *map(len, self.ids)])
        # The longest factor: what single precision may add to a score goes by it.
        self.longest = max((np.sqrt((f.astype(np.float64) ** 2).sum(axis=1).max()) for f in self.factors), default=0.0)

    def places(self, owner: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Owner and place among the items, by place, of all seen items that are there."""
        at = np.minimum(np.searchsorted(self.sorted, seen), max(0, len(self.sorted) - 1))
        known = self.sorted[at] == seen if len(self.sorted) else np.zeros(len(seen), bool)
        owner, place = owner[known], self.order[at[known]]
        by_place = np.argsort(place, kind="stable")
        return owner[by_place], place[by_place]

    def bounds(self, users: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What no item scores above, a row per block; the highest row; the same of items beyond the blocks."""
        base, unit, rounding = self.spread.bound(users)
        # A little more than the bound, for what single precision may add.
        slack = rounding + 1e-30 + np.abs(base) * 1e-6
        most, units = np.empty((len(self.lengths), len(users)), np.float32), self.spread.units(users).T
        first, highest = np.zeros(len(users), np.int64), np.full(len(users), -np.inf, np.float32)
        for at in range(0, len(most), BOUNDS_AT_ONCE):
            own = slice(at, at + BOUNDS_AT_ONCE)
            least, cosine = self.least[own, None], self.axes[own] @ units
            np.clip(cosine, -1, 1, out=cosine)
            apart = cosine * cosine
            np.sqrt(np.subtract(1, apart, out=apart), out=apart)
            apart *= np.sqrt(np.maximum(0, 1 - least**2))
            inside = cosine >= least
            cosine *= least
            apart += cosine
            apart += 1e-6
            apart[inside] = 1
            np.clip(apart, 0, 1, out=apart)
            apart *= unit
            apart *= self.lengths[own, None] * (1 + 3e-6)
            apart += base + slack
            most[own] = apart
            top = most[own].max(axis=0)
            higher = np.flatnonzero(top > highest)
            first[higher], highest[higher] = at + most[own][:, higher].argmax(axis=0), top[higher]
        return most, first, unit * self.lengths[-1] * (1 + 3e-6) + base + slack

    def search(
        self, users: np.ndarray, seen: tuple[np.ndarray, np.ndarray], best: np.ndarray, digits: int | None
    ) -> tuple[np.ndarray, np.ndarray]:
        """Improve each user's ``best`` keys; blocks read, and whose search is not over.

        ``seen`` are places of users and an item of each. What a user reads does not
        depend on the other users.
        """
        if not len(self.lengths):
            return np.zeros(len(users), np.int32), np.ones(len(users), bool)
        owner, place = self.places(*seen)
        limits = np.searchsorted(place, self.starts)
        read = np.zeros(len(users), np.int32)
        step = 0.0 if digits is None else 0.5 * 10.0**-digits
        row_of = np.full(len(users), -1, np.int64)
        # Single precision tells which scores to look at, where it holds them.
        lengths = np.sqrt((users**2).sum(axis=1))
        error = lengths * self.longest * (users.shape[1] + 4) * 2.4e-7 + 1e-30
        quick = max(lengths.max(initial=0.0), 1.0) * max(self.longest, 1.0) < 1e30
        short = users.astype(np.float32) if quick else users
        lowest = np.finfo(short.dtype).min
        factors_of = [f.astype(short.dtype, copy=False) for f in self.factors]

        def least(some: np.ndarray | slice) -> np.ndarray:
            """The score that an item needs."""
            worst = best[some].min(axis=1)
            score = read_keys(worst)[0].astype(np.float64)
            return np.where(worst == NOTHING, -np.inf, score - step - np.abs(score) * 1e-6 - 1e-30)

        def look(b: int, some: np.ndarray) -> None:
            """Users ``some`` read block ``b``."""
            read[some] += 1
            scores = short[some] @ factors_of[b].T
            if limits[b] < limits[b + 1]:
                row_of[some] = np.arange(len(some))
                rows = row_of[owner[limits[b] : limits[b + 1]]]
                columns = place[limits[b] : limits[b + 1]] - self.starts[b]
                scores[rows[rows >= 0], columns[rows >= 0]] = -np.inf
                row_of[some] = -1
            # The lowest number there is leaves out the seen ones.
            enough = np.maximum(needed[some] - error[some], lowest).astype(scores.dtype)
            hit = np.flatnonzero(scores.max(axis=1) >= enough)
            if not len(hit):
                return
            row, column = np.nonzero(scores[hit] >= enough[hit, None])
            row = hit[row]
            exact = np.einsum("ij,ij->i", users[some[row]], self.factors[b][column].astype(np.float64))
            good = exact >= needed[some[row]]
            row, column, exact = row[good], column[good], exact[good]
            if len(row):
                keys = rank_keys(rounded(exact, digits), self.ids[b][column].astype(np.int64))
                changed, inverse = np.unique(row, return_inverse=True)
                best[some[changed]] = _merge(best[some[changed]], inverse, keys)
                needed[some[changed]] = least(some[changed])

        needed = least(slice(None))
        bounds, first, rest = self.bounds(users)
        # The block with the highest bound raises what the others must reach.
        first[~(bounds[first, np.arange(len(users))] >= needed)] = -1
        by_first = np.argsort(first, kind="stable")
        for b in np.unique(first[first >= 0]):
            lo, hi = np.searchsorted(first[by_first], [b, b + 1])
            look(b, by_first[lo:hi])
            bounds[b, by_first[lo:hi]] = np.nan
        for b in range(len(self.lengths)):
            some = np.flatnonzero(bounds[b] >= needed)
            if len(some):
                look(b, some)
        return read, rest >= needed


def _merge(best: np.ndarray, row: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The n highest keys of each row, of those it has and of new ones (at least one)."""
    n = best.shape[1]
    by_row = np.argsort(row, kind="stable")
    sizes = np.bincount(row, minlength=len(best))
    both = np.full((len(best), n + sizes.max()), NOTHING)
    both[:, :n] = best
    row = row[by_row]
    both[row, n + np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = keys[by_row]
    return np.partition(both, both.shape[1] - n, axis=1)[:, -n:]


def _flat(column: pa.ListArray, dtype: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)


def _rows_of(values: np.ndarray) -> pa.ListArray:
    """A list for each row."""
    n, width = values.shape
    return pa.ListArray.from_arrays(np.arange(0, n * width + 1, max(width, 1), dtype=np.int32)[: n + 1], values.ravel())


def _step(batches: Iterator[pa.RecordBatch], items: Items, n: int, digits: int | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), USERS_AT_ONCE):
            some = batch.slice(at, USERS_AT_ONCE)
            keys, seen = some["keys"], some["seen"]
            begun = keys.null_count < len(keys)
            best = _flat(keys, np.int64).reshape(len(some), n).copy() if begun else np.full((len(some), n), NOTHING)
            users = _flat(some["features"], np.float64).reshape(len(some), -1)
            owner = np.repeat(np.arange(len(some)), seen.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            listed = seen.flatten()
            owner = owner[listed.is_valid().to_numpy(zero_copy_only=False)]
            listed = listed.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
            read, still = items.search(users, (owner, listed), best, digits)
            read = (some["blocks_read"].to_numpy() + read).astype(np.int32)
            columns = [some["user_id"], some["features"], seen, _rows_of(best), pa.array(still), pa.array(read)]
            yield pa.RecordBatch.from_arrays(columns, names=some.schema.names)


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = len(_flat(batch["keys"], np.int64)) // max(1, len(batch))
        keys = np.sort(_flat(batch["keys"], np.int64).reshape(len(batch), n))[:, ::-1]
        sizes = (keys != NOTHING).sum(axis=1)
        scores, items = read_keys(keys[keys != NOTHING])
        listed = pa.StructArray.from_arrays(
            [pa.array(items.astype(np.int32)), pa.array(scores.astype(np.float32))], ["item_id", "predicted_rating"]
        )
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        columns = [batch["user_id"], pa.ListArray.from_arrays(ends, listed), batch["blocks_read"]]
        yield pa.RecordBatch.from_arrays(columns, names=["user_id", "recommendations", "blocks_read"])


class FactorSearch:
    """Search in the item factors of one model, for any of its users.

    The blocks of items are a table in the shared folder. Items of up to
    ``group_bytes`` in all are sent to the executors once, and used for every call
    until :meth:`release`; more of them go in groups of that size, longest first, one
    job for each group that some user's search still needs.
    """

    def __init__(
        self,
        user_factors: DataFrame,
        item_factors: DataFrame,
        block_items: int = BLOCK_ITEMS,
        group_bytes: int = GROUP_BYTES,
    ) -> None:
        self.spark, self.group_bytes = item_factors.sparkSession, group_bytes
        self.users = usable(user_factors, "user_id")
        items = usable(item_factors, "item_id")
        # Single precision is kept as it is.
        self.kind = kind = "<f4" if dict(items.dtypes)["features"] == "array<float>" else "<f8"
        self.spread = spread = spread_of(items)
        if spread is not None:
            measured = f"item_id int, features {dict(items.dtypes)['features']}, length double"
            items = items.withColumn("item_id", F.col("item_id").cast("int"))
            items = items.mapInPandas(lambda it: _measured(it, spread), measured)
        else:
            items = items.withColumn("length", F.lit(0.0))
        in_order = items.orderBy(F.desc("length"), "item_id")
        path = new_scratch(self.spark, "item-blocks")
        schema = "length double, ids binary, factors binary, axis binary, least double"
        in_order.mapInPandas(lambda it: _pack(it, block_items, kind, spread), schema).write.parquet(path)
        self.table = self.spark.read.schema(schema).parquet(path)
        size = F.octet_length("ids") + F.octet_length("factors")
        total = self.table.agg(F.coalesce(F.sum(size), F.lit(0)).alias("size"), F.count("*").alias("n")).first()
        self.n_blocks, self.shared = total.n, None
        if total.size <= group_bytes:
            self.shared = self.spark.sparkContext.broadcast(next(self._groups(), []))

    @classmethod
    def of(cls, model: ALSModel, **options: int) -> FactorSearch:
        return cls(model.userFactors, model.itemFactors, **options)

    def _groups(self) -> Iterator[list[tuple[float, bytes, bytes, bytes, float]]]:
        group, size = [], 0
        for row in self.table.orderBy(F.desc("length")).toLocalIterator():
            if group and size + len(row.factors) > self.group_bytes:
                yield group
                group, size = [], 0
            group.append((row.length, bytes(row.ids), bytes(row.factors), bytes(row.axis), row.least))
            size += len(row.ids) + len(row.factors)
        if group:
            yield group

    def lists(self, users: DataFrame, n: int, digits: int | None = None) -> DataFrame:
        """``user_id, recommendations, blocks_read``: the n best items of each user.

        ``users`` has distinct ``user_id`` and may have ``seen``, an array of items to
        leave out. Ranked by the score, rounded to ``digits`` where given, then by item
        id. Users the model does not know have no row; a user who has seen everything
        has an empty list. Factors with null or non-finite values take no part.
        """
        seen = F.col("seen") if "seen" in users.columns else F.lit(None).cast("array<int>")
        state = users.select("user_id", seen.alias("seen")).join(self.users, "user_id").select(
            F.col("user_id").cast("int"), "features", F.col("seen").cast("array<int>"),
            F.lit(None).cast("array<long>").alias("keys"), F.lit(True).alias("open"), F.lit(0).alias("blocks_read"),
        )
        # Rows are small and take long: by their bytes they would be one task.
        state = state.repartition(TASKS_PER_CORE * self.spark.sparkContext.defaultParallelism)
        spread, kind = self.spread, self.kind
        if self.shared is not None:
            shared = self.shared
            # One function for both: a second one would have workers of its own.
            return state.mapInArrow(
                lambda it: _lists(_step(it, Items(shared.value, spread, kind), n, digits)), LISTS
            )
        over = []
        for group in self._groups():
            part = self.spark.sparkContext.broadcast(group)
            found = state.mapInArrow(
                lambda it, p=part: _step(it, Items(p.value, spread, kind), n, digits), STATE
            )
            path = new_scratch(self.spark, "search-state")
            found.write.parquet(path)
            part.destroy()
            found = self.spark.read.schema(STATE).parquet(path)
            # Those whose search is over go through no further group.
            over.append(found.where("NOT open"))
            state = found.where("open")
            if state.isEmpty():
                break
        return reduce(DataFrame.unionAll, over, state).mapInArrow(_lists, LISTS)

    def top(self, users: DataFrame, n: int, digits: int | None = None) -> DataFrame:
        """:meth:`lists` as rows ``user_id, item_id, predicted_rating, rank``."""
        return ranked_rows(self.lists(users, n, digits))

    def release(self) -> None:
        if self.shared is not None:
            self.shared.unpersist()


def ranked_rows(lists: DataFrame) -> DataFrame:
    """One row per listed item, numbered from 1 within its user."""
    listed = lists.select("user_id", F.posexplode("recommendations").alias("at", "item"))
    return listed.select(
        "user_id", "item.item_id", "item.predicted_rating", (F.col("at") + 1).alias("rank")
    )


def with_seen(pairs: DataFrame) -> DataFrame:
    """``user_id, seen``: the distinct items of each user of ``user_id, item_id`` rows.

    Pairs are made distinct before the shuffle; an array is bounded by the items.
    """
    return pairs.groupBy("user_id").agg(F.collect_set("item_id").alias("seen"))
