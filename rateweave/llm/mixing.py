"""Mix sources to target weights by pivotal dependent rounding.

Every document of a source should be taken ``target / source size`` times. The
whole part is taken as it is. The fractions are rounded in pairs: one document
hands mass to the other, in a direction drawn so that expectations stay, until
one of them is whole; words, not documents, are conserved. What is left of a
group is one fractional document, and those are paired up a tree of groups.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rateweave.llm.tables import (
    counted_chunks, id_text, in_chunks, join_id, keep, pieces, text_mark, whole_rows,
)
from rateweave.llm.words import WORD

WEIGHTS = (1, 2, 3)
MOST_TIMES = 3
LEAF_ROWS = 4096
FAN_IN = 64


def target_sizes(
    sizes: Sequence[int], weights: Sequence[float], most_times: float = MOST_TIMES
) -> list[float]:
    """Share the sum of ``sizes`` by weight; none above ``most_times`` its own size."""
    out = [0.0] * len(sizes)
    free, left = set(range(len(sizes))), float(sum(sizes))
    while free:
        share = left / sum(weights[i] for i in free)
        full = [i for i in sorted(free) if share * weights[i] > most_times * sizes[i]]
        if not full:
            for i in free:
                out[i] = share * weights[i]
            break
        for i in full:
            out[i] = float(most_times * sizes[i])
            left -= out[i]
            free.discard(i)
    return out


def _draw(seed: int, *parts: object) -> float:
    """Uniform number in [0, 1) that only depends on its arguments."""
    return zlib.crc32(repr((seed, *parts)).encode()) / 2**32


def pair_up(
    sizes: Sequence[int], chances: Sequence[float], draws: Sequence[float]
) -> tuple[list[int], int]:
    """Round the chances in order; gives 0 or 1 each, and the one left (-1: none).

    The entry of the one left is meaningless; its chance is in ``chances``, which
    must be a list and is changed. Given in descending size, the one left tends to
    be small: a large document is settled by the many smaller ones after it.
    """
    out = [0] * len(sizes)
    held = -1
    for i, chance in enumerate(chances):
        if chance <= 1e-12 or chance >= 1 - 1e-12:
            out[i] = round(chance)
            continue
        if held < 0:
            held = i
            continue
        p, q, ratio = chances[held], chance, sizes[i] / sizes[held]
        up, down = min(1 - p, q * ratio), min(p, (1 - q) * ratio)
        move = up if draws[i] * (up + down) < down else -down
        p, q = p + move, q - move / ratio
        first_done = p <= 1e-12 or p >= 1 - 1e-12
        if first_done:
            out[held] = round(p)
        if q <= 1e-12 or q >= 1 - 1e-12:
            out[i] = round(q)
            chances[held] = p
            if first_done:
                held = -1
        else:
            chances[i] = q
            held = i
    return out, held


LEAF = (
    "leaf long, place long, doc_id string, text_mark long, source string, size long, source_size long, "
    "target double, whole long, extra long, chance double"
)
LEFT = "source string, leaf long, place long, size long, chance double, extra long"


def _round_leaf(seed: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(
            ["source", "size", "mark", "doc_id", "text_mark"], ascending=[True, False, True, True, True]
        )
        rows = rows.reset_index(drop=True)
        rows["place"] = np.arange(len(rows))
        rate = np.where(
            rows.source_size > 0, rows.target / rows.source_size.clip(lower=1), 0.0
        )
        rows["whole"] = np.floor(rate + 1e-12).astype("int64")
        chance = np.clip(rate - rows["whole"], 0, 1)
        rows["chance"] = np.where(rows["size"] > 0, chance, 0.0)
        rows["extra"] = 0
        left = np.zeros(len(rows), bool)
        for _, part in rows.groupby("source", sort=False, dropna=False):
            draws = [_draw(seed, m, s) for m, s in zip(part.mark, part["size"], strict=True)]
            chances = part.chance.tolist()
            extra, held = pair_up(part["size"].tolist(), chances, draws)
            rows.loc[part.index, "extra"] = extra
            if held >= 0:
                left[part.index[held]] = True
                rows.loc[part.index[held], "chance"] = chances[held]
        rows["chance"] = np.where(left, rows.chance, np.nan)
        rows["extra"] = rows.extra.where(~left, -1)
        return rows[[f.split()[0] for f in LEAF.split(", ")]]

    return run


def _round_level(seed: int, level: int, last: bool):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "leaf", "place"], ascending=[False, True, True])
        rows = rows.reset_index(drop=True)
        draws = [
            _draw(seed, level, a, b) for a, b in zip(rows.leaf, rows.place, strict=True)
        ]
        chances = rows.chance.tolist()
        extra, held = pair_up(rows["size"].tolist(), chances, draws)
        if held >= 0:
            if last:
                extra[held] = int(_draw(seed, "last", *rows.source[:1]) < chances[held])
            else:
                extra[held] = -1
        rows["extra"], rows["chance"] = extra, chances
        return rows[[f.split()[0] for f in LEFT.split(", ")]]

    return run


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    most_times: float = MOST_TIMES,
    seed: int = 17,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """How often each document is taken so that sources reach their target words.

    Takes ``doc_id``, ``text``, ``source``; other columns are ignored. Sources in
    code-point order, null last, get ``weights`` in turn and share all words; one
    that would need more than ``most_times`` its own words stays there. Gives one
    row per input row: doc_id, text_mark, size (words; 0 for null or empty text), source,
    source_size, target, copies, taken (``copies * size``). Repeated rows and null
    ids are rows of their own; documents without words take no part and get 0
    copies beyond the whole part; an empty table gives no rows.

    Per source there is one row in the driver; documents stay distributed. Groups
    are cut by a hash of the rows, not of the source, so a source of any size is
    spread, and equal rows are counted first and dealt in chunks, so a row that is
    a third of the table is spread too; the same rows give the same result in any
    partitioning.
    """
    sized = docs.select(
        id_text("doc_id"),
        F.col("source").cast("string").alias("source"),
        text_mark().alias("text_mark"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    sized = keep(sized, "mix-sizes")
    spark = sized.sparkSession
    sources = sized.groupBy("source").agg(
        F.sum("size").alias("words"), F.count("*").alias("n")
    ).collect()
    sources.sort(key=lambda r: (r.source is None, r.source or ""))
    goal = target_sizes(
        [r.words for r in sources],
        [weights[i % len(weights)] for i in range(len(sources))],
        most_times,
    )
    goals = spark.createDataFrame(
        [(r.source, r.words, g) for r, g in zip(sources, goal, strict=True)],
        "goal_source string, source_size long, target double",
    )
    leaves = pieces(sum(r.n for r in sources), leaf_rows)
    alike = counted_chunks(sized, ["doc_id", "text_mark", "source", "size"])
    mark = F.xxhash64("doc_id", "text_mark", "source", "size", "chunk", F.lit(seed))
    rows = alike.join(goals, alike.source.eqNullSafe(goals.goal_source)).select(
        "doc_id", "text_mark", "source", "size", "source_size", "target", mark.alias("mark"),
        F.pmod(mark, F.lit(leaves)).alias("leaf"), F.explode(F.sequence(F.lit(1), "times")).alias("time"),
    )
    leaf = keep(rows.groupBy("leaf").applyInPandas(_round_leaf(seed), LEAF), "mix-leaves")

    left = leaf.where("extra < 0").select("source", "leaf", "place", "size", "chance")
    done, level, groups = [], 0, leaves
    while True:
        level, groups = level + 1, pieces(groups, FAN_IN)
        last = groups == 1
        group = F.floor(F.col("leaf") / F.lit(FAN_IN**level))
        out = keep(
            left.groupBy("source", group.alias("group")).applyInPandas(
                _round_level(seed, level, last), LEFT
            ),
            "mix-level",
        )
        done.append(out.where("extra >= 0").select("leaf", "place", F.col("extra").alias("late")))
        if last:
            break
        left = out.where("extra < 0").drop("extra")
    late = done[0]
    for more in done[1:]:
        late = late.unionByName(more)
    copies = F.col("whole") + F.coalesce("late", "extra")
    return leaf.join(late, ["leaf", "place"], "left").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text_mark", "size", "source", "source_size",
        "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"),
    )


def _source_key(name: str) -> Column:
    """A source as it is joined by: null is a source of its own."""
    source = F.col(name).cast("string")
    return F.when(source.isNull(), "").otherwise(F.concat(F.lit("="), source)).alias("source_key")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every row as often as :func:`mix` takes it; all columns stay.

    Rows equal in id (null ids are equal), source and text (null is empty) are one
    row here, which carries the copies of all; an empty table gives no rows.
    """
    taken = mix(docs, **options).select(
        join_id().alias("id"), F.col("text_mark").alias("mark"), _source_key("source"), "copies"
    )
    keys = ["id", "mark", "source_key"]
    taken = taken.groupBy(keys).agg(F.sum("copies").alias("times")).where("times > 0")
    # A task sends rows equal in all three on as one, so the texts of a hot row stay where they are.
    rows = whole_rows(docs).select("*", _source_key("row.source"))
    joined = rows.groupBy(keys).agg(F.first("row").alias("row")).join(taken, keys)
    copies = F.explode(F.sequence(F.lit(1), "times"))
    return in_chunks(joined.select("row", "times"), "times").select("row", copies.alias("copy")).select("row.*")
