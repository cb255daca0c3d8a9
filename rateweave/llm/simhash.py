"""Near-duplicates by SimHash, found through an index over fingerprint bytes.

Fingerprints with at most three differing bits agree in at least five of their
eight bytes. The index lists fingerprints under the bytes they hold at given
positions; each pair of a list is tallied by its shared positional bytes, kept if
it has the five that are guaranteed, and verified bit by bit.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rateweave.llm import words
from rateweave.llm.components import components
from rateweave.llm.tables import id_text, join_id, keep, text_mark, whole_rows

SHINGLE = 3
SEED = 42
MOST_BITS = 3
BYTES = 8
SHARED = BYTES - MOST_BITS
# Of any five positions, three lie in the same half: so each pair shares one of these.
TRIPLES = [t for half in ((0, 1, 2, 3), (4, 5, 6, 7)) for t in itertools.combinations(half, 3)]
# Lists longer than this are split by two more of the positions.
LONG_LIST = 1024
CHUNK = 512
# Parts longer than this are searched by turning bits instead of comparing pairs.
PAIR_LIST = 8192

PRINT = "doc_id string, fp long, n_words long, text_mark long"


def fingerprints(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """SimHash of each text as signed 64 bits, and its number of words."""
    out, sizes = np.zeros(len(texts), np.uint64), np.zeros(len(texts), np.int64)
    digest, bit = xxhash.xxh64_intdigest, np.arange(64, dtype=np.uint64)
    for i, text in enumerate(texts):
        # ASCII white space separates words, as bytes.split() has it.
        found = (text or "").encode().lower().split()
        sizes[i] = len(found)
        if not found:
            continue
        total, n = np.zeros(64, np.int64), max(1, len(found) - SHINGLE + 1)
        for at in range(0, n, 1 << 16):
            most = min(n, at + (1 << 16))
            hashes = np.fromiter(
                (digest(b" ".join(found[k : k + SHINGLE]), SEED) for k in range(at, most)),
                np.uint64, most - at,
            )
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            total += bits.sum(axis=0, dtype=np.int64)
        out[i] = np.bitwise_or.reduce(np.where(2 * total > n, np.uint64(1) << bit, np.uint64(0)))
    return out.view(np.int64), sizes


def _print(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        fp, sizes = fingerprints(batch.text.tolist())
        out = {"doc_id": batch.doc_id, "fp": fp, "n_words": sizes, "text_mark": batch.text_mark}
        yield pd.DataFrame(out)


def _linked(fps: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Which of ``near`` link to which of ``fps``: tally of shared bytes, then bits."""
    differ = fps[:, None] ^ near[None, :]
    tally = (differ.view(np.uint8).reshape(len(fps), len(near), BYTES) == 0).sum(axis=2)
    close = tally >= SHARED
    close[close] = np.bitwise_count(differ[close]) <= MOST_BITS
    return close


def _join(label: np.ndarray, i: int, others: np.ndarray) -> None:
    """Give the components of ``i`` and ``others`` one label, the least."""
    have = np.unique(np.append(label[others], label[i]))
    if len(have) > 1:
        label[np.isin(label, have[1:])] = have[0]


def _by_pairs(fps: np.ndarray, label: np.ndarray) -> None:
    """Compare all pairs, block against block."""
    for a in range(0, len(fps), CHUNK):
        for b in range(a, len(fps), CHUNK):
            close = _linked(fps[a : a + CHUNK], fps[b : b + CHUNK])
            for i in np.flatnonzero(close.any(axis=1)):
                _join(label, a + i, b + np.flatnonzero(close[i]))


def _by_probes(fps: np.ndarray, label: np.ndarray, free: list[int]) -> None:
    """Look up each value with one, two and three of the ``free`` bits turned."""
    for n in range(1, MOST_BITS + 1):
        for bits in itertools.combinations(free, n):
            other = fps ^ np.uint64(sum(1 << b for b in bits))
            at = np.minimum(np.searchsorted(fps, other), len(fps) - 1)
            hit = np.flatnonzero((fps[at] == other) & (label != label[at]))
            top: dict[int, int] = {}

            def root(x: int, top: dict[int, int] = top) -> int:
                while x in top:
                    x = top[x]
                return x

            for x, y in zip(label[hit].tolist(), label[at[hit]].tolist(), strict=True):
                x, y = root(x), root(y)
                if x != y:
                    top[max(x, y)] = min(x, y)
            if top:
                names = np.arange(len(fps))
                for x in sorted(top):
                    names[x] = names[top[x]]
                label[:] = names[label]


def forest(values: list[int]) -> list[tuple[int, int]]:
    """Edges that join the linked fingerprints of one list, one per node at most.

    Memory is bounded by the list; what leaves is a star for each component of the
    list, as many rows as nodes, not the links themselves.
    """
    fps = np.sort(np.array(values, np.int64).view(np.uint64))
    label = np.arange(len(fps))
    free = int(np.bitwise_or.reduce(fps ^ fps[0]))
    bits = [b for b in range(64) if free >> b & 1]
    if len(fps) > PAIR_LIST and len(bits) <= 8 * MOST_BITS:
        _by_probes(fps, label, bits)
    else:
        _by_pairs(fps, label)
    signed = fps.view(np.int64)
    (inner,) = np.nonzero(label != np.arange(len(fps)))
    return list(zip(signed[inner].tolist(), signed[label[inner]].tolist(), strict=True))


def _forests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = [edge for values in batch.fps for edge in forest(values)]
        yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def _bytes_at(positions: Column | tuple, fp: str = "fp") -> Column:
    """The bytes of a fingerprint at some positions, the rest zero."""
    mask = sum(0xFF << (8 * p) for p in positions)
    return F.col(fp).bitwiseAND(F.lit(mask - (1 << 64) if mask >= 1 << 63 else mask))


def links(fps: DataFrame) -> DataFrame:
    """Edges (``a``, ``b``) that connect distinct fingerprints as their links do.

    Lists of the index are keyed by the bytes at three positions. A list of more
    than ``LONG_LIST`` is split by the bytes at any two of the other five: a link
    shares at least five, so two more. Such a part has five bytes in common, at
    most 2**24 fingerprints or 128 MB, whatever the input.
    """
    keys = F.array(*[
        F.struct(F.lit(i).alias("way"), _bytes_at(t).alias("key")) for i, t in enumerate(TRIPLES)
    ])
    listed = fps.select("fp", F.explode(keys).alias("k")).select("fp", "k.way", "k.key")
    sizes = listed.groupBy("way", "key").agg(F.count("*").alias("n")).where("n > 1")
    listed = listed.join(sizes, ["way", "key"])
    listed = keep(listed, "simhash-lists")
    more = []
    for i, triple in enumerate(TRIPLES):
        rest = [p for p in range(BYTES) if p not in triple]
        for j, pair in enumerate(itertools.combinations(rest, 2)):
            more.append((i, len(TRIPLES) + 10 * i + j, triple + pair))
    long_keys = F.lit(None)
    for i in range(len(TRIPLES)):
        own = F.array(*[
            F.struct(F.lit(way).alias("way"), _bytes_at(p).alias("key")) for t, way, p in more if t == i
        ])
        long_keys = F.when(F.col("way") == i, own).otherwise(long_keys)
    short = listed.where(F.col("n") <= LONG_LIST).select("way", "key", "fp")
    split = (
        listed.where(F.col("n") > LONG_LIST)
        .select("fp", F.explode(long_keys).alias("k"))
        .select("k.way", "k.key", "fp")
    )
    lists = (
        short.unionByName(split)
        .groupBy("way", "key")
        .agg(F.collect_list("fp").alias("fps"))
        .where(F.size("fps") > 1)
    )
    return lists.select("fps").mapInPandas(_forests, "a long, b long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Fingerprint and component of each document.

    Takes ``doc_id`` and ``text``; other columns are ignored. Gives one row per input
    row: doc_id, fp (signed 64 bits), n_words, text_mark, component (its name among
    fingerprints) and component_id, the smallest doc_id reachable over links of at
    most three differing bits. Texts without words (null
    too) share fingerprint zero and are linked like any others; null ids take part
    but name a component only if it has no other id (then null). Copies are one
    node of the graph; a long text is taken whole; an empty table gives no rows.
    """
    prints = docs.select(id_text("doc_id"), "text", text_mark().alias("text_mark"))
    prints = prints.mapInPandas(_print, PRINT)
    prints = keep(prints.withColumn("doc_id", F.col("doc_id").cast("long")), "simhash-prints")
    nodes = keep(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-nodes")
    joined = keep(components(links(nodes.select("fp"))), "simhash-components")
    part = nodes.join(joined, nodes.fp == joined.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = part.groupBy("root").agg(F.min("first").alias("component_id"))
    # Few fingerprints are linked, but one component may hold most of them.
    named = part.join(least, "root").select("fp", F.col("root").alias("component"), "component_id")
    return prints.join(named, "fp").select(
        "doc_id", "fp", "n_words", "text_mark", "component", "component_id"
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: that of least doc_id, null last.

    All columns stay. Rows of equal doc_id (null ids are equal) and text (null is
    empty) are copies, and one of them stays; an empty table gives no rows.
    """
    near = near_duplicates(docs)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_mark")).alias("f")
    kept = near.groupBy("component").agg(first).select(
        join_id("f.doc_id").alias("id"), F.col("f.text_mark").alias("mark")
    )
    # Both steps need the same partitioning: the texts are shuffled once. A task sends
    # copies on as one, so those of a hot row stay where they are.
    once = whole_rows(docs).groupBy("id", "mark").agg(F.first("row").alias("row"))
    return once.join(kept, ["id", "mark"], "left_semi").select("row.*")


def fingerprint_text(fp: str = "fp") -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
