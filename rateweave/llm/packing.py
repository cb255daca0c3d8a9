"""Pack token sequences into as few fixed-length sequences as possible.

Best-fit decreasing looks at lengths only, and there are no more lengths than the
limit: the driver packs a histogram, whole runs of equal pieces at a time, finding
the tightest open capacity in a segment tree. Pieces then look their place up by
their rank among the pieces of their length.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rateweave.llm.tables import counted_chunks, id_text, keep, pieces

LIMIT = 2048
END_ID = 0
RANK_ROWS = 8192
# Text of these characters alone, without "<|", is split alike by both libraries.
PLAIN = re.compile(r"[^\t\n\r\x20-\x7e\xa1-ɏ]|<\|")

CUT = "doc_id string, piece int, start long, length long, ids_crc32 long"


class TokenIds:
    """Ids of a byte-level BPE vocabulary.

    The tokenizer's own library gives them. For plain text the same vocabulary as
    ranks gives the same ids in a third of the time.
    """

    def __init__(self, vocabulary: str, ranks: str | None) -> None:
        self.vocabulary, self.full, self.fast = vocabulary, None, None
        if ranks:
            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding(
                "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
            )

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is not None and not PLAIN.search(text):
            return np.asarray(self.fast.encode_to_numpy(text), "<u4")
        if self.full is None:
            self.full = Tokenizer.from_file(self.vocabulary)
        return np.array(self.full.encode(text, add_special_tokens=False).ids, "<u4")


def cut(length: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces; only the first may be shorter than the limit."""
    first = (length - 1) % limit + 1
    return [(0, first)] + [(at, limit) for at in range(first, length, limit)]


def _cut_documents(batches: Iterator[pd.DataFrame], vocabulary: str, ranks: str, limit: int):
    ids_of = TokenIds(vocabulary, ranks)
    for batch in batches:
        out = []
        for doc_id, text in zip(batch.doc_id, batch.text, strict=True):
            ids = np.append(ids_of(text or ""), np.array([END_ID], "<u4")).astype("<u4")
            for i, (start, length) in enumerate(cut(len(ids), limit)):
                out.append((doc_id, i, start, length, zlib.crc32(ids[start : start + length])))
        yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])


class Capacities:
    """Segment tree over remaining capacities: is any bin open at a capacity."""

    def __init__(self, limit: int) -> None:
        self.size = 1 << limit.bit_length()
        self.some = np.zeros(2 * self.size, bool)

    def set(self, capacity: int, is_open: bool) -> None:
        at = self.size + capacity
        self.some[at] = is_open
        while at > 1:
            at //= 2
            self.some[at] = self.some[2 * at] or self.some[2 * at + 1]

    def tightest(self, least: int) -> int | None:
        """Smallest open capacity of at least ``least``."""
        at = self.size + least
        while not self.some[at]:
            while at & 1:  # a right child: nothing further right below the parent
                at //= 2
                if at <= 1:
                    return None
            at += 1
        while at < self.size:
            at = 2 * at if self.some[2 * at] else 2 * at + 1
        return at - self.size


class Run(NamedTuple):
    """Pieces of a length from ``rank`` on go to one bin each, from ``bin`` on."""

    length: int
    rank: int
    bin: int
    offset: int


def best_fit_decreasing(counts: dict[int, int], limit: int = LIMIT) -> tuple[list[Run], int]:
    """Runs for ``counts`` pieces of each length, and the number of bins.

    Bins of equal remaining capacity are kept as ranges of numbers, so the work
    depends on the number of lengths, not of pieces. Of each length the tightest
    bins are filled as far as they go, as if the pieces came one by one.
    """
    tree = Capacities(limit)
    open_bins: dict[int, list[tuple[int, int]]] = {}
    runs: list[Run] = []
    used = 0

    def put(capacity: int, first: int, n: int) -> None:
        if capacity > 0 and n > 0:
            ranges = open_bins.setdefault(capacity, [])
            if ranges and ranges[-1][0] + ranges[-1][1] == first:
                ranges[-1] = (ranges[-1][0], ranges[-1][1] + n)
            else:
                ranges.append((first, n))
            tree.set(capacity, True)

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            capacity = tree.tightest(length)
            if capacity is None:
                capacity, first, n = limit, used, left
            else:
                first, n = open_bins[capacity].pop()
                if not open_bins[capacity]:
                    tree.set(capacity, False)
            each = capacity // length
            full = min(n, left // each)
            for i in range(each if full else 0):
                runs.append(Run(length, rank, first, limit - capacity + i * length))
                rank += full
            left -= full * each
            put(capacity - each * length, first, full)
            taken = full
            if left and full < n and left < each:
                for i in range(left):
                    runs.append(Run(length, rank, first + full, limit - capacity + i * length))
                    rank += 1
                put(capacity - left * length, first + full, 1)
                taken, left = full + 1, 0
            if first == used:
                used += taken
            else:
                put(capacity, first + taken, n - taken)
    return runs, used


def _place(batches: Iterator[pd.DataFrame], runs) -> Iterator[pd.DataFrame]:
    starts, bins, offsets, ranks = runs
    for batch in batches:
        key = batch.length.to_numpy() * (1 << 44) + batch["rank"].to_numpy()
        run = np.searchsorted(starts, key, "right") - 1
        batch["sequence_id"] = bins[run] + batch["rank"].to_numpy() - ranks[run]
        batch["offset"] = offsets[run]
        yield batch.drop(columns="rank")


def pack(
    docs: DataFrame,
    vocabulary: str | None = None,
    ranks: str | None = None,
    limit: int = LIMIT,
    rank_rows: int = RANK_ROWS,
) -> DataFrame:
    """Place of every piece of every document.

    Takes ``doc_id`` and ``text``; other columns are ignored. A document is its ids
    and an end id; only one longer than ``limit`` is cut. Gives a row per piece:
    doc_id, piece, start, length, ids_crc32, sequence_id, offset. A null or empty
    text is the end id alone; repeated rows and null ids are documents of their
    own; pieces of equal length are interchangeable and ordered by doc_id and piece;
    an empty table gives no rows. Equal pieces are counted first and ranked in
    chunks, so that none is one task's work. ``vocabulary`` and ``ranks`` are paths that every
    executor can open; without ``ranks`` the tokenizer's library does all texts.
    """
    if vocabulary is None:
        vocabulary = public_tokenizers.path("byte_bpe_50k.json")
        ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    texts = docs.select(id_text("doc_id"), "text")
    parts = keep(
        texts.mapInPandas(lambda it: _cut_documents(it, vocabulary, ranks, limit), CUT), "pack-pieces"
    )
    counts = {r.length: r.n for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs, _ = best_fit_decreasing(counts, limit)
    runs.sort()
    columns = [np.array([getattr(r, name) for r in runs], np.int64) for name in ("bin", "offset", "rank")]
    starts = np.array([r.length * (1 << 44) + r.rank for r in runs], np.int64)
    shared = docs.sparkSession.sparkContext.broadcast((starts, *columns))

    groups = pieces(sum(counts.values()), rank_rows)
    alike = counted_chunks(parts, ["doc_id", "piece", "start", "length", "ids_crc32"])
    group = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "chunk"), F.lit(groups))
    dealt = alike.withColumn("group", group)
    sizes = dealt.groupBy("length", "group").agg(F.sum("times").alias("n"))
    before = Window.unboundedPreceding, -1
    earlier = Window.partitionBy("length").orderBy("group").rowsBetween(*before)
    sizes = sizes.select("length", "group", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "group").orderBy(
        F.col("doc_id").cast("long"), "piece", "ids_crc32", "start", "chunk"
    ).rowsBetween(*before)
    place = F.coalesce(F.sum("times").over(within), F.lit(0))
    ranked = dealt.withColumn("place", place).join(sizes, ["length", "group"])
    ranked = ranked.select("*", F.explode(F.sequence(F.lit(0), F.col("times") - 1)).alias("time")).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("before") + F.col("place") + F.col("time")).cast("long").alias("rank"),
    )
    placed = ranked.mapInPandas(
        lambda it: _place(it, shared.value), CUT + ", sequence_id long, offset long"
    )
    return placed.withColumn("doc_id", F.col("doc_id").cast("long"))
