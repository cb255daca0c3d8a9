"""URL filter: rules and listed words in memory-mapped files of sorted 64-bit digests.

Each listed string has a key, its XXH64, and the keys are sorted. The files go to every
executor once and are mapped, not loaded: tasks of one machine share their pages. A
batch of URLs gives strings to look for (parts of hosts, and hosts with beginnings of
paths), whose keys are searched by bisection all at once; where a key is found, the
stored string decides, as different strings can share a key.
"""

from __future__ import annotations

import itertools
import os
import re
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rateweave.llm.tables import id_text, keep

ALLOW, BLOCK = "allow", "block"
SEED = 42
# Host and path of a URL.
PARTS = "://([^/?#]*)([^?#]*)"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = str.maketrans(CAPITALS, CAPITALS.lower())
# Words in names of hosts that serve gambling, adult, drug, advertising or spam pages.
WORDS = (
    "ad", "ads", "adult", "adserver", "adware", "banner", "bet", "bets", "betting", "bingo", "bookie",
    "cam", "cams", "casino", "cialis", "clickbait", "doorway", "escort", "escorts", "erotic", "gambling",
    "hentai", "jackpot", "levitra", "lottery", "malware", "nude", "payday", "pharmacy", "phishing", "pill",
    "pills", "poker", "porn", "porno", "roulette", "sex", "sexcam", "slots", "spam", "spyware", "tracker",
    "tracking", "viagra", "warez", "xanax", "xxx",
)
# Between the words of a host.
WORD_END = r"[.\-_]"
# Listed strings per file, and bytes of all files that each machine may have to hold.
FILE_ENTRIES = 1 << 22
MOST_BYTES = 1 << 35
# A key and two offsets.
ENTRY_BYTES = 24

RESULT = "page_id string, host string, path string, rule string, verdict string, word string"


class Entry(NamedTuple):
    """Kinds of listed strings, told apart by their first letter."""

    rule: str = "R"  # host and path -> verdict
    host: str = "H"  # host of a rule -> lengths of its rules' paths
    word: str = "W"  # word of a host


class Part(NamedTuple):
    """A file of digests: where it is, and the sizes of what it holds."""

    name: str
    entries: int
    text_bytes: int
    value_bytes: int
    longest_host: int


class Digests:
    """The sorted keys, strings and values of one file, mapped."""

    def __init__(self, path: str, part: Part) -> None:
        n, at = part.entries, 0

        def mapped(kind: type, size: int) -> np.ndarray:
            nonlocal at
            out = np.memmap(path, kind, "r", at, (size,)) if size else np.zeros(0, kind)
            at += size * np.dtype(kind).itemsize
            return out

        self.keys = mapped(np.int64, n)
        self.text_at, self.value_at = mapped(np.int64, n + 1), mapped(np.int64, n + 1)
        self.texts, self.values = mapped(np.uint8, part.text_bytes), mapped(np.uint8, part.value_bytes)

    def find(self, strings: list[bytes], keys: np.ndarray) -> dict[bytes, str]:
        """Values of those of the strings, given with their keys, that are listed."""
        first = np.searchsorted(self.keys, keys, "left")
        last = np.searchsorted(self.keys, keys, "right")
        found = {}
        for i in np.flatnonzero(last > first).tolist():
            for at in range(first[i], last[i]):
                if self.texts[self.text_at[at] : self.text_at[at + 1]].tobytes() == strings[i]:
                    found[strings[i]] = self.values[self.value_at[at] : self.value_at[at + 1]].tobytes().decode()
        return found


def digests(strings: list[bytes]) -> np.ndarray:
    """XXH64 of each string as signed 64 bits, as SQL's ``xxhash64`` gives it."""
    found = (xxhash.xxh64_intdigest(s, SEED) for s in strings)
    return np.fromiter(found, np.uint64, len(strings)).view(np.int64)


def entries(rules: DataFrame, words: DataFrame) -> DataFrame:
    """``key, text, value`` of everything listed.

    Of rules for one host and path that say both, the blocking one counts; rules
    without a host or verdict, and null or empty words, are left out.
    """
    kind = Entry()
    own = rules.select(F.translate("host", CAPITALS, CAPITALS.lower()).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
    own = own.where("host <> '' AND verdict IS NOT NULL")
    by_rule = own.groupBy(F.concat(F.lit(kind.rule), "host", "path").alias("text"))
    by_host = own.groupBy(F.concat(F.lit(kind.host), "host").alias("text"))
    sizes = F.array_join(F.array_sort(F.collect_set(F.length("path"))), ",")
    listed = words.where("word <> ''").select(F.concat(F.lit(kind.word), F.translate("word", CAPITALS, CAPITALS.lower())).alias("text")).distinct()
    both = by_rule.agg(F.max("verdict").alias("value")).unionAll(by_host.agg(sizes.alias("value")))
    both = both.unionAll(listed.withColumn("value", F.lit("")))
    return both.select(F.xxhash64("text").alias("key"), "text", "value")


def _write(path: str, rows: tuple) -> Part:
    texts = [row.text.encode() for row in rows]
    values = [row.value.encode() for row in rows]
    with open(path, "wb") as file:
        np.array([row.key for row in rows], np.int64).tofile(file)
        for parts in (texts, values):
            np.cumsum([0, *map(len, parts)], dtype=np.int64).tofile(file)
        for parts in (texts, values):
            file.write(b"".join(parts))
    host = Entry().host
    longest = max((len(row.text) - 1 for row in rows if row.text[0] == host), default=0)
    return Part(os.path.basename(path), len(rows), sum(map(len, texts)), sum(map(len, values)), longest)


def publish(
    spark: SparkSession, listed: DataFrame, file_entries: int = FILE_ENTRIES, most_bytes: int = MOST_BYTES
) -> list[Part]:
    """Give the executors the listed strings, as files of sorted digests.

    Every machine holds the files on its disk, so their size is looked at first: a list
    of more than ``most_bytes`` is an error. It passes through the driver in the order
    of its keys, ``file_entries`` at a time.
    """
    listed = keep(listed, "url-list")
    size = listed.agg(F.sum(ENTRY_BYTES + F.octet_length("text") + F.octet_length("value"))).first()[0] or 0
    if size > most_bytes:
        raise ValueError(f"the list has {size} bytes, more than the {most_bytes} that a machine may hold")
    # Where Spark keeps the files it hands out, also to executors that start later.
    folder, parts = SparkFiles.getRootDirectory(), []
    for some in itertools.batched(listed.orderBy("key", "text").toLocalIterator(), file_entries):
        path = f"{folder}/{uuid.uuid4().hex}.digests"
        parts.append(_write(path, some))
        spark.sparkContext.addFile(path)
    return parts


def host_tails(host: str, longest: int) -> Iterator[str]:
    """The host and the names of its parent domains, up to ``longest`` characters."""
    at = 0
    if len(host) > longest:
        at = host.find(".", len(host) - longest - 1) + 1
        if not at:
            return
    while True:
        yield host[at:]
        at = host.find(".", at) + 1
        if not at:
            return


def _look_up(parts: list[tuple[Part, Digests]], strings: list[str]) -> dict[str, str]:
    coded = [s.encode("utf-8", "surrogatepass") for s in strings]
    keys, found = digests(coded), {}
    for _, part in parts:
        found |= part.find(coded, keys)
    return {s.decode(): value for s, value in found.items()}


def _judge(batches: Iterator[pd.DataFrame], parts: list[Part]) -> Iterator[pd.DataFrame]:
    kind, word_end = Entry(), re.compile(WORD_END)
    opened = [(part, Digests(SparkFiles.get(part.name), part)) for part in parts]
    longest = max((part.longest_host for part in parts), default=0)
    for batch in batches:
        tails, words = {}, {}
        for host in batch.host.unique().tolist():
            tails[host] = [kind.host + tail for tail in host_tails(host, longest)]
            words[host] = {kind.word + word for word in word_end.split(host) if word}
        known = _look_up(opened, sorted({t for own in tails.values() for t in own}))
        listed = _look_up(opened, sorted(set().union(*words.values())))
        # For each host, the rules' hosts it belongs to, with the lengths of their paths.
        rules = {
            host: [(t[1:], sorted(map(int, known[t].split(",")))) for t in own if t in known]
            for host, own in tails.items()
        }
        wanted = [
            [
                (tail, tail + path[:size])
                for tail, sizes in rules[host] for size in sizes if size <= len(path)
            ]
            for host, path in zip(batch.host, batch.path, strict=True)
        ]
        verdicts = _look_up(opened, sorted({kind.rule + text for own in wanted for _, text in own}))
        chosen = []
        for own in wanted:
            fitting = [(len(text), len(tail), text) for tail, text in own if kind.rule + text in verdicts]
            chosen.append(max(fitting, default=(0, 0, None))[2])
        yield pd.DataFrame({
            "page_id": batch.page_id, "host": batch.host, "path": batch.path, "rule": chosen,
            "verdict": [text and verdicts[kind.rule + text] for text in chosen],
            "word": [min((w[1:] for w in words[host] if w in listed), default=None) for host in batch.host],
        })


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z in lower case, and path of a URL; both empty without ``://``."""
    host, path = (F.coalesce(F.regexp_extract(url, PARTS, i), F.lit("")) for i in (1, 2))
    return F.translate(host, CAPITALS, CAPITALS.lower()), path


def judge(
    pages: DataFrame,
    rules: DataFrame,
    words: DataFrame | None = None,
    file_entries: int = FILE_ENTRIES,
    most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """Which URLs the rules, and else the listed words of hosts, allow or block.

    ``pages`` has ``page_id`` and ``url``; other columns are ignored. A rule (``host,
    path, verdict``) fits its host and all below it, if the URL's path begins with the
    rule's; the longest one that fits counts, of equally long ones that of the longer
    host. Where none fits, a URL is blocked if a word of its host is listed (``word``;
    :data:`WORDS` by default) and allowed otherwise. Gives page_id, host, path, rule,
    verdict, and the listed ``word`` of the host that is first in the alphabet.

    A null URL, or one without ``://``, has an empty host and path, which no rule fits:
    it is allowed. Repeated rows and null ids keep their rows; an empty table gives
    none. An empty list of rules and words allows everything.
    """
    spark = pages.sparkSession
    if words is None:
        words = spark.createDataFrame([(w,) for w in WORDS], "word string")
    parts = publish(spark, entries(rules, words), file_entries, most_bytes)
    host, path = url_parts(F.col("url"))
    urls = pages.select(id_text("page_id"), host.alias("host"), path.alias("path"))
    judged = urls.mapInPandas(lambda it: _judge(it, parts), RESULT)
    other = F.when(F.col("word").isNotNull(), BLOCK).otherwise(ALLOW)
    return judged.select(
        F.col("page_id").cast("long").alias("page_id"), "host", "path", "rule",
        F.coalesce("verdict", other).alias("verdict"), "word",
    )


def blocked_out(pages: DataFrame, rules: DataFrame, words: DataFrame | None = None) -> DataFrame:
    """The rows of ``pages``, with all columns, whose URLs are allowed.

    No row is shuffled: rows are judged where they are read.
    """
    spark = pages.sparkSession
    if words is None:
        words = spark.createDataFrame([(w,) for w in WORDS], "word string")
    parts = publish(spark, entries(rules, words))
    return pages.mapInArrow(lambda it: _allowed(it, parts), pages.schema)


def _allowed(batches: Iterator[pa.RecordBatch], parts: list[Part]) -> Iterator[pa.RecordBatch]:
    split = re.compile(PARTS)
    for batch in batches:
        found = [split.search(url or "") for url in batch.column("url").to_pylist()]
        hosts = [m[1].translate(LOWER) if m else "" for m in found]
        frame = pd.DataFrame({"page_id": None, "host": hosts, "path": [m[2] if m else "" for m in found]})
        judged = next(_judge(iter([frame]), parts))
        blocks = (judged.verdict == BLOCK) | (judged.verdict.isna() & judged.word.notna())
        yield batch.filter(pa.array(~blocks.to_numpy(bool)))
