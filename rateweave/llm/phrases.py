"""Collocations: frequent phrases whose words occur together more than apart.

Phrases are counted in tries: a few levels of nodes by word number, below them hash
containers of the remaining words, which burst into a node when they grow too large.
A task whose tries are full writes out whole subtrees as sorted runs; the runs are
merged per prefix partition, that is by the words all phrases of a subtree begin with.

Most phrases are too rare, and never come to the tries. Before them passes over the
texts count phrases by 64-bit hash, as sorted arrays: words and pairs, then three to five
words. A hash is counted at least as often as any phrase that has it, and a phrase is not
more frequent than its parts, so each pass skips what the pass before found to be too
rare, as a bit table of bounded size remembers it. The table can only let through too
much, never too little: the tries' counts of whole phrases are exact.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rateweave.llm.tables import UNKNOWN_BYTES, keep, pieces, shuffles_sized_for
from rateweave.llm.words import word_bounds, word_hashes
from rateweave.session import scan_bytes

LONGEST = 5
LEAST = 100
TOP = 2000
# A candidate goes if a longer one has at least this share (percent) of its occurrences.
INSIDE_PERCENT = 100
SCALE = 1000
NO_LANGUAGE = "und"
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"

# A container with more entries than this bursts.
BURST = 4096
# Entries of all tries of a task, and distinct words, before subtrees are written out.
MOST_ENTRIES = 1 << 20
MOST_WORDS = 1 << 18
# Bytes of text worked on together; longer texts are cut between words.
SLICE = 1 << 21
# Bits of the table of frequent phrases: 16 for each, within these bounds (16 MB).
FILTER_BITS = (16, 27)
HASHES = 4
RUN_ROWS = 1 << 16

# Phrases waiting to be added to the tries, or hashes, sorted and counted together.
WAITING = 1 << 22
RUN = "lang string, phrase string, n long"
PACKED_RUN = "part int, lang string, phrase array<string>, n array<long>"
# Hashes are summed in ranges, and runs merged in parts, one for so many bytes of input;
# so many at least where the size of the input is not known.
PART_BYTES, LEAST_PARTS = 1 << 23, 64
HASH_RUN = "part int, hashes binary, counts binary"
# Runs are dealt by so many first words; shorter phrases are counted on their own.
DEALT = 3
# Three word numbers make one 64-bit key.
NUMBER_BITS, PER_KEY = 21, 3


def _byte_table() -> bytes:
    """A-Z in lower case, and a line break for every byte that ends a piece."""
    table = bytearray(range(256))
    for c in range(ord("A"), ord("Z") + 1):
        table[c] = c + 32
    for c in PIECE_ENDS:
        table[c] = ord("\n")
    return bytes(table)


def slices(texts: list[str | None], table: bytes, most: int = SLICE) -> Iterator[tuple[bytes, bool]]:
    """Bytes of texts, a line break after each, some ``most`` at a time.

    Cut between texts, or between words of a long one; then the slice is marked as
    going on.
    """
    some, size = [], 0
    for text in texts:
        data = (text or "").encode("utf-8", "surrogatepass").translate(table)
        at = 0
        while len(data) - at > most:
            ends = [e for e in (data.find(c, at + most) for c in (b" ", b"\t", b"\n")) if e >= 0]
            to = min(ends, default=len(data))
            yield b"".join([*some, data[at:to]]), True
            some, size, at = [], 0, to
        some += [data[at:], b"\n"]
        size += len(data) - at + 1
        if size > most:
            yield b"".join(some), False
            some, size = [], 0
    if some:
        yield b"".join(some), False


class Trie:
    """Counts of word sequences behind the words that lead here."""

    __slots__ = ("ends", "held", "below")

    def __init__(self) -> None:
        self.ends, self.held, self.below = 0, {}, None

    def add(self, words: tuple[int, ...], n: int, burst: int) -> int:
        """Count a sequence; the number of new entries (0 or 1)."""
        node, at = self, 0
        while node.below is not None:
            if at == len(words):
                node.ends += n
                return 0
            child = node.below.get(words[at])
            if child is None:
                child = node.below[words[at]] = Trie()
            node, at = child, at + 1
        rest = words[at:]
        if not rest:
            node.ends += n
            return 0
        before = node.held.get(rest)
        node.held[rest] = n + (before or 0)
        if before is None and len(node.held) > burst:
            node.split(burst)
        return int(before is None)

    def split(self, burst: int) -> None:
        """The container becomes a level of nodes by next word."""
        held, self.held, self.below = self.held, {}, {}
        for words, n in held.items():
            child = self.below.get(words[0])
            if child is None:
                child = self.below[words[0]] = Trie()
            child.add(words[1:], n, burst)

    def entries(self, before: tuple[int, ...]) -> Iterator[tuple[tuple[int, ...], int]]:
        if self.ends:
            yield before, self.ends
        for words, n in self.held.items():
            yield before + words, n
        if self.below is not None:
            for word, child in self.below.items():
                yield from child.entries((*before, word))


class Counter:
    """Tries of one task, by language and first word."""

    def __init__(self, most: int = MOST_ENTRIES, burst: int = BURST, apart: int = 0) -> None:
        self.most, self.burst, self.apart = most, burst, apart
        self.tries: dict[tuple[str, int], Trie] = {}
        self.sizes: dict[tuple[str, int], int] = {}
        self.total = 0

    def add(self, lang: str, phrases: Iterable[tuple[tuple[int, ...], int]]) -> Iterator[None]:
        """Count phrases, best given in order; stops for a moment each time it is full."""
        last, trie, burst = None, None, self.burst
        for words, n in phrases:
            if words[0] != last:
                last = words[0]
                own = (lang, last)
                trie = self.tries.get(own)
                if trie is None:
                    trie = self.tries[own] = Trie()
                    self.sizes[own] = 1
                    self.total += 1
            if trie.add(words[1:], n, burst):
                self.sizes[own] += 1
                self.total += 1
                if self.total > self.most:
                    yield
                    last = None

    def spill(self, names: list[str], everything: bool) -> Iterator[pd.DataFrame]:
        """Runs of the largest subtrees, until half of the room is free, or of all.

        Phrases of up to ``apart`` words get here what is counted for longer ones.
        """
        run: list[tuple] = []
        name = names.__getitem__
        for own in sorted(self.sizes, key=self.sizes.get, reverse=True):
            if not everything and self.total <= self.most // 2:
                break
            lang, first = own
            entries = self.tries.pop(own).entries((first,))
            if self.apart:
                entries = _with_beginnings(entries, self.apart)
            run += [(lang, " ".join(map(name, words)), n) for words, n in entries]
            self.total -= self.sizes.pop(own)
            if len(run) >= RUN_ROWS:
                yield _sorted_run(run)
                run = []
        if run:
            yield _sorted_run(run)


def _with_beginnings(
    entries: Iterable[tuple[tuple[int, ...], int]], most: int
) -> Iterator[tuple[tuple[int, ...], int]]:
    """Entries of more than ``most`` words, and each beginning of up to so many with its sum."""
    sums: dict[tuple[int, ...], int] = {}
    for words, n in entries:
        if len(words) > most:
            yield words, n
        for size in range(1, min(most, len(words)) + 1):
            sums[words[:size]] = sums.get(words[:size], 0) + n
    yield from sums.items()


def _sorted_run(run: list[tuple[str, str, int]]) -> pd.DataFrame:
    return pd.DataFrame(sorted(run), columns=["lang", "phrase", "n"])


def chained(parts: list[np.ndarray]) -> np.ndarray:
    """Hash of each phrase, from those of its words in order."""
    out = parts[0].copy()
    for part in parts[1:]:
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + part
    return out ^ (out >> np.uint64(32))


def bit_place(hashes: np.ndarray, bits: int, i: int) -> np.ndarray:
    low, high = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    return (low + np.uint64(i) * high) & np.uint64((1 << bits) - 1)


def bit_places(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    """The places in a table of ``2 ** bits`` bits that stand for a hash."""
    return [bit_place(hashes, bits, i) for i in range(HASHES)]


def present(table: np.ndarray, bits: int, hashes: np.ndarray) -> np.ndarray:
    """Which hashes the table may hold."""
    left = np.arange(len(hashes))
    for i in range(HASHES):
        places = bit_place(hashes[left], bits, i)
        bit = table[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8)
        left = left[(bit & 1).view(bool)]
    found = np.zeros(len(hashes), bool)
    found[left] = True
    return found


def lengths(
    pieces: np.ndarray, hashes: np.ndarray, known: tuple[np.ndarray, int] | None, steps: range, longest: int
) -> np.ndarray:
    """Words of the longest phrase to count that begins at each word.

    It ends with its piece, after ``longest`` words, and where the table ``known`` shows
    some of its words, as many as one of ``steps``, to be too rare together.
    """
    n = len(pieces)
    places = np.arange(n)
    last = np.append(np.flatnonzero(np.diff(pieces)) + 1, n) if n else np.zeros(0, int)
    size = np.minimum(np.repeat(last, np.diff(last, prepend=0)) - places, longest)
    if known is not None:
        for step in steps:
            at = np.flatnonzero(size >= step)
            rare = at[~present(*known, chained([hashes[at + i] for i in range(step)]))]
            next_rare = np.full(n, n)
            next_rare[rare] = rare
            next_rare = np.minimum.accumulate(next_rare[::-1])[::-1]
            size = np.minimum(size, next_rare - places + step - 1)
    return size


def word_slices(
    batches: Iterator[pd.DataFrame], longest: int, cut: int
) -> Iterator[tuple[str, bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]]:
    """Texts a slice at a time: language, bytes, their array, begin, end and piece of each
    word, and at how many of the words phrases of up to ``longest`` words are counted."""
    table = _byte_table()
    for batch in batches:
        for lang, texts in batch.groupby("lang", sort=False).text:
            before = b""
            for part, goes_on in slices(texts.tolist(), table, cut):
                data = before + part
                array = np.frombuffer(data, np.uint8)
                begin, end = word_bounds(array)
                ends = np.searchsorted(begin, np.flatnonzero(array == 10))
                own = np.diff(ends, prepend=0, append=len(begin))
                # The last words of a slice that goes on are counted with the next one.
                n = len(begin) - (longest - 1 if goes_on else 0)
                before = data[begin[max(n, 0)] :] if goes_on and longest > 1 and len(begin) else b""
                if n > 0:
                    yield lang, data, array, begin, end, np.repeat(np.arange(len(own)), own), n


class Numbered:
    """Numbers of the distinct words of a task, from 1."""

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.names: list[str] = [""]

    def of(self, data: bytes, begin: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Number of each word; within a slice words are told apart by 64 bits."""
        _, first, place = np.unique(hashes, return_index=True, return_inverse=True)
        own = np.empty(len(first), np.int64)
        for i, (at, to) in enumerate(zip(begin[first].tolist(), end[first].tolist(), strict=True)):
            word = data[at:to]
            number = self.numbers.get(word)
            if number is None:
                number = self.numbers[word] = len(self.names)
                self.names.append(word.decode("utf-8", "surrogatepass"))
            own[i] = number
        return own[place]


def keys_of(numbers: np.ndarray, places: np.ndarray, size: np.ndarray, longest: int) -> np.ndarray:
    """A row of keys for the phrase at each place: its words' numbers, three to a key."""
    keys = np.zeros((-(-longest // PER_KEY), len(places)), np.int64)
    ahead = np.concatenate([numbers, np.zeros(longest, np.int64)])
    for i in range(longest):
        word = np.where(size > i, ahead[places + i], 0)
        keys[i // PER_KEY] |= word << (NUMBER_BITS * (PER_KEY - 1 - i % PER_KEY))
    return keys


def counted(parts: list[np.ndarray]) -> Iterator[tuple[tuple[int, ...], int]]:
    """The distinct phrases of some keys, as word numbers, and how often each is there."""
    keys = np.concatenate(parts, axis=1)
    parts.clear()
    if len(keys) == 1:
        keys.sort()
    else:
        keys = keys[:, np.lexsort(keys[::-1])]
    fresh = np.ones(keys.shape[1], bool)
    fresh[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
    at = np.flatnonzero(fresh)
    times = np.diff(np.append(at, keys.shape[1])).tolist()
    mask = (1 << NUMBER_BITS) - 1
    words = [
        (key[at] >> (NUMBER_BITS * (PER_KEY - 1 - i)) & mask) for key in keys for i in range(PER_KEY)
    ]
    size = sum((w > 0).astype(np.int64) for w in words).tolist()
    for row, n, k in zip(zip(*(w.tolist() for w in words), strict=True), times, size, strict=True):
        yield row[:k], n


def count_words(
    batches: Iterator[pd.DataFrame],
    lowest: int,
    longest: int,
    known: tuple[np.ndarray, int] | None = None,
    step: int = 1,
    most: int = MOST_ENTRIES,
    burst: int = BURST,
    cut: int = SLICE,
    apart: int = 0,
    totals: bool = False,
) -> Iterator[pd.DataFrame]:
    """Sorted runs of the phrases of ``lowest`` to ``longest`` words.

    A phrase is counted once at each place, with all its beginnings: the longest one
    there whose parts of up to ``step`` words the table ``known`` holds. Beginnings of up
    to ``apart`` words have rows of their own; :func:`merged` gives the others their
    counts. ``totals`` adds the number of all words of a language, as the phrase of none.
    """
    counter, numbered = Counter(most, burst, apart), Numbered()
    waiting: dict[tuple[str, int], list[np.ndarray]] = {}
    total: dict[str, int] = {}

    def add_waiting() -> Iterator[pd.DataFrame]:
        while waiting:
            (lang, _), keys = waiting.popitem()
            for _ in counter.add(lang, counted(keys)):
                yield from counter.spill(numbered.names, everything=False)

    held = 0
    for lang, data, array, begin, end, pieces, n in word_slices(batches, longest, cut):
        total[lang] = total.get(lang, 0) + n
        hashes = word_hashes(array, begin, end)
        size = lengths(pieces, hashes ^ np.uint64(language_seed(lang)), known, range(1, step + 1), longest)
        places = np.flatnonzero(size[:n] >= lowest)
        # Only words of phrases that are counted get a number.
        turns = np.bincount(places, minlength=len(begin) + 1)
        used = np.cumsum(turns - np.bincount(places + size[places], minlength=len(begin) + 1))[:-1] > 0
        numbers = np.zeros(len(begin), np.int64)
        numbers[used] = numbered.of(data, begin[used], end[used], hashes[used])
        # Short phrases have one key, which sorts faster than several.
        short = size[places] <= PER_KEY
        for own, at_most in ((places[short], min(PER_KEY, longest)), (places[~short], longest)):
            if len(own):
                waiting.setdefault((lang, at_most), []).append(keys_of(numbers, own, size[own], at_most))
        held += len(places)
        if held > WAITING or len(numbered.names) > MOST_WORDS:
            yield from add_waiting()
            held = 0
        if len(numbered.names) > MOST_WORDS:
            yield from counter.spill(numbered.names, everything=True)
            numbered = Numbered()
    yield from add_waiting()
    yield from counter.spill(numbered.names, everything=True)
    if totals:
        yield pd.DataFrame([(lang, "", n) for lang, n in total.items()], columns=["lang", "phrase", "n"])


def count_hashes(
    batches: Iterator[pd.DataFrame],
    lowest: int,
    longest: int,
    parts: int,
    known: tuple[np.ndarray, int] | None = None,
    most: int = WAITING,
    cut: int = SLICE,
) -> Iterator[pd.DataFrame]:
    """Counts, by hash, of all phrases of ``lowest`` to ``longest`` words.

    Hashes are dealt to ``parts`` by their range. The table ``known`` holds what is
    frequent of fewer words; its longest, of ``lowest - 1``, tell all that it can.
    """
    waiting, held = [], 0
    for lang, _, array, begin, end, pieces, n in word_slices(batches, longest, cut):
        hashes = word_hashes(array, begin, end) ^ np.uint64(language_seed(lang))
        size = lengths(pieces, hashes, known, range(lowest - 1, lowest), longest)[:n]
        for words in range(lowest, longest + 1):
            at = np.flatnonzero(size >= words)
            waiting.append(chained([hashes[at + i] for i in range(words)]))
            held += len(at)
        if held > most:
            yield _hash_runs(waiting, parts)
            held = 0
    if held:
        yield _hash_runs(waiting, parts)


def _hash_runs(waiting: list[np.ndarray], parts: int) -> pd.DataFrame:
    """Distinct hashes in order and how often each is there, a row per part; none wait then."""
    every = np.concatenate(waiting)
    waiting.clear()
    every.sort()
    fresh = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
    counts, own = np.diff(np.append(fresh, len(every))).astype("<u4"), every[fresh]
    part = (own >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
    cuts = np.flatnonzero(part[1:] != part[:-1]) + 1
    return pd.DataFrame({
        "part": part[np.append(0, cuts)].astype(np.int32),
        "hashes": [some.astype("<u8").tobytes() for some in np.split(own, cuts)],
        "counts": [n.tobytes() for n in np.split(counts, cuts)],
    })


def often(runs: pd.DataFrame, least: int) -> pd.DataFrame:
    """The hashes of a part that are counted at least ``least`` times in all."""
    hashes = np.concatenate([np.frombuffer(data, "<u8") for data in runs.hashes])
    counts = np.concatenate([np.frombuffer(data, "<u4") for data in runs.counts]).astype(np.int64)
    order = np.argsort(hashes)
    hashes = hashes[order]
    fresh = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
    frequent = np.add.reduceat(counts[order], fresh) >= least
    return pd.DataFrame({"hash": hashes[fresh[frequent]].view(np.int64)})


def language_seed(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), 1)


def packed(runs: Iterator[pd.DataFrame], dealt: int, parts: int) -> Iterator[pd.DataFrame]:
    """Runs as a row per part and language, dealt by the first ``dealt`` words of a phrase."""
    for run in runs:
        for lang, own in run.groupby("lang", sort=False):
            beginnings = (" ".join(phrase.split(" ", dealt)[:dealt]) for phrase in own.phrase.tolist())
            part = [zlib.crc32(b.encode("utf-8", "surrogatepass")) % parts for b in beginnings]
            of_part = own.groupby(np.array(part, np.int32))[["phrase", "n"]].agg(list)
            yield of_part.rename_axis("part").reset_index().assign(lang=lang)[["part", "lang", "phrase", "n"]]


def merged(runs: DataFrame, dealt: int, least: int) -> DataFrame:
    """``lang, phrase, n`` of all phrases found at least ``least`` times.

    One shuffle of :func:`packed` runs, to the part of the phrase's first ``dealt``
    words. There a phrase of as many or more follows its beginnings and one pass counts
    it for them. Shorter ones have entries of their own.
    """
    return runs.groupBy("part").applyInPandas(lambda rows: merge_part(rows, dealt, least), RUN)


def merge_part(rows: pd.DataFrame, dealt: int, least: int) -> pd.DataFrame:
    sums: dict[tuple[str, str], int] = {}
    for lang, phrases, counts in zip(rows.lang, rows.phrase, rows.n, strict=True):
        for phrase, n in zip(phrases.tolist(), counts.tolist(), strict=True):
            sums[lang, phrase] = sums.get((lang, phrase), 0) + n
    in_order = sorted(sums, key=lambda own: (own[0], own[1].split(" ")))
    frame = pd.DataFrame([(*own, sums[own]) for own in in_order], columns=["lang", "phrase", "n"])
    return pd.concat(sum_beginnings(iter([frame]), dealt, least))


def sum_beginnings(batches: Iterator[pd.DataFrame], lowest: int, least: int) -> Iterator[pd.DataFrame]:
    """Frequent phrases of rows in order.

    Those of at least ``lowest`` words have what is counted for longer ones.
    """
    lang, path, sums, out = None, [], [], []

    def close(depth: int) -> None:
        while len(path) > depth:
            n = sums.pop()
            if n and n >= least:
                out.append((lang, " ".join(path), n))
            path.pop()
            if len(path) >= lowest:
                sums[-1] += n

    for batch in batches:
        for own, phrase, n in zip(batch.lang.tolist(), batch.phrase.tolist(), batch.n.tolist(), strict=True):
            words = phrase.split(" ")
            same = 0
            if own == lang:
                for a, b in zip(words, path):
                    if a != b:
                        break
                    same += 1
            close(same)
            lang = own
            path += words[same:]
            sums += [0] * (len(words) - same)
            sums[-1] += n
        yield pd.DataFrame(out, columns=["lang", "phrase", "n"])
        out.clear()
    close(0)
    yield pd.DataFrame(out, columns=["lang", "phrase", "n"]).astype({"n": "int64"})


def _part(first: Column, size: Column) -> Column:
    """Some words of ``phrase``, from the ``first`` one (1 is the first)."""
    return F.array_join(F.slice(F.split("phrase", " "), first, size), " ")


def _mark(batches: Iterator[pd.DataFrame], bits: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        places = np.concatenate(bit_places(batch.hash.to_numpy(np.int64).view(np.uint64), bits))
        cells, place = np.unique(places >> np.uint64(5), return_inverse=True)
        marks = np.zeros(len(cells), np.int64)
        np.bitwise_or.at(marks, place, np.int64(1) << (places & np.uint64(31)).astype(np.int64))
        yield pd.DataFrame({"cell": cells.astype(np.int64), "mark": marks})


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for lang, phrases in batch.groupby("lang", sort=False).phrase:
            yield pd.DataFrame({"hash": phrase_hashes(lang, phrases.tolist()).view(np.int64)})


def phrase_hashes(lang: str, phrases: list[str]) -> np.ndarray:
    """Hashes of phrases of one number of words."""
    data = np.frombuffer("\n".join([*phrases, ""]).encode("utf-8", "surrogatepass"), np.uint8)
    hashes = word_hashes(data, *word_bounds(data)) ^ np.uint64(language_seed(lang))
    return chained(list(hashes.reshape(len(phrases), -1).T))


def bit_table(phrases: DataFrame, bounds: tuple[int, int] = FILTER_BITS) -> tuple[np.ndarray, int]:
    """Table of ``2 ** bits`` bits that holds the given phrases.

    They are given as ``hash``, or as ``lang, phrase``, then all of one length.
    """
    n = phrases.count()
    bits = min(max((16 * n).bit_length(), bounds[0]), bounds[1])
    hashes = phrases if "hash" in phrases.columns else phrases.mapInPandas(_hashed, "hash long")
    cells = hashes.mapInPandas(lambda it: _mark(it, bits), "cell long, mark long")
    table = np.zeros((1 << bits) // 32, np.uint32)
    for row in cells.groupBy("cell").agg(F.bit_or("mark").alias("mark")).toLocalIterator():
        table[row.cell] = row.mark
    return table.view(np.uint8), bits


def parts_for(texts: DataFrame) -> int:
    """Parts to sum hashes and to merge runs in: they grow in number with the input, not in size."""
    size = scan_bytes(texts)
    if size < UNKNOWN_BYTES:
        return pieces(size, PART_BYTES)
    return max(LEAST_PARTS, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def count_phrases(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST,
    most_entries: int = MOST_ENTRIES,
    burst: int = BURST,
) -> tuple[DataFrame, DataFrame]:
    """Frequent phrases (``lang, phrase, n_words, n``), and words (``total``) per ``lang``.

    A language with fewer than ``least`` words has no total.
    """
    texts = docs.select(F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"), "text")
    shared, parts = docs.sparkSession.sparkContext.broadcast, parts_for(texts)

    def frequent(lowest: int, highest: int, found: DataFrame | None = None) -> DataFrame:
        table = None if found is None else shared(bit_table(found))
        hashes = texts.mapInPandas(
            lambda it: count_hashes(it, lowest, highest, parts, table and table.value), HASH_RUN
        )
        summed = hashes.groupBy("part").applyInPandas(lambda runs: often(runs, least), "hash long")
        return keep(summed, f"phrase-hashes-{lowest}")

    with shuffles_sized_for(texts, 2):
        short = frequent(1, DEALT - 1)
        table = shared(bit_table(short.unionAll(frequent(DEALT, longest, short))))

        def runs(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            counted = count_words(
                it, 1, longest, table.value, longest, most_entries, burst, apart=DEALT - 1, totals=True
            )
            return packed(counted, DEALT, parts)

        counts = keep(merged(texts.mapInPandas(runs, PACKED_RUN), DEALT, least), "phrases")
    found = counts.where("phrase <> ''").select("lang", "phrase", F.size(F.split("phrase", " ")).alias("n_words"), "n")
    return found, counts.where("phrase = ''").select("lang", F.col("n").alias("total"))


def not_inside(candidates: DataFrame, percent: int = INSIDE_PERCENT) -> DataFrame:
    """Candidates that no longer one contains with ``percent`` of their occurrences."""
    places = F.transform(
        F.sequence(F.lit(2), F.col("n_words") - 1),
        lambda size: F.transform(
            F.sequence(F.lit(1), F.col("n_words") - size + 1), lambda first: F.struct(first.alias("first"), size.alias("size"))
        ),
    )
    parts = candidates.where("n_words > 2").select("lang", "phrase", "n", F.explode(F.flatten(places)).alias("at"))
    longer = parts.select(
        "lang", _part(F.col("at.first"), F.col("at.size")).alias("phrase"), F.col("n").alias("longer")
    )
    most = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    joined = candidates.join(most, ["lang", "phrase"], "left")
    kept = F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("n"))
    return joined.where(kept).drop("longer")


def collocations(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST,
    top: int = TOP,
    inside_percent: int = INSIDE_PERCENT,
    most_entries: int = MOST_ENTRIES,
    burst: int = BURST,
) -> DataFrame:
    """The ``top`` phrases of each language by the score of their weakest cut.

    ``docs`` has ``text`` and ``lang``; other columns are ignored. A phrase is 2 to
    ``longest`` (at least 3) words in a row, no mark of punctuation or line end between
    them, found at least ``least`` times; case counts for A-Z only. Cut in two parts
    found l and r times, it scores floor(1000 * a * n / (l * r)), a being its own and n
    the language's number of words, and counts by its lowest cut, of equal ones the
    first. Phrases inside a longer one that is found as often are left out. Gives lang,
    rank, phrase, a, l, r, n, score; ties by a, then phrase.

    A null language is ``und``; null and empty texts have no words; repeated rows count
    each time; an empty table, or one without frequent phrases, gives no rows.
    """
    found, totals = count_phrases(docs, longest, least, most_entries, burst)
    candidates = not_inside(found.where("n_words > 1"), inside_percent)
    cuts = candidates.select(
        "lang", "phrase", "n_words", F.col("n").alias("a"),
        F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k"),
    ).select(
        "lang", "phrase", "a", "k", _part(F.lit(1), F.col("k")).alias("left"),
        _part(F.col("k") + 1, F.col("n_words") - F.col("k")).alias("right"),
    )
    left = found.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    right = found.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    total = totals.select("lang", F.col("total").alias("n"))
    cuts = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(total, "lang")
    # Up to 38 digits: exact. The quotient is at most 1000 * n / least.
    wide = {c: F.col(c).cast("decimal(19,0)").alias(c) for c in ("a", "n", "l", "r")}
    cuts = cuts.select(
        "lang", "phrase", "a", "k", "l", "r", "n",
        F.struct(*wide.values()).alias("w"),
    ).withColumn("score", F.expr(f"({SCALE} * (w.a * w.n)) div (w.l * w.r)"))
    weakest = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("cut"))
    scored = weakest.select("lang", "phrase", "cut.a", "cut.l", "cut.r", "cut.n", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
