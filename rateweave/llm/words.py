"""Words of many texts at once, as NumPy arrays.

A word is a run of bytes other than space and ``\\x09-\\x0D``. Texts are joined
with a line break, so no word spans two of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WORD = r"[^\x20\x09-\x0D]+"
SLICE = 1 << 22
# Bytes hashed at a time: what :func:`word_hashes` works on stays near the processor.
HASHED = 1 << 16


def mix64(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that every bit depends on every other."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_STEP = 0xD1342543DE82EF95
_BACK = pow(_STEP, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


_STEPS, _BACKS = _powers(_STEP, 2 * HASHED), _powers(_BACK, 2 * HASHED)


def joined(texts: list[str | None], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, a line break after each, and where each text begins."""
    coded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    starts = np.cumsum([0] + [len(c) + 1 for c in coded])[:-1]
    data = b"\n".join(coded) + b"\n"
    return np.frombuffer(data.lower() if lower else data, np.uint8), starts


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every word."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = (data != 32) & ((data < 9) | (data > 13))
    turn = np.diff(inside)
    return np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each word: polynomial over random byte values, then mixed."""
    out = np.empty(len(begin), np.uint64)
    at = 0
    while at < len(begin):
        to = max(at + 1, int(np.searchsorted(end, begin[at] + HASHED, "right")))
        low, high = int(begin[at]), int(end[to - 1])
        n = high - low
        power, back = (_STEPS, _BACKS) if n <= len(_STEPS) else (_powers(_STEP, n), _powers(_BACK, n))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data[low:high]] * power[:n], out=sums[1:])
        first, last = begin[at:to] - low, end[at:to] - low
        value = (sums[last] - sums[first]) * back[first]
        out[at:to] = mix64(value + (last - first).astype(np.uint64))
        at = to
    return out


def owner(positions: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Index of the text that each position lies in."""
    return np.searchsorted(starts, positions, "right") - 1


def batches(texts: list[str | None], most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of texts of some ``most`` characters, at least one text each."""
    at, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text or "") > most:
            yield at, i
            at, size = i, 0
        size += len(text or "") + 1
    if at < len(texts):
        yield at, len(texts)
