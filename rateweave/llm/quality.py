"""Quality rules: plain text rules, and how much a text resembles trusted ones.

Byte n-grams are hashed into buckets. Two multinomials over the buckets, of the
trusted documents and of the whole corpus, give each text a log-likelihood ratio
per n-gram; a text whose ratio is below a fixed threshold is not kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateweave.llm import words
from rateweave.llm.tables import id_text, shuffles_sized_for

BUCKET_BITS = 16
GRAM = 4
THRESHOLD = -0.7
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of the words

_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[list(b"#*$%&|<>")] = 1

RESULT = (
    "doc_id string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, llr double, kept boolean"
)


def gram_buckets(data: np.ndarray, bits: int = BUCKET_BITS, gram: int = GRAM) -> np.ndarray:
    """Bucket of the ``gram`` bytes from each position on (``gram`` is at most 4)."""
    size = max(0, len(data) - gram + 1)
    key = np.zeros(size, np.uint32)
    for i in range(gram):
        key |= data[i : i + size].astype(np.uint32) << np.uint32(8 * i)
    return (key * np.uint32(2654435761)) >> np.uint32(32 - bits)


def own_grams(texts: list[str | None], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of every gram that lies in one text and the line break after it."""
    data, starts = words.joined(texts, lower=False)
    buckets = gram_buckets(data, bits)
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(starts, append=len(data)))
    inside = doc[: len(buckets)] == doc[len(data) - len(buckets) :]
    return buckets[inside], doc[: len(buckets)][inside]


def _count(batches: Iterator[pd.DataFrame], bits: int) -> Iterator[pd.DataFrame]:
    total = np.zeros(1 << bits, np.int64)
    for batch in batches:
        texts = batch.text.tolist()
        for a, b in words.batches(texts):
            total += np.bincount(own_grams(texts[a:b], bits)[0], minlength=1 << bits)
    (some,) = total.nonzero()
    yield pd.DataFrame({"bucket": some, "n": total[some]})


def gram_counts(texts: DataFrame, bits: int = BUCKET_BITS) -> np.ndarray:
    """Counts of all buckets over all rows; one row per bucket reaches the driver."""
    parts = texts.select("text").mapInPandas(lambda it: _count(it, bits), "bucket int, n long")
    out = np.zeros(1 << bits)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def trusted_counts(docs: DataFrame, trusted: DataFrame, bits: int = BUCKET_BITS) -> np.ndarray:
    """Counts of all buckets over all rows of ``docs`` whose id is in ``trusted``.

    One pass, in which texts and ids are shuffled, at any number of ids: the way
    does not change with their number.
    """
    ids = trusted.select(F.col("doc_id").cast("long").alias("doc_id")).dropna().distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with shuffles_sized_for(docs):
        return gram_counts(texts.dropna().join(ids.hint("merge"), "doc_id", "left_semi"), bits)


def log_ratio(trusted: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Log of trusted over raw probability per bucket, both with one added."""
    size = len(raw)
    return np.log((trusted + 1) / (trusted.sum() + size)) - np.log((raw + 1) / (raw.sum() + size))


def _repeated(hashes: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Words per document that lie in a 3-word window found twice or more there."""
    if len(hashes) < 3:
        return np.zeros(n_docs, np.int64)
    a, b, c = hashes[:-2], hashes[1:-1], hashes[2:]
    window = words.mix64(words.mix64(words.mix64(a) + b) + c)
    window = words.mix64(window + doc[:-2].astype(np.uint64))
    inside = doc[:-2] == doc[2:]
    _, place, times = np.unique(window[inside], return_inverse=True, return_counts=True)
    again = np.flatnonzero(inside)[times[place] > 1]
    covered = np.zeros(len(hashes), bool)
    for shift in range(3):
        covered[again + shift] = True
    return np.bincount(doc[covered], minlength=n_docs)


def rule_features(texts: list[str | None]) -> dict[str, np.ndarray]:
    """Counts behind the plain rules, for all texts."""
    data, starts = words.joined(texts, lower=False)
    begin, end = words.word_bounds(data)
    doc = words.owner(begin, starts)
    inside = (data != 32) & ((data < 9) | (data > 13))
    sums = lambda values: np.add.reduceat(values.astype(np.int64), starts)
    repeated_lines = []
    for text in texts:
        lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        repeated_lines.append(len(lines) - len(set(lines)))
    return {
        "n_words": np.bincount(doc, minlength=len(texts)),
        "word_chars": sums(inside & ((data & 0xC0) != 0x80)),
        "n_symbols": sums(_SYMBOL[data]),
        "n_dup_lines": np.array(repeated_lines, np.int64),
        "n_repeat_words": _repeated(words.word_hashes(data, begin, end), doc, len(texts)),
    }


def _ratios(texts: list[str | None], weight: np.ndarray, bits: int) -> np.ndarray:
    buckets, doc = own_grams(texts, bits)
    n = np.bincount(doc, minlength=len(texts))
    return np.bincount(doc, weights=weight[buckets], minlength=len(texts)) / np.maximum(n, 1)


def _judge(batches: Iterator[pd.DataFrame], weight, bits: int, threshold: float):
    for batch in batches:
        texts = batch.text.tolist()
        for a, b in words.batches(texts):
            out = pd.DataFrame(rule_features(texts[a:b]))
            out.insert(0, "doc_id", batch.doc_id.to_numpy()[a:b])
            out["llr"] = _ratios(texts[a:b], weight, bits)
            out["base_failed"] = (out.n_words < LEAST_WORDS) | (
                100 * out.n_repeat_words > MOST_REPEATED * out.n_words
            )
            out["kept"] = ~out.base_failed & (out.llr >= threshold)
            yield out[[f.split()[0] for f in RESULT.split(", ")]]


def judge(
    docs: DataFrame,
    trusted: DataFrame,
    threshold: float = THRESHOLD,
    bits: int = BUCKET_BITS,
) -> DataFrame:
    """Rule counts, log-likelihood ratio and verdict of each document.

    ``docs`` has ``doc_id`` and ``text``, ``trusted`` the ``doc_id`` of trusted
    documents; other columns are ignored. The raw counts are of all documents, the
    target's of all trusted ones. One row per input row; a null or empty
    text has no words and fails; null ids are never trusted; without any trusted
    document every ratio only tells the smoothing apart from the corpus; an empty
    table gives no rows. Words and windows are compared by 64-bit hashes, windows
    only within a document, and so are n-grams: a text's ratio does not depend on
    its neighbours. A long text is taken whole.
    """
    docs = docs.select(id_text("doc_id"), "text")
    raw = gram_counts(docs, bits)
    good = trusted_counts(docs, trusted, bits)
    weight = docs.sparkSession.sparkContext.broadcast(log_ratio(good, raw))
    judged = docs.mapInPandas(lambda it: _judge(it, weight.value, bits, threshold), RESULT)
    return judged.withColumn("doc_id", F.col("doc_id").cast("long"))
