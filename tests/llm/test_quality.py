import math
from collections import Counter

import numpy as np
import pytest

from rateweave.llm import quality


def features(text):
    words = text.encode().split()
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return (
        len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text),
        sum(x in lines[:i] for i, x in enumerate(lines)), len(covered),
    )


def test_rule_features_of_all_documents(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text")
    odd = ["a a a a", "é é x\x0by\n\n x y\n x y", "###\r\n###\n", "a b c a b c\x1ca b c", "\U0001f600 " * 60]
    more = spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    labels = spark.read.parquet(f"{small_dir}/labels.parquet")
    every = docs.unionByName(more)
    texts = {i: t for i, t in every.collect() if len(t) < 20_000}
    for row in quality.judge(every, labels.where("quality = 1")).collect():
        if row.doc_id not in texts:
            continue
        n_words, chars, symbols, lines, repeated = features(texts[row.doc_id])
        assert (row.n_words, row.word_chars, row.n_symbols) == (n_words, chars, symbols)
        assert (row.n_dup_lines, row.n_repeat_words) == (lines, repeated)
        assert row.base_failed == (n_words < 50 or 100 * repeated > 50 * n_words)
        assert row.kept == (not row.base_failed and row.llr >= quality.THRESHOLD)


def test_junk_goes_and_good_documents_stay(spark, small_dir):
    sf = small_dir.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.judge(docs, labels.where("quality = 1")).join(labels, "doc_id").where("NOT base_failed")
    assert got.where("quality = 1 AND NOT kept").count() == 0
    assert got.where("quality = 0 AND kept").count() <= 0.05 * got.where("quality = 0").count()


def test_ratio_is_of_all_grams(spark):
    docs = spark.createDataFrame([(1, "aaaa aaaa"), (2, "bbbb bbbb")], "doc_id long, text string")
    raw = quality.gram_counts(docs)
    assert raw.sum() == 2 * (len("aaaa aaaa") + 1 - 3)


def test_every_trusted_document_counts(spark):
    docs = spark.range(20_200).selectExpr("id AS doc_id", "concat('text ', hex(xxhash64(id))) AS text")
    # All are trusted, so both multinomials are the same.
    assert quality.judge(docs, docs).where("llr <> 0").count() == 0
    small = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(small)
    spark.conf.set(small, "-1")
    try:
        assert quality.judge(docs, docs.unionAll(docs)).where("llr <> 0").count() == 0
    finally:
        spark.conf.set(small, before)


def plain_ratios(texts, trusted):
    """The ratio of each text, by counting one n-gram at a time."""

    def buckets(text):
        data = (text or "").encode() + b"\n"
        for i in range(len(data) - 3):
            yield int.from_bytes(data[i : i + 4], "little") * 2654435761 % 2**32 >> 16

    raw, good = Counter(), Counter()
    for text, is_trusted in zip(texts, trusted):
        raw.update(buckets(text))
        if is_trusted:
            good.update(buckets(text))
    sums = [c.total() + 2**16 for c in (good, raw)]
    out = []
    for text in texts:
        own = [math.log((good[b] + 1) / sums[0]) - math.log((raw[b] + 1) / sums[1]) for b in buckets(text)]
        out.append(sum(own) / max(len(own), 1))
    return out


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_ratios_equal_brute_force(spark, small_dir, threshold):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text")
    odd = [(None, "null ids are never trusted"), (7, "a second text of the id"), (10**7, None), (10**7 + 1, "é")]
    rows = sorted((r.doc_id, r.text) for r in docs.collect() if len(r.text) < 3000)[:120] + odd
    chosen = [(r[0],) for r in rows if r[0] is not None and r[0] % 3 == 1] + [(None,), (10**7,), (10**8,), (7,), (7,)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = quality.judge(frame, spark.createDataFrame(chosen, "doc_id long")).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    ids = {i for (i,) in chosen if i is not None}
    want = plain_ratios([t for _, t in rows], [i in ids for i, _ in rows])
    key = lambda pair: (pair[0] is not None, pair[0] or 0, pair[1])
    mine = sorted(((r.doc_id, r.llr) for r in got), key=key)
    theirs = sorted(((r[0], w) for r, w in zip(rows, want)), key=key)
    assert [i for i, _ in mine] == [i for i, _ in theirs]
    assert [x for _, x in mine] == pytest.approx([x for _, x in theirs])


def test_no_gram_spans_two_texts(spark):
    texts = ["some words", "", "x", None, "other words", "ab", "é"]
    sizes = [max(0, len((t or "").encode()) + 1 - 3) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    weight = np.random.default_rng(1).random(1 << quality.BUCKET_BITS)
    alone = [quality._ratios([t], weight, quality.BUCKET_BITS)[0] for t in texts]
    assert list(quality._ratios(texts, weight, quality.BUCKET_BITS)) == pytest.approx(alone)
    for n in (1, 3):
        assert quality.gram_counts(docs.repartition(n)).sum() == sum(sizes)
