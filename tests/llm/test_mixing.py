import random
from collections import defaultdict

import pytest

from rateweave.llm import mixing


def test_targets_stop_at_three_times_the_source():
    sizes = [10, 1000, 1000]
    targets = mixing.target_sizes(sizes, [1, 2, 3])
    assert targets[0] == 30
    assert targets[1] == pytest.approx(1980 * 2 / 5) and sum(targets) == pytest.approx(2010)
    assert mixing.target_sizes([], []) == [] and mixing.target_sizes([0, 5], [1, 2]) == [0, 5]


def test_pairs_keep_the_words():
    random.seed(1)
    sizes = sorted((random.randint(1, 500) for _ in range(400)), reverse=True)
    chances = [0.37] * 400
    want = sum(s * c for s, c in zip(sizes, chances))
    extra, held = mixing.pair_up(sizes, chances, [random.random() for _ in sizes])
    have = sum(s * (chances[i] if i == held else e) for i, (s, e) in enumerate(zip(sizes, extra)))
    assert have == pytest.approx(want)
    assert all(e in (0, 1) for e in extra)


def test_chances_are_kept():
    random.seed(6)
    hits = [0] * 6
    for _ in range(4000):
        chances = [0.3] * 6
        extra, held = mixing.pair_up([5, 4, 3, 2, 2, 1], chances, [random.random() for _ in range(6)])
        if held >= 0:
            extra[held] = int(random.random() < chances[held])
        hits = [h + e for h, e in zip(hits, extra)]
    assert all(0.26 < h / 4000 < 0.34 for h in hits)


def test_mix_of_documents(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    first = sorted(map(tuple, mixing.mix(docs, leaf_rows=8).collect()))
    again = sorted(map(tuple, mixing.mix(docs.repartition(7), leaf_rows=8).collect()))
    assert first == again
    texts = {r.doc_id: r for r in docs.collect()}
    taken, target, own, largest = defaultdict(int), {}, defaultdict(int), defaultdict(int)
    for row in mixing.mix(docs, leaf_rows=8).collect():
        doc = texts[row.doc_id]
        assert row["size"] == len(doc.text.encode().split())
        assert row.taken <= 3 * row["size"] and row.taken == row.copies * row["size"]
        taken[doc.source] += row.taken
        own[doc.source] += row["size"]
        largest[doc.source] = max(largest[doc.source], row["size"])
        target[doc.source] = row.target
    names = sorted(own)
    want = mixing.target_sizes([own[n] for n in names], [1 + i % 3 for i in range(len(names))])
    assert [target[n] for n in names] == pytest.approx(want)
    for n in names:
        assert abs(taken[n] - target[n]) <= largest[n]


def test_mixed_rows_are_the_copies(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    copies = {r.doc_id: r.copies for r in mixing.mix(docs).collect() if r.copies}
    got = {r.doc_id: r["count"] for r in mixing.mixed(docs).groupBy("doc_id").count().collect()}
    assert got == copies
