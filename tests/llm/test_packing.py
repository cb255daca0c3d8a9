import bisect
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from rateweave.llm import packing


def plain_best_fit(lengths, limit):
    """Bins of best-fit decreasing, one piece at a time."""
    left, bins = [], 0
    for x in sorted(lengths, reverse=True):
        i = bisect.bisect_left(left, x)
        if i == len(left):
            bins, room = bins + 1, limit
        else:
            room = left.pop(i)
        bisect.insort(left, room - x)
        while left and left[0] == 0:
            left.pop(0)
    return bins


def test_runs_equal_packing_one_by_one():
    random.seed(5)
    for _ in range(200):
        limit = random.choice([7, 16, 100, 2048])
        most = random.choice([limit, max(1, limit // 3)])
        lengths = [random.randint(1, most) for _ in range(random.randint(0, 300))]
        counts = Counter(lengths)
        runs, used = packing.best_fit_decreasing(dict(counts), limit)
        assert used == plain_best_fit(lengths, limit)
        runs.sort()
        filled = defaultdict(list)
        for i, run in enumerate(runs):
            more = i + 1 < len(runs) and runs[i + 1].length == run.length
            end = runs[i + 1].rank if more else counts[run.length]
            for k in range(end - run.rank):
                filled[run.bin + k].append((run.offset, run.length))
        assert sum(map(len, filled.values())) == len(lengths)
        for parts in filled.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= limit


def test_only_the_first_piece_is_short():
    assert packing.cut(1, 4) == [(0, 1)]
    assert packing.cut(4, 4) == [(0, 4)]
    assert packing.cut(9, 4) == [(0, 1), (1, 4), (5, 4)]


def test_ids_are_the_tokenizers(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").toPandas()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids_of = packing.TokenIds(
        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    )
    odd = ["", " ", "<|endoftext|> x", "a b\u0085c", "中文 \U0001f600", "x" * 5000, "\x1c a\x0b"]
    for text in [*docs.text, *odd]:
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert ids_of(text).tolist() == want


def test_pieces_of_all_documents(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    got = packing.pack(docs).toPandas()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = dict(docs.select("doc_id", "text").collect())
    lengths = []
    for doc_id, own in got.groupby("doc_id"):
        ids = np.array([*tokenizer.encode(texts[doc_id], add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for row in own.sort_values("piece").itertuples():
            assert row.start == at
            assert row.ids_crc32 == zlib.crc32(ids[at : at + row.length].tobytes())
            assert row.length == 2048 or row.piece == 0
            at += row.length
            lengths.append(row.length)
        assert at == len(ids)
    assert set(got.doc_id) == set(texts)
    for _, own in got.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own.offset.tolist() == [0, *own.length.cumsum().tolist()[:-1]]
        assert own.length.sum() <= 2048
    assert got.sequence_id.nunique() == plain_best_fit(lengths, 2048)
