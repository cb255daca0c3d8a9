import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from rateweave.llm import simhash
from rateweave.llm.components import components


def plain_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [words] if len(words) < 3 else [words[i : i + 3] for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(b" ".join(s), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    top = list(range(len(prints)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    values = np.array(prints, np.uint64)
    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[i] ^ values[i + 1 :]) <= 3) + i + 1:
            a, b = root(i), root(int(j))
            top[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(values))]


def test_prints_and_components_of_all_documents(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    rows = sorted(docs.select("doc_id", "text").collect())
    got = simhash.near_duplicates(docs).withColumn("print", simhash.fingerprint_text()).collect()
    got = {r.doc_id: r for r in got}
    prints = [plain_print(r.text) for r in rows]
    assert [got[r.doc_id]["print"] for r in rows] == [f"{p:016x}" for p in prints]
    named = [rows[i].doc_id for i in plain_components(prints)]
    assert [got[r.doc_id].component_id for r in rows] == named
    kept = simhash.one_of_each(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(named))


def test_links_of_dense_prints(spark, monkeypatch):
    """Long lists are split, and split lists probed, without losing a component."""
    random.seed(9)
    base = random.getrandbits(64)
    prints = {base ^ random.getrandbits(20) for _ in range(900)}
    turned = lambda: 1 << random.randrange(64)
    prints |= {base ^ turned() ^ turned() ^ turned() for _ in range(300)}
    prints |= {random.getrandbits(64) for _ in range(300)}
    signed = [p - (1 << 64) if p >> 63 else p for p in sorted(prints)]
    want = {}
    for value, root in zip(signed, plain_components(sorted(prints)), strict=True):
        want.setdefault(root, set()).add(value)
    fps = spark.createDataFrame([(s,) for s in signed], "fp long")
    for long_list, pair_list in ((1024, 8192), (50, 8192), (50, 20)):
        monkeypatch.setattr(simhash, "LONG_LIST", long_list)
        values = list(signed)
        monkeypatch.setattr(simhash, "PAIR_LIST", pair_list)
        got = {}
        for node, root in components(simhash.links(fps)).collect():
            got.setdefault(root, {root}).add(node)
        assert sorted(map(sorted, got.values())) == sorted(sorted(s) for s in want.values() if len(s) > 1)
        assert len(values) == len(signed)


def test_probes_equal_pairs(monkeypatch):
    random.seed(2)
    base = random.getrandbits(64)
    values = sorted({base ^ random.getrandbits(22) for _ in range(1500)})
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    pairs = simhash.forest(signed)
    monkeypatch.setattr(simhash, "PAIR_LIST", 10)
    assert sorted(simhash.forest(signed)) == sorted(pairs)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(1000, 1001 + i) for i in range(200)] + [(7, 7), (-5, -9)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {tuple(r) for r in components(frame).collect()}
    assert got == {(i, 0) for i in range(1, 41)} | {(1001 + i, 1000) for i in range(200)} | {(-5, -9)}
    assert components(frame.where(F.lit(False))).collect() == []
