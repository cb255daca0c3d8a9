"""Hard negatives against plain inner products."""

import duckdb
import numpy as np
import pytest

from rateweave.llm import negatives
from rateweave.llm.queries import ORACLES


def plain(rows, every=50):
    """All of it with Python integers."""
    nan = float("nan")
    use = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or x in (float("inf"), -float("inf")) or x != x for x in v):
            continue
        own = (label + 1) % 10 if i % 7 == 0 else label
        use.append((i, own, [int(np.floor(256 * np.float64(np.float32(x)))) for x in v]))
    anchors = {}
    for i, label, v in sorted(use, key=lambda r: (r[0], r[1], r[2])):
        if i % every == 0:
            anchors.setdefault(i, (label, v))
    out = []
    for i, (label, v) in anchors.items():
        scored = sorted(
            (-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in use if j != i and len(w) == len(v)
        )
        for s, j, _ in [r for r in scored if r[2] == label][:5]:
            fits = [r for r in scored if r[2] != label and 50 * -s <= 100 * -r[0] <= 95 * -s][:3]
            out += [(i, j, n, r[1], -s, -r[0]) for n, r in enumerate(fits, 1)]
    return sorted(out)


def drawn(n, dim, seed, scale=0.2):
    rng = np.random.default_rng(seed)
    return [
        (int(i), rng.normal(0.02, scale, dim).astype(np.float32).tolist(), int(rng.integers(0, 10)))
        for i in rng.permutation(n)
    ]


def table(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return frame.selectExpr("*", "'mine' AS v", "1 AS dim", "2 AS rank", "3 AS place")


@pytest.mark.parametrize(("n", "dim", "scale", "block"), [(900, 64, 0.2, 8192), (400, 13, 30.0, 3), (300, 8, 5e4, 2)])
def test_negatives_equal_plain_products(spark, n, dim, scale, block):
    rows = drawn(n, dim, seed=dim, scale=scale)
    got = negatives.mine(table(spark, rows).repartition(3), anchor_block=block)
    assert sorted(tuple(r) for r in got.collect()) == plain(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    v = [0.5, 0.25, -0.125]
    rows = [
        (0, v, 1), (0, v, 1), (50, v, 3), (None, v, 1), (1, None, 1), (2, v, None), (3, [nan, 0.0, 0.0], 1),
        (4, [0.1, None, 0.0], 2), (5, [inf, 0.0, 0.0], 2), (6, [0.5], 2), (100, [0.5], 2), (8, [0.4], 2), (9, [0.3], 1),
        (10, [], 1), (150, [], 1), (11, [], 2), (-50, [-0.5, 0.25, 0.0], 2), (-49, [0.5, 0.1, 0.0], 2), (12, [3e38, 1.0, 1.0], 1),
    ]
    # Many copies of one row, and ties around every limit.
    rows += [(13, v, 2)] * 300 + [(13, [0.4, 0.2, -0.1], 4)] * 300 + [(i, [0.4, 0.2, -0.1], i % 5) for i in range(20, 45)]
    got = negatives.mine(table(spark, rows))
    assert sorted(tuple(r) for r in got.collect()) == plain([r for r in rows if r[0] != 12])
    assert negatives.mine(table(spark, rows[:0])).collect() == []


def test_the_sql_gives_the_same(spark, small_dir):
    rows = drawn(700, 16, seed=5) + drawn(30, 16, seed=5) + [(None, [1.0], 1), (70, None, 1), (71, [1.0], None)]
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[], label INTEGER)")
    con.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", [list(r) for r in rows])
    want = sorted(con.execute(ORACLES["op11_hard_negatives"]).fetchall())
    assert sorted(tuple(r) for r in negatives.mine(table(spark, rows)).collect()) == want


def test_lookups_are_products():
    rng = np.random.default_rng(1)
    for most in (1, 200, 2**14, 2**30):
        a, b = rng.integers(-most, most, (5, 24)), rng.integers(-most, most, (300, 24))
        assert (negatives.scores(negatives.subset_sums(a), negatives.bit_planes(b)) == a @ b.T).all()
    wide = np.full((1, 8), 2**29)
    assert negatives.scores(negatives.subset_sums(wide), negatives.bit_planes(-wide)).tolist() == [[-(2**61)]]


def test_the_best_of_equal_scores_have_the_least_ids():
    values, ids = np.array([1, 5, 5, 5, 5, 2, 5] * 9), np.arange(63)[::-1]
    want = sorted(range(63), key=lambda i: (-values[i], ids[i]))[:4]
    assert negatives.best(values, ids, 4).tolist() == want
