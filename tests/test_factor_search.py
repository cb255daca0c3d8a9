"""Pruned search against all scores."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rateweave.operators import factor_search as fs
from rateweave.operators import model as m
from rateweave.operators import recommend as r
from rateweave.sinks.models import save_ranked
from rateweave.streaming.recommendations import LookUpUnseen, SearchUnseen, UnseenHandler
from rateweave.streaming.shared import write_batch

FACTORS = "id int, features array<float>"


def factors(spark, n, rank, seed, skew=2.0, first=0):
    rng = np.random.default_rng(seed)
    values = rng.normal(0.3, 0.5, (n, rank)) * (1 + skew * rng.pareto(3, (n, 1)))
    rows = [(first + i, [float(np.float32(x)) for x in v]) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, FACTORS), {i: np.array(v, np.float64) for i, v in rows}


def plain(users, items, seen, n, digits):
    """Every score, in order of rounded score and item."""
    out = {}
    ids = np.array(list(items))
    wide = np.array([items[i] for i in ids])
    for user, vector in users.items():
        scores = fs.rounded(wide @ vector, digits)
        left = [(-s, i) for s, i in zip(scores.tolist(), ids.tolist()) if i not in seen.get(user, ())]
        out[user] = [(i, -s) for s, i in sorted(left)[:n]]
    return out


def listed(frame):
    return {x.user_id: [(i.item_id, i.predicted_rating) for i in x.recommendations] for x in frame.collect()}


@pytest.mark.parametrize("digits", [None, 2, 0])
@pytest.mark.parametrize("group_bytes", [1 << 26, 20_000])
def test_lists_are_those_of_all_scores(spark, digits, group_bytes):
    user_rows, users = factors(spark, 60, 7, 1)
    item_rows, items = factors(spark, 900, 7, 2, first=-100)
    seen = {0: set(items), 1: set(range(0, 700)), 2: {5, 10**6}, 3: set()}
    search = fs.FactorSearch(user_rows, item_rows, block_items=50, group_bytes=group_bytes)
    assert (search.shared is None) == (group_bytes < 1 << 20)
    asked = spark.createDataFrame(
        [(u, sorted(seen[u]) if u in seen else None) for u in [*users, 777]], "user_id int, seen array<int>"
    )
    found = search.lists(asked, 9, digits)
    assert listed(found) == plain(users, items, seen, 9, digits)
    search.release()


def test_fewer_blocks_are_read_than_there_are(spark):
    user_rows, users = factors(spark, 200, 10, 3)
    item_rows, items = factors(spark, 5000, 10, 4, skew=8.0)
    search = fs.FactorSearch(user_rows, item_rows, block_items=100)
    found = search.lists(spark.createDataFrame([(u,) for u in users], "user_id int"), 5, 2)
    assert listed(found) == plain(users, items, {}, 5, 2)
    read = found.agg(F.sum("blocks_read")).first()[0]
    assert search.n_blocks == 50 and read < 0.5 * 200 * 50


def test_one_user_with_everything_seen_changes_no_other_read(spark):
    user_rows, users = factors(spark, 40, 6, 5)
    item_rows, items = factors(spark, 100_000, 6, 6, skew=4.0)
    search = fs.FactorSearch(user_rows, item_rows)
    ids = [(u,) for u in users]
    alone = search.lists(spark.createDataFrame(ids, "user_id int"), 5, 2)
    some = spark.createDataFrame([(0, list(range(99_990)))] + [(u, None) for (u,) in ids[1:]], "user_id int, seen array<int>")
    beside = search.lists(some, 5, 2)
    others = F.col("user_id") != 0
    assert sorted(map(str, alone.where(others).collect())) == sorted(map(str, beside.where(others).collect()))
    assert listed(beside)[0] == plain({0: users[0]}, items, {0: set(range(99_990))}, 5, 2)[0]


def test_the_same_lists_as_the_library_has(spark):
    ratings = spark.range(900).select(
        (F.col("id") % 30).cast("int").alias("user_id"), (F.col("id") * 13 % 50).cast("int").alias("item_id"),
        (F.pmod(F.hash("id"), F.lit(10)) / 2 + 0.5).cast("float").alias("rating"),
    )
    model = m.fit_als(ratings, m.AlsConfig(rank=4, max_iter=4))
    search = fs.FactorSearch.of(model, block_items=8)
    everyone = model.userFactors.select(F.col("id").alias("user_id"))
    mine = {u: [i for i, _ in found] for u, found in listed(search.lists(everyone, 6)).items()}
    theirs = {x.user_id: [i.item_id for i in x.recommendations] for x in r.recommend_all(model, 6).collect()}
    assert mine == theirs


def test_unusable_factors_and_empty_tables(spark):
    nan = float("nan")
    item_rows = spark.createDataFrame(
        [(1, [1.0, 0.0]), (2, [nan, 1.0]), (3, None), (None, [1.0, 1.0]), (4, [None, 1.0]), (5, [-1.0, 2.0]), (6, [1.0, 0.0])],
        FACTORS,
    )
    user_rows = spark.createDataFrame([(1, [1.0, 1.0]), (2, [0.0, 0.0]), (3, [float("inf"), 0.0])], FACTORS)
    everyone = spark.createDataFrame([(1,), (2,), (3,)], "user_id int")
    search = fs.FactorSearch(user_rows, item_rows, block_items=1)
    assert listed(search.lists(everyone, 9)) == {1: [(1, 1.0), (5, 1.0), (6, 1.0)], 2: [(1, 0.0), (5, 0.0), (6, 0.0)]}
    assert search.top(everyone.limit(0), 3).collect() == []
    nothing = fs.FactorSearch(user_rows, item_rows.limit(0))
    assert listed(nothing.lists(everyone, 2)) == {1: [], 2: []}


def test_keys_order_by_score_then_item():
    scores = np.array([1.5, 0.0, -0.0, -1.5, 3e38, -3e38, 1e-40, 1.5], np.float32)
    items = np.array([7, 2**31 - 1, -(2**31), 0, 1, 2, 3, 8])
    keys = fs.rank_keys(scores, items)
    back, ids = fs.read_keys(keys)
    assert back.tolist() == scores.tolist() and ids.tolist() == items.tolist()
    want = sorted(range(8), key=lambda i: (-scores[i], items[i]))
    assert np.argsort(-keys, kind="stable").tolist() == want


def test_rounding_is_that_of_sql(spark):
    values = [4.125, -4.125, 4.115, 0.005, -0.005, 2.675, 1e-9, 123456.785, -3.14159, 2.5]
    frame = spark.createDataFrame([(v,) for v in values], "x float")
    want = [x[0] for x in frame.select(F.round("x", 2)).collect()]
    assert fs.rounded(np.array(values, np.float32), 2).tolist() == want


@pytest.fixture(scope="module")
def saved(spark, tmp_path_factory):
    """Factors, their search, and the 20 best of 50,000 users saved."""
    user_rows, users = factors(spark, 20_000, 3, 7)
    item_rows, items = factors(spark, 300, 3, 8)
    search = fs.FactorSearch(user_rows, item_rows)
    path = str(tmp_path_factory.mktemp("ranked"))
    everyone = user_rows.select(F.col("id").alias("user_id"))
    save_ranked(search.lists(everyone, 20, 2), path, 20, 2)
    return search, users, items, path


def pairs(spark, seen):
    rows = [(u, i) for u, own in seen.items() for i in own]
    return spark.createDataFrame(rows * 2, "user_id int, item_id int")


def test_a_lookup_gives_what_a_search_gives(spark, saved, tmp_path):
    search, users, items, path = saved
    best = [i for i, _ in plain({5: users[5]}, items, {}, 19, 2)[5]]
    seen = {5: best, 6: [1, 2], 7: list(items), 8: list(items)[:-3], 10**6: [1], 9: [10**6]}
    want = sorted(
        (u, i, s, rank)
        for u, found in plain({u: users[u] for u in seen if u in users}, items, seen, 5, 2).items()
        for rank, (i, s) in enumerate(found, 1)
    )
    for name, find in (("searched", SearchUnseen(search)), ("looked up", LookUpUnseen(spark, path, search))):
        handler = UnseenHandler(find, write_batch(str(tmp_path / name)))
        handler(pairs(spark, seen), 0)
        handler(pairs(spark, seen).limit(0), 1)
        got = spark.read.parquet(str(tmp_path / name)).drop("batch_id")
        assert sorted(tuple(r) for r in got.collect()) == want
    few = LookUpUnseen(spark, path, search, most_ids=2)
    assert sorted(tuple(r) for r in few(fs.with_seen(pairs(spark, seen))).collect()) == want


def test_a_lookup_without_a_search_refuses_what_it_cannot_know(spark, saved):
    _, users, items, path = saved
    find = LookUpUnseen(spark, path)
    assert find(fs.with_seen(pairs(spark, {5: range(10)}))).count() == 5
    with pytest.raises(ValueError, match="no search"):
        find(fs.with_seen(pairs(spark, {5: list(items)})))
    with pytest.raises(ValueError, match="saved"):
        LookUpUnseen(spark, path, top_n=21)


def rows_read(frame):
    """Rows that the scan below a frame gave out, after it has run."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_lookup_reads_rows_near_its_users_only(spark, saved):
    path = saved[3]
    find = LookUpUnseen(spark, path)
    assert rows_read(find.near([123])) <= 2_000
    assert rows_read(find.near([123, 19_999])) <= 4_000
    assert rows_read(find.near([10**6])) == 0 == rows_read(find.near([]))
    scattered = list(range(0, 20_000, 800))
    assert len(find.near(scattered).collect()) == len(scattered)
    # Many ids, in two places.
    many = [*range(300, 900, 2), *range(15_000, 15_300)]
    assert rows_read(find.near(many)) <= 4_000
    assert {r.user_id for r in find.near(many).collect()} >= set(many)
    assert rows_read(find.saved.select("user_id")) == 20_000


def test_items_far_from_zero_are_pruned(spark):
    """Factors of a model share a direction: lengths alone tell little of their scores."""
    rng = np.random.default_rng(9)
    spread = rng.normal(0, 0.2, (20_000, 8)) * np.array([3, 2, 1, 1, 1, 1, 0.1, 0.1])
    items = {i: np.float32(v).astype(float) for i, v in enumerate(spread + 2.0)}
    users = {u: np.float32(v).astype(float) for u, v in enumerate(rng.normal(0.5, 0.3, (50, 8)))}
    frames = [spark.createDataFrame([(i, v.tolist()) for i, v in x.items()], FACTORS) for x in (users, items)]
    search = fs.FactorSearch(*frames, block_items=100)
    found = search.lists(frames[0].select(F.col("id").alias("user_id")), 5)
    assert listed(found) == plain(users, items, {}, 5, None)
    assert found.agg(F.sum("blocks_read")).first()[0] < 0.3 * 50 * search.n_blocks
    # Single precision takes half of the room.
    sizes = search.table.agg(F.sum(F.octet_length("ids") + F.octet_length("factors"))).first()[0]
    assert sizes == 20_000 * (4 + 8 * 4)


def test_wide_factors_stay_exact(spark):
    schema = "id int, features array<double>"
    rows = [(i, [1.0 + i * 1e-12, 2.0]) for i in range(300)]
    frame = spark.createDataFrame(rows, schema)
    search = fs.FactorSearch(frame.limit(1), frame, block_items=10)
    assert search.kind == "<f8"
    assert listed(search.lists(frame.limit(1).select(F.col("id").alias("user_id")), 3, 0)) == {0: [(0, 5.0), (1, 5.0), (2, 5.0)]}


def pointing(rng, n, rank, directions):
    """Factors of equal length scattered around a few directions."""
    centres = rng.normal(0, 1, (directions, rank))
    near = centres[rng.integers(0, directions, n)] + rng.normal(0, 0.15, (n, rank))
    near /= np.linalg.norm(near, axis=1, keepdims=True)
    return {i: np.float32(v).astype(float) for i, v in enumerate(near)}


@pytest.mark.parametrize("group_bytes", [1 << 26, 300_000])
def test_items_of_other_directions_are_pruned(spark, group_bytes):
    """Lengths tell nothing here: by them alone nearly all blocks are read."""
    rng = np.random.default_rng(10)
    items, users = pointing(rng, 20_000, 8, 40), pointing(rng, 60, 8, 40)
    frames = [spark.createDataFrame([(i, v.tolist()) for i, v in x.items()], FACTORS) for x in (users, items)]
    search = fs.FactorSearch(*frames, block_items=100, group_bytes=group_bytes)
    seen = {0: set(range(0, 20_000, 3)), 1: {5}}
    asked = spark.createDataFrame([(u, sorted(seen.get(u, ()))) for u in users], "user_id int, seen array<int>")
    found = search.lists(asked, 5)
    assert listed(found) == plain(users, items, seen, 5, None)
    assert found.agg(F.sum("blocks_read")).first()[0] < 0.5 * 60 * search.n_blocks


def test_users_whose_search_is_over_go_through_no_further_group(spark, monkeypatch):
    user_rows, users = factors(spark, 100, 6, 11)
    item_rows, items = factors(spark, 4000, 6, 12, skew=0.5)
    search = fs.FactorSearch(user_rows, item_rows, block_items=50, group_bytes=6_000)
    paths, real = [], fs.new_scratch
    monkeypatch.setattr(fs, "new_scratch", lambda spark, label: paths.append(real(spark, label)) or paths[-1])
    found = search.lists(user_rows.select(F.col("id").alias("user_id")), 5, 2)
    went = [spark.read.parquet(path).count() for path in paths]
    assert listed(found) == plain(users, items, {}, 5, 2)
    assert went[0] == 100 and 0 < went[-1] < 100 and went == sorted(went, reverse=True)
