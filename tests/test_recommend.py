from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from rateweave.operators import model as m
from rateweave.operators import recommend as r
from rateweave.schemas import RECOMMENDATIONS
from rateweave.sinks.models import save_model, save_recommendations, user_bucket
from rateweave.sources.models import load_model
from rateweave.streaming.recommendations import (
    looked_up_in,
    recommend_unseen,
    recommendation_handler,
    scored_by,
)
from rateweave.streaming.shared import write_batch

from .conftest import plan_of, rows

CANDIDATE = "user_id int, item_id int, predicted_rating double"


@pytest.fixture(scope="module")
def model(spark, tmp_path_factory):
    frame = spark.range(900).select(
        (F.col("id") % 30).cast("int").alias("user_id"),
        (F.col("id") * 13 % 50).cast("int").alias("item_id"),
        (F.col("id") * 31 % 10 / 2 + 0.5).cast("float").alias("rating"),
        F.col("id").alias("timestamp"),
    )
    path = str(tmp_path_factory.mktemp("model") / "als")
    save_model(m.fit_als(frame, m.AlsConfig(rank=4, max_iter=4)), path)
    return load_model(path)


@pytest.fixture(scope="module")
def scores(model):
    """Every user's items by plain dot product, best first."""
    users = {u.id: u.features for u in model.userFactors.collect()}
    items = {i.id: i.features for i in model.itemFactors.collect()}
    return {
        user: sorted(
            ((sum(a * b for a, b in zip(uf, vf)), item) for item, vf in items.items()),
            reverse=True,
        )
        for user, uf in users.items()
    }


def users_frame(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "user_id int")


def test_recommend_against_dot_products(spark, model, scores):
    found = r.recommend(model, users_frame(spark, [3, 3, 7, 10**6]), 6)
    flat = r.flatten_recommendations(found, 3)
    by_user = defaultdict(list)
    for row in flat.collect():
        by_user[row.user_id].append((row.item_id, row.predicted_rating))
    # Repeated users count once; an unknown user has no rows.
    assert sorted(by_user) == [3, 7]
    for user, listed in by_user.items():
        expected = scores[user][:6]
        assert [i for i, _ in listed] == [i for _, i in expected]
        for (_, got), (score, _) in zip(listed, expected):
            assert got == pytest.approx(score, abs=6e-4)


def test_recommend_all_has_every_user(model, scores):
    assert {u.user_id for u in r.recommend_all(model, 2).collect()} == set(scores)


def test_flatten(spark):
    frame = spark.createDataFrame([(1, [(5, 3.14159), (6, 2.0)]), (2, [])], RECOMMENDATIONS)
    assert [(x.user_id, x.item_id, round(x.predicted_rating, 4)) for x in
            r.flatten_recommendations(frame, 2).collect()] == [(1, 5, 3.14), (1, 6, 2.0)]


def test_sample_users_is_reproducible(spark):
    frame = users_frame(spark, [9, 4, 4, 7, 2, 9])
    assert [u.user_id for u in r.sample_users(frame, 3).collect()] == [2, 4, 7]


def test_exclude_seen(spark):
    candidates = spark.createDataFrame([(1, 1, 5.0), (1, 2, 4.0), (2, 1, 3.0)], CANDIDATE)
    seen = spark.createDataFrame([(1, 1), (1, 1), (2, 9)], "user_id int, item_id int")
    kept = r.exclude_seen(candidates, seen)
    assert rows(kept.select("user_id", "item_id")) == [(1, 2), (2, 1)]


def test_rerank_breaks_ties_by_item(spark):
    frame = spark.createDataFrame([(1, i, 4.0) for i in (8, 2, 5)] + [(1, 9, 4.5)], CANDIDATE)
    assert rows(r.rerank_top_n(frame, 3)) == [(1, 2, 4.0, 2), (1, 5, 4.0, 3), (1, 9, 4.5, 1)]


def test_rerank_limits_users_before_the_shuffle(spark):
    crowded = spark.range(30000).select(
        F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id")).cast("int").alias("user_id"),
        F.col("id").cast("int").alias("item_id"),
        (F.col("id") % 100 / 10.0).alias("predicted_rating"),
    )
    top = r.rerank_top_n(crowded)
    assert [x.item_id for x in top.filter("user_id = 1").orderBy("item_id").collect()] == [
        199, 299, 499, 599, 799,
    ]
    plan = plan_of(top)
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_display_order(spark):
    frame = spark.createDataFrame([(2, 1, 1.0), (1, 7, 2.0), (1, 3, 2.0), (1, 1, 9.0)], CANDIDATE)
    assert [tuple(x)[:2] for x in r.order_recommendations(frame).collect()] == [
        (1, 1), (1, 3), (1, 7), (2, 1),
    ]


def seen_pairs(spark, pairs):
    return spark.createDataFrame(pairs, "user_id int, item_id int")


def test_unseen_by_score_and_by_lookup(spark, model, scores, tmp_path):
    path = str(tmp_path / "candidates")
    save_recommendations(r.recommend_all(model, 30), path, 30, buckets=4)
    rated = [(3, scores[3][0][1]), (3, scores[3][2][1]), (7, scores[7][1][1]), (10**6, 1)]
    seen = seen_pairs(spark, rated)
    scored = rows(recommend_unseen(seen, scored_by(model)))
    assert rows(recommend_unseen(seen, looked_up_in(spark, path))) == scored
    assert {x[0] for x in scored} == {3, 7}
    assert not {x[:2] for x in scored} & set(rated)
    for user in (3, 7):
        left = [(round(s, 2), i) for s, i in scores[user] if (user, i) not in rated]
        listed = [x for x in scored if x[0] == user]
        assert len(listed) == 5
        assert sorted(round(x[2], 2) for x in listed) == pytest.approx(
            sorted(s for s, _ in left[:5]), abs=0.011
        )


def test_users_who_rated_much_get_all_the_same(spark, model, scores, tmp_path):
    """As many as are asked for, whenever the model has as many unseen items."""
    n_items = len(scores[3])
    rated = [(3, item) for _, item in scores[3][:18]]
    rated += [(7, item) for _, item in scores[7][: n_items - 2]]
    rated += [(9, item) for item in range(100, 3100)] + [(11, scores[11][0][1])]
    rated += [(13, item) for _, item in scores[13]]
    seen = seen_pairs(spark, rated).persist()
    path = str(tmp_path / "candidates")
    save_recommendations(r.recommend_all(model, 20), path, 20, buckets=4)
    deep = scored_by(model)
    scored = rows(recommend_unseen(seen, deep))
    assert rows(recommend_unseen(seen, looked_up_in(spark, path, model))) == scored
    deep.release()
    for user, n in ((3, 5), (7, 2), (9, 5), (11, 5), (13, 0)):
        own = [x for x in scored if x[0] == user]
        assert len(own) == n
        assert sorted(x[3] for x in own) == list(range(1, n + 1))
        best = [s for s, i in scores[user] if (user, i) not in set(rated)][:n]
        assert sorted((x[2] for x in own), reverse=True) == pytest.approx(best, abs=0.011)


def test_a_lookup_too_shallow_is_an_error(spark, model, scores, tmp_path):
    path = str(tmp_path / "candidates")
    save_recommendations(r.recommend_all(model, 3), path, 3)
    with pytest.raises(ValueError, match="3 candidates per user were saved, 20 are needed"):
        recommendation_handler(looked_up_in(spark, path), write_batch(str(tmp_path / "out")))
    deep = str(tmp_path / "deep")
    save_recommendations(r.recommend_all(model, 20), deep, 20)
    seen = seen_pairs(spark, [(3, item) for _, item in scores[3][:18]]).persist()
    with pytest.raises(ValueError, match="no model to score by"):
        recommend_unseen(seen, looked_up_in(spark, deep))


def test_a_lookup_reads_the_buckets_of_its_users(spark, model, tmp_path):
    path = str(tmp_path / "candidates")
    save_recommendations(r.recommend_all(model, 20), path, 20, buckets=8)
    found = looked_up_in(spark, path)(users_frame(spark, [3]), 20)
    plan = plan_of(found)
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
    read = {f for f in found.inputFiles() if "bucket=" in f}
    bucket = users_frame(spark, [3]).select(user_bucket(8)).first().bucket
    assert found.first().user_id == 3 and any(f"bucket={bucket}/" in f for f in read)


def test_lists_are_those_of_the_library_and_not_all_pairs_are_scored(spark, model):
    """Against MLlib's product of all pairs; the search takes part of the blocks of items."""
    def listed(frame):
        return {x.user_id: [i.item_id for i in x.recommendations] for x in frame.collect()}

    assert listed(r.recommend_all(model, 7)) == listed(model.recommendForAllUsers(7))
    plan = r.recommend_all(model, 7)._jdf.queryExecution().executedPlan().toString()
    # MLlib's plan joins all blocks of users with all of items.
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
