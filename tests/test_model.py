import json
import math
import threading
import time

import pytest
from pyspark.sql import functions as F

from rateweave.functions.sampling import drawn_below, unit_hash
from rateweave.operators import model as m
from rateweave.plans.train_model import sample_recommendations, train_model
from rateweave.schemas import RATING
from rateweave.sinks.models import save_model
from rateweave.sinks.tables import write_metrics, write_ratings
from rateweave.sources.models import load_model
from rateweave.sources.ratings import read_ratings

from .conftest import plan_of, rows

QUICK = m.AlsConfig(rank=3, max_iter=3)


@pytest.fixture(scope="module")
def ratings(spark, tmp_path_factory):
    """60 users x 40 items, half of the cells filled, with structure to learn."""
    user, item = F.col("id") % 60, (F.col("id") / 60).cast("int")
    frame = (
        spark.range(60 * 40)
        .filter((F.col("id") * 7919 % 11) < 6)
        .select(
            user.cast("int").alias("user_id"),
            item.cast("int").alias("item_id"),
            (1 + (user % 3) + (item % 3)).cast("float").alias("rating"),
            F.col("id").alias("timestamp"),
        )
    )
    path = str(tmp_path_factory.mktemp("ratings") / "table")
    write_ratings(frame, path)
    return read_ratings(spark, path)


def test_split_is_complete_disjoint_and_stable(ratings):
    train, test = m.train_test_split(ratings)
    assert rows(train.unionAll(test)) == rows(ratings)
    assert train.join(test, ["user_id", "item_id"]).count() == 0
    assert 0.74 < train.count() / ratings.count() < 0.86
    again, _ = m.train_test_split(ratings.repartition(13))
    assert rows(again) == rows(train)


def test_split_depends_on_seed_and_fraction(ratings):
    assert rows(m.train_test_split(ratings, seed=1)[0]) != rows(m.train_test_split(ratings)[0])
    assert m.train_test_split(ratings, 1.0)[1].count() == 0
    assert m.train_test_split(ratings, 0.0)[0].count() == 0


def test_als_settings():
    als = m.build_als(num_blocks=12)
    assert (als.getRank(), als.getMaxIter(), als.getRegParam(), als.getSeed()) == (10, 10, 0.1, 42)
    assert als.getColdStartStrategy() == "drop"
    assert not als.getImplicitPrefs()
    assert (als.getNumUserBlocks(), als.getNumItemBlocks()) == (12, 12)


def test_rmse_by_hand(spark):
    frame = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 2.0)], "rating float, prediction float")
    assert rows(m.rmse(frame)) == [(3, pytest.approx(math.sqrt(10 / 3)))]
    assert rows(m.rmse(frame.limit(0))) == [(0, None)]


def test_train_eval_learns_and_reports_the_error_of_its_predictions(ratings):
    train, test = m.train_test_split(ratings)
    trial = m.train_eval(train, test)
    predicted = [(r.rating, r.prediction) for r in m.predict(trial.model, test).collect()]
    by_hand = math.sqrt(sum((a - b) ** 2 for a, b in predicted) / len(predicted))
    assert trial.rmse == pytest.approx(by_hand, rel=1e-9)
    assert trial.rmse < 0.5
    assert trial.seconds > 0


def test_unseen_users_and_items_are_dropped(spark, ratings):
    model = m.fit_als(ratings, QUICK)
    unseen = spark.createDataFrame([(10**6, 1, 3.0, 0), (1, 10**6, 3.0, 0)], RATING)
    assert m.predict(model, unseen).count() == 0
    with pytest.raises(ValueError, match="RMSE is undefined"):
        m.train_eval(ratings, unseen, QUICK)


def test_ids_beyond_int_fail(spark):
    big = spark.createDataFrame([(2**40, 1, 3.0)], "user_id bigint, item_id int, rating float")
    with pytest.raises(Exception, match="CAST_OVERFLOW|integer|Integer"):
        m.fit_als(big, QUICK).userFactors.count()


def test_no_tuning_when_the_first_model_passes(ratings):
    best, trials = m.tune_if_needed(*m.train_test_split(ratings), threshold=10.0, first=QUICK)
    assert [best] == trials


def test_tuning_keeps_a_strictly_better_model(ratings):
    sides = m.train_test_split(ratings)
    worse = m.AlsConfig(rank=2, reg_param=5.0, max_iter=2)
    best, trials = m.tune_if_needed(*sides, [worse, QUICK, QUICK], 0.0, first=worse)
    assert len(trials) == 4
    assert best is trials[2]
    assert not sides[0].is_cached


GRID = [m.AlsConfig(2, 5.0, 2), QUICK, m.AlsConfig(4, 0.1, 3), QUICK, m.AlsConfig(2, 1.0, 2)]


def test_trials_at_once_are_those_one_by_one(spark, ratings):
    sides = m.train_test_split(ratings)
    alone, one_by_one = m.tune_if_needed(*sides, GRID, 0.0, first=GRID[0])
    best, trials = m.tune_if_needed(*sides, GRID, 0.0, first=GRID[0], at_once=3)
    assert [t.config for t in trials] == [t.config for t in one_by_one] == GRID[:1] + GRID
    assert [t.rmse for t in trials] == pytest.approx([t.rmse for t in one_by_one], rel=1e-6)
    assert trials.index(best) == one_by_one.index(alone)
    assert [t.model is not None for t in trials] == [t is best for t in trials]
    assert not sides[0].is_cached
    table = m.trial_table(spark, best, trials).orderBy("place").collect()
    assert [r.place for r in table] == list(range(6))
    assert [r.is_best for r in table] == [t is best for t in trials]
    assert {r.predicted_rows for r in table} == {m.predict(best.model, sides[1]).count()}
    assert all(r.seconds > 0 for r in table)


def test_trials_overlap_in_pools_of_their_own(spark, ratings, monkeypatch):
    running, pools, real = threading.Barrier(3, timeout=60), [], m.train_eval

    def watched(train, test, config, num_blocks=None):
        if config.rank > 2:
            pools.append(spark.sparkContext.getLocalProperty(m.POOL))
            running.wait()  # ends only if three trials run at a time
        return real(train, test, config, num_blocks)

    monkeypatch.setattr(m, "train_eval", watched)
    grid = [m.AlsConfig(3, r, 2) for r in (0.1, 0.2, 0.3)]
    m.tune_if_needed(*m.train_test_split(ratings), grid, 0.0, first=m.AlsConfig(2, 1.0, 2), at_once=3)
    assert sorted(pools) == ["trial-0", "trial-1", "trial-2"]
    assert spark.sparkContext.getLocalProperty(m.POOL) is None


def test_a_failed_trial_ends_the_tuning(ratings, monkeypatch):
    begun, real = [], m.train_eval

    def failing(train, test, config, num_blocks=None):
        begun.append(config)
        if config.reg_param == 9.0:
            raise ValueError("no such trial")
        return real(train, test, config, num_blocks)

    monkeypatch.setattr(m, "train_eval", failing)
    sides = m.train_test_split(ratings)
    grid = [m.AlsConfig(2, 9.0, 1)] + [m.AlsConfig(2, 0.1 * n, 1) for n in range(1, 9)]
    with pytest.raises(ValueError, match="no such trial"):
        m.tune_if_needed(*sides, grid, 0.0, first=m.AlsConfig(2, 1.0, 1), at_once=2)
    assert len(begun) < 8 and not sides[0].is_cached


def test_grid():
    assert [(c.rank, c.reg_param, c.max_iter) for c in m.TUNING_GRID] == [
        (20, 0.05, 15),
        (15, 0.01, 20),
        (10, 0.30, 20),
        (25, 0.05, 10),
    ]


def test_saved_model_predicts_the_same(ratings, tmp_path):
    model = m.fit_als(ratings, QUICK)
    path = str(tmp_path / "model")
    save_model(model, path)
    save_model(model, path)
    assert rows(m.predict(load_model(path), ratings)) == rows(m.predict(model, ratings))


def test_metrics_are_written_to_four_digits(spark, tmp_path):
    path = str(tmp_path / "metrics")
    write_metrics(spark, path, rmse=0.869449)
    assert json.loads(spark.read.text(path).first().value) == {"rmse": 0.8694}


def test_training_job(spark, ratings, tmp_path):
    source, model, metrics = (str(tmp_path / n) for n in ("ratings", "model", "metrics"))
    write_ratings(ratings, source, num_files=3)
    assert len(list((tmp_path / "ratings").glob("*.parquet"))) == 3
    best, trials = train_model(spark, source, model, metrics)
    assert len(trials) == 1
    assert spark.read.json(metrics).first().rmse == round(best.rmse, 4)
    sample = sample_recommendations(spark, source, model, users=2, n=3)
    assert sample.columns == ["user_id", "item_id", "predicted_rating"]
    assert [r.user_id for r in sample.collect()] == [0, 0, 0, 1, 1, 1]


def test_blocks_follow_the_rows_not_the_cores(ratings, monkeypatch):
    gb = 1 << 30
    assert [m.blocks_for(size, 96) for size in (1, gb, 6 * gb, 10**15)] == [4, 4, 12, 96]
    assert m.blocks_for(1, 2) == 2
    # A factor is sent to every block each iteration: more cores must not mean more blocks.
    used, real = [], m.build_als
    monkeypatch.setattr(m, "build_als", lambda config, blocks: used.append(blocks) or real(config, blocks))
    m.fit_als(ratings.select("user_id", "item_id", "rating"), QUICK)
    cores = ratings.sparkSession.sparkContext.defaultParallelism
    assert used == [min(4, cores)]


def test_tuning_deletes_the_shuffles_of_losing_models(ratings):
    kept = ratings.sparkSession.sparkContext._jsc.getPersistentRDDs
    m.drop_unused(ratings.sparkSession)
    before, (train, test) = set(kept()), m.train_test_split(ratings)
    model = m.fit_als(train, QUICK)
    one = len(set(kept()) - before)
    grid = [m.AlsConfig(rank=2, max_iter=2, reg_param=r) for r in (5.0, 6.0, 7.0, 8.0)]
    best, _ = m.tune_if_needed(train, test, grid, 0.0, QUICK, keep_split=False)
    for _ in range(50):
        if len(set(kept()) - before) <= 3 * one:
            break
        time.sleep(0.2)
    # Those of the model above, of the best one, and at most of the one that ran last.
    assert model and best.config == QUICK and 2 * one <= len(set(kept()) - before) <= 3 * one


def test_a_side_is_told_by_the_digits_as_by_the_number(ratings):
    keys = ("user_id", "item_id")
    for seed, fraction in ((42, 0.8), (1, 0.5), (7, 1e-9), (7, 1 - 1e-12), (7, -1.0), (7, 2.0)):
        below = F.count_if(drawn_below(keys, seed, fraction) != (unit_hash(keys, seed) < fraction))
        assert ratings.agg(below).first()[0] == 0
    # No number is made of each row's digits.
    assert not any("conv(" in plan_of(side) for side in m.train_test_split(ratings))


def test_trials_share_the_cores_one_leaves_idle():
    # Cores for three trials of four blocks; none to share; a given number stays.
    assert m.sharing(4, 2, 12, None) == (3, 4, "MEMORY_AND_DISK")
    assert m.sharing(4, 2, 7, None) == (1, 4, "MEMORY_AND_DISK")
    assert m.sharing(12, 3, 12, None) == (1, 12, "MEMORY_AND_DISK")
    assert m.sharing(4, 2, 12, 2) == (2, 4, "MEMORY_AND_DISK")
    # Blocks of trials at once are bounded by rows, however many cores there are.
    assert m.sharing(4, 8, 12, 3) == (3, 8, "DISK_ONLY")
    assert m.sharing(4, 90, 12, 3) == (3, 90, "DISK_ONLY")
    assert m.sharing(4, 8, 12, None) == (1, 4, "MEMORY_AND_DISK")


def test_idle_cores_take_further_trials(ratings, monkeypatch):
    running, real = threading.Barrier(2, timeout=60), m.train_eval

    def watched(train, test, config, num_blocks=None):
        if config.rank > 2:
            running.wait()  # ends only if two trials run at a time
        return real(train, test, config, num_blocks)

    monkeypatch.setattr(m, "train_eval", watched)
    monkeypatch.setattr(m, "blocks_for", lambda size, cores: cores // 2)
    grid = [m.AlsConfig(3, r, 2) for r in (0.1, 0.2, 0.3, 0.4)]
    m.tune_if_needed(*m.train_test_split(ratings), grid, 0.0, first=m.AlsConfig(2, 1.0, 2), keep_split=False)


def test_blocks_of_models_at_once_are_bounded_by_rows(ratings, monkeypatch):
    used, real = [], m.build_als

    def watched(config, blocks):
        als = real(config, blocks)
        used.append((config.rank, blocks, als.getIntermediateStorageLevel()))
        return als

    monkeypatch.setattr(m, "build_als", watched)
    monkeypatch.setattr(m, "BLOCK_ROWS", 100)
    train, test = m.train_test_split(ratings)
    blocks = -(-train.count() // 100)
    grid = [m.AlsConfig(3, r, 2) for r in (0.1, 0.2)]
    best, trials = m.tune_if_needed(train, test, grid, 0.0, first=m.AlsConfig(2, 1.0, 2), at_once=2)
    assert blocks > 4 and sorted(used) == [(2, blocks, "MEMORY_AND_DISK")] + 2 * [(3, blocks, "DISK_ONLY")]
    assert [t.config for t in trials[1:]] == grid and {t.predicted_rows for t in trials} == {test.count()}
