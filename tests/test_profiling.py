import pytest
from pyspark.sql import functions as F

from rateweave import catalog
from rateweave.operators import profiling as p
from rateweave.schemas import RATING

from .conftest import plan_of, rows

# A published rating histogram and the figures published with it.
STARS = {1: 56174, 2: 107557, 3: 261197, 4: 348971, 5: 226310}
USERS, ITEMS = 6040, 3706


@pytest.fixture(scope="module")
def published(spark):
    counts = list(STARS.values())
    reached = [F.when(F.col("id") >= sum(counts[:i]), star) for i, star in enumerate(STARS)]
    star = F.greatest(*reached)
    return spark.range(sum(STARS.values())).select(
        (F.col("id") % USERS).cast("int").alias("user_id"),
        (F.col("id") % ITEMS).cast("int").alias("item_id"),
        star.cast("float").alias("rating"),
        F.col("id").alias("timestamp"),
    )


def test_distribution_in_rating_order(published):
    found = [tuple(r) for r in p.rating_distribution(published).collect()]
    assert found == [(float(star), n) for star, n in STARS.items()]


def test_summary(published):
    found = p.rating_summary(published).first()
    assert found.n == 1_000_209
    assert found.mean == pytest.approx(3.5816, abs=5e-5)
    assert found.stddev == pytest.approx(1.1171, abs=5e-5)
    assert (found.min_rating, found.max_rating) == (1.0, 5.0)


def test_cardinality_and_sparsity(published):
    found = p.dataset_cardinality(published).first()
    assert (found.n_ratings, found.n_users, found.n_items) == (1_000_209, USERS, ITEMS)
    assert found.sparsity == pytest.approx(0.955316, abs=5e-7)


def test_empty_table(spark):
    empty = spark.createDataFrame([], RATING)
    assert rows(p.dataset_cardinality(empty)) == [(0, 0, 0, None)]
    assert rows(p.rating_summary(empty)) == [(0, None, None, None, None)]
    assert rows(p.rating_distribution(empty)) == []


def test_profiles_read_only_their_columns(spark, published, tmp_path):
    path = str(tmp_path / "ratings")
    published.limit(1000).write.parquet(path)
    stored = spark.read.parquet(path)
    assert "ReadSchema: struct<rating:float>" in plan_of(p.rating_summary(stored))
    assert "ReadSchema: struct<rating:float>" in plan_of(p.rating_distribution(stored))
    assert "ReadSchema: struct<user_id:int,item_id:int>" in plan_of(p.dataset_cardinality(stored))


def test_distinct_counts_shuffle_their_own_columns_alone(spark):
    frame = spark.createDataFrame([(1, 1, 2.0), (1, 2, 2.0), (1, 1, 3.0), (2, None, 1.0), (None, 2, 1.0)], "a int, b int, c double")
    counts = p.distinct_counts(frame, a=("a",), b=("b",), both=("a", "b"))
    assert [tuple(x) for x in counts.collect()] == [(2, 2, 2)]
    one = frame.agg(F.count_distinct("a"), F.count_distinct("b"), F.count_distinct("a", "b")).first()
    assert tuple(one) == (2, 2, 2)
    # One aggregation of several distinct counts makes three rows of each.
    assert "Expand" not in counts._jdf.queryExecution().executedPlan().toString()
    assert [tuple(x) for x in p.distinct_counts(frame.limit(0), a=("a",)).collect()] == [(0,)]


def test_parts_are_profiled_from_lines_joined_once(spark, small_dir, monkeypatch):
    seen, real = [], catalog.part_profile
    monkeypatch.setattr(catalog, "part_profile", lambda part, name: seen.append(plan_of(part)) or real(part, name))
    catalog.QUERIES["profile_from_parts"](spark, small_dir).collect()
    assert len(seen) == 3 and not any("Join" in plan for plan in seen)
