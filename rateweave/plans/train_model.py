"""Batch job: clean ratings to a saved model and its recommendations."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateweave.operators.factor_search import FactorSearch
from rateweave.operators.model import (
    RMSE_GATE,
    TUNING_GRID,
    AlsConfig,
    Trial,
    train_test_split,
    tune_if_needed,
)
from rateweave.operators.recommend import (
    OVER_FETCH,
    TOP_N,
    flatten_recommendations,
    order_recommendations,
    recommend,
    recommend_all,
    sample_users,
)
from rateweave.session import sized_for
from rateweave.sinks.models import BUCKETS, save_model, save_ranked, save_recommendations
from rateweave.sinks.tables import write_metrics
from rateweave.sources.models import load_model
from rateweave.sources.ratings import read_ratings


def train_model(
    spark: SparkSession,
    ratings_path: str,
    model_path: str,
    metrics_path: str,
    grid: Iterable[AlsConfig] = TUNING_GRID,
    threshold: float = RMSE_GATE,
    num_blocks: int | None = None,
    at_once: int = 1,
) -> tuple[Trial, list[Trial]]:
    """Split, train, tune if the first model misses the gate, save the best."""
    ratings = read_ratings(spark, ratings_path)
    train, test = train_test_split(ratings)
    with sized_for(ratings):
        best, trials = tune_if_needed(
            train, test, grid, threshold, num_blocks=num_blocks, keep_split=False, at_once=at_once
        )
    save_model(best.model, model_path)
    write_metrics(spark, metrics_path, rmse=best.rmse)
    return best, trials


def sample_recommendations(
    spark: SparkSession, ratings_path: str, model_path: str, users: int = 5, n: int = TOP_N
) -> DataFrame:
    """Top n for a few training users, in display order."""
    train, _ = train_test_split(read_ratings(spark, ratings_path))
    found = recommend(load_model(model_path), sample_users(train, users), n)
    return order_recommendations(flatten_recommendations(found))


def precompute_recommendations(
    model_path: str,
    out_path: str,
    top_n: int = TOP_N,
    over_fetch: int = OVER_FETCH,
    buckets: int = BUCKETS,
) -> None:
    """Candidates of every user, once per model, for streams to look up.

    Works on the saved model: its factors are read from Parquet, so their size
    is known to the planner and no training lineage hangs on the job.
    """
    model, depth = load_model(model_path), top_n * over_fetch
    with sized_for(model.userFactors, model.itemFactors):
        save_recommendations(recommend_all(model, depth), out_path, depth, buckets)


def precompute_ranked(
    model_path: str, out_path: str, depth: int = TOP_N * OVER_FETCH, digits: int | None = 2
) -> None:
    """Ranked lists of every user, once per model, for point lookups."""
    model = load_model(model_path)
    search = FactorSearch.of(model)
    everyone = model.userFactors.select(F.col("id").alias("user_id"))
    with sized_for(model.userFactors, model.itemFactors):
        save_ranked(search.lists(everyone, depth, digits), out_path, depth, digits)
    search.release()
