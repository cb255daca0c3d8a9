"""Per-user recommendations: score, flatten, leave out seen items, rank."""

from __future__ import annotations

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rateweave.operators.factor_search import FactorSearch

TOP_N = 5
OVER_FETCH = 4


def sample_users(ratings: DataFrame, n: int = 5) -> DataFrame:
    """The n lowest user ids: a reproducible sample for a report."""
    return ratings.select("user_id").distinct().orderBy("user_id").limit(n)


def search_of(model: ALSModel) -> FactorSearch:
    """The search for :func:`recommend`: of equal scores MLlib puts the larger item first."""
    return FactorSearch(model.userFactors, model.itemFactors.withColumn("id", F.bitwise_not("id")))


def _candidates(lists: DataFrame) -> DataFrame:
    """``user_id, recommendations`` of such a search, with the items' own ids."""
    items = F.transform(
        "recommendations",
        lambda x: F.struct(F.bitwise_not(x["item_id"]).alias("item_id"), x["predicted_rating"].alias("rating")),
    )
    return lists.select("user_id", items.alias("recommendations"))


def recommend(
    model: ALSModel, users: DataFrame, n: int = TOP_N, search: FactorSearch | None = None
) -> DataFrame:
    """``user_id, recommendations``: the n best items per user of the model.

    Searched in the model's factors: MLlib's own product scores all pairs, and shuffles
    n items per user for every block of items. A user the model does not know has no row.
    Give the model's :func:`search_of` where it is asked more than once. Use a saved and reloaded model
    (:func:`rateweave.sources.models`): its factors have a known size and few partitions,
    a fresh fit's have not.
    """
    search = search or search_of(model)
    return _candidates(search.lists(users.select("user_id").distinct(), n))


def recommend_all(model: ALSModel, n: int = TOP_N) -> DataFrame:
    """:func:`recommend` for every user of the model."""
    return _candidates(search_of(model).lists(model.userFactors.select(F.col("id").alias("user_id")), n))


def flatten_recommendations(recommendations: DataFrame, digits: int = 3) -> DataFrame:
    """One row ``user_id, item_id, predicted_rating`` per recommended item."""
    listed = recommendations.select("user_id", F.inline("recommendations"))
    rating = F.round("rating", digits).alias("predicted_rating")
    return listed.select("user_id", "item_id", rating)


def exclude_seen(candidates: DataFrame, seen: DataFrame) -> DataFrame:
    """Drop candidates whose (user, item) pair is in ``seen``.

    Pairs are made distinct first; that needs the partitioning the join needs
    anyway, and a pair repeated very often is one row per map task.
    """
    pairs = seen.select("user_id", "item_id").distinct()
    return candidates.join(pairs, ["user_id", "item_id"], "left_anti")


def rerank_top_n(candidates: DataFrame, n: int = TOP_N) -> DataFrame:
    """The n best candidates per user, with their ``rank``; equal ratings by item id.

    Spark limits each user to n rows before the shuffle as well, so a user with
    very many candidates does not fill one task.
    """
    best_first = Window.partitionBy("user_id").orderBy(
        F.col("predicted_rating").desc(), "item_id"
    )
    return (
        candidates.withColumn("rank", F.row_number().over(best_first))
        .filter(F.col("rank") <= n)
    )


def order_recommendations(recommendations: DataFrame) -> DataFrame:
    """Best first within each user, for display; a global sort, so not for big tables."""
    return recommendations.orderBy("user_id", F.col("predicted_rating").desc(), "item_id")
