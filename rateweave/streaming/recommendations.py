"""Recommendations for the users of a micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateweave.operators.factor_search import FactorSearch, ranked_rows, with_seen
from rateweave.operators.recommend import (
    OVER_FETCH,
    TOP_N,
    exclude_seen,
    flatten_recommendations,
    recommend,
    rerank_top_n,
    search_of,
)
from rateweave.sinks.models import user_bucket
from rateweave.sources.models import (
    ranked_depth,
    read_ranked,
    read_recommendations,
    saved_depth,
)
from rateweave.streaming.shared import WriteBatch

DIGITS = 2

# (distinct users, candidates per user) -> user_id, recommendations
Candidates = Callable[[DataFrame, int], DataFrame]


class Scored:
    """Find the best of all items of a model for the users of each batch.

    The items are prepared for the search once, with the first batch. ``keep_factors``
    holds the two factor tables on the executors, in memory and on disk, instead of
    reading them again for every batch, until :meth:`release`.
    """

    def __init__(self, model: ALSModel, keep_factors: bool = True) -> None:
        self.model, self.search, self.kept = model, None, []
        if keep_factors:
            self.kept = [
                factors.persist(StorageLevel.MEMORY_AND_DISK)
                for factors in (model.userFactors, model.itemFactors)
            ]

    def __call__(self, users: DataFrame, n: int) -> DataFrame:
        self.search = self.search or search_of(self.model)
        return recommend(self.model, users, n, self.search)

    def release(self) -> None:
        if self.search is not None:
            self.search.release()
        for factors in self.kept:
            factors.unpersist()
        self.kept = []


class LookedUp:
    """Look the users up in recommendations saved once per model.

    Gives what :class:`Scored` gives, without scoring in every batch. Of the saved
    table only the buckets of the batch's users are read. Users who need more items
    than were saved are scored; without a model to score by that is an error.
    """

    def __init__(self, spark: SparkSession, path: str, model: ALSModel | None = None) -> None:
        self.depth, self.buckets = saved_depth(spark, path)
        # Files are listed once, not for every batch.
        self.saved, self.model = read_recommendations(spark, path), model
        self.scored = None if model is None else Scored(model, keep_factors=False)

    def __call__(self, users: DataFrame, n: int) -> DataFrame:
        if n > self.depth:
            if self.model is None:
                raise ValueError(
                    f"{n} candidates per user are needed, {self.depth} were saved and there is "
                    "no model to score by"
                )
            return self.scored(users, n)
        read = [row.bucket for row in users.select(user_bucket(self.buckets)).distinct().collect()]
        return (
            self.saved.where(F.col("bucket").isin(read))
            .join(users, "user_id", "left_semi")
            .select("user_id", F.slice("recommendations", 1, n).alias("recommendations"))
        )


def scored_by(model: ALSModel, keep_factors: bool = True) -> Scored:
    return Scored(model, keep_factors)


def looked_up_in(spark: SparkSession, path: str, model: ALSModel | None = None) -> LookedUp:
    return LookedUp(spark, path, model)


def recommend_unseen(
    seen: DataFrame,
    candidates: Candidates,
    top_n: int = TOP_N,
    over_fetch: int = OVER_FETCH,
) -> DataFrame:
    """Top n per user of ``seen`` (distinct pairs), without the pairs themselves.

    Every user gets n items as long as the model has n they have not seen:
    ``over_fetch * top_n`` candidates are taken per user, which is enough for all
    who have seen ``(over_fetch - 1) * top_n`` items at most; the others are
    fetched apart, as deep as the largest number that one of them has seen.
    Ratings are rounded before ranking. ``seen`` is read twice: keep it.
    """
    depth = top_n * over_fetch
    users = seen.groupBy("user_id").agg(F.count("*").alias("n_seen"))
    many = F.col("n_seen") > depth - top_n
    fetched = candidates(users.where(~many).select("user_id"), depth)
    deepest = users.where(many).agg(F.max("n_seen")).first()[0]
    if deepest is not None:
        heavy = candidates(users.where(many).select("user_id"), top_n + deepest)
        fetched = fetched.unionByName(heavy)
    flat = flatten_recommendations(fetched, DIGITS)
    return rerank_top_n(exclude_seen(flat, seen), top_n)


class RecommendationHandler:
    """Handler for :func:`rateweave.streaming.sinks.for_each_batch`.

    Only the batch's distinct (user, item) pairs are kept while it is worked on.
    """

    SCHEMA = "user_id int, item_id int, predicted_rating float, rank int"

    def __init__(
        self,
        candidates: Candidates,
        write: WriteBatch,
        top_n: int = TOP_N,
        over_fetch: int = OVER_FETCH,
    ) -> None:
        self.candidates, self.write = candidates, write
        self.top_n, self.over_fetch = top_n, over_fetch
        depth = getattr(candidates, "depth", top_n * over_fetch)
        if depth < top_n * over_fetch:
            raise ValueError(
                f"{depth} candidates per user were saved, {top_n * over_fetch} are needed"
            )

    def prepare(self, frame: DataFrame) -> None:
        """Create the table the recommendations go to."""
        prepare = getattr(self.write, "prepare", None)
        if prepare is not None:
            prepare(frame.sparkSession.createDataFrame([], self.SCHEMA))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        seen = batch.select("user_id", "item_id").distinct()
        seen = seen.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not seen.isEmpty():
                found = recommend_unseen(seen, self.candidates, self.top_n, self.over_fetch)
                self.write(found, batch_id)
        finally:
            seen.unpersist()


def recommendation_handler(
    candidates: Candidates,
    write: WriteBatch,
    top_n: int = TOP_N,
    over_fetch: int = OVER_FETCH,
) -> RecommendationHandler:
    return RecommendationHandler(candidates, write, top_n, over_fetch)


# ``user_id, seen`` of distinct users -> ``user_id, item_id, predicted_rating, rank``
Finder = Callable[[DataFrame], DataFrame]


class SearchUnseen:
    """The best items a user has not seen, searched in a model's factors.

    Equal to scoring all items, leaving out the seen ones and ranking the rest.
    """

    def __init__(self, search: FactorSearch, top_n: int = TOP_N, digits: int | None = DIGITS) -> None:
        self.search, self.top_n, self.digits = search, top_n, digits

    def __call__(self, users: DataFrame) -> DataFrame:
        return self.search.top(users, self.top_n, self.digits)


# Ids that a read asks Parquet for one by one; Spark nests a condition for each.
FEW_IDS = 128
# Ranges of ids that a read asks for otherwise.
ID_RANGES = 64


class LookUpUnseen:
    """What :class:`SearchUnseen` gives, looked up in lists saved once per model.

    Few users are asked for by their ids, up to ``most_ids`` users by ranges around
    them; the read then skips files, row groups and pages without them. More users read
    the table. Users who have seen so much that their saved list may not do are searched
    for; without a ``search`` they are an error.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        search: FactorSearch | None = None,
        top_n: int = TOP_N,
        most_ids: int = 100_000,
    ) -> None:
        self.depth, self.digits = ranked_depth(spark, path)
        if top_n > self.depth:
            raise ValueError(f"{top_n} items per user are asked for, {self.depth} were saved")
        # Files are listed once, not for every batch.
        self.saved, self.search = read_ranked(spark, path), search
        self.top_n, self.most_ids = top_n, most_ids
        # Beyond this many ids Spark asks Parquet for their range instead of for them.
        limit = "spark.sql.parquet.pushdown.inFilterThreshold"
        spark.conf.set(limit, str(max(FEW_IDS, int(spark.conf.get(limit)))))

    def near(self, ids: list[int]) -> DataFrame:
        """The saved lists of some users, and of others with ids between theirs."""
        if not ids:
            return self.saved.where(F.lit(False))
        if len(ids) <= FEW_IDS:
            return self.saved.where(f"user_id IN ({', '.join(str(int(i)) for i in ids)})")
        own = sorted(int(i) for i in ids)
        # Cut where the widest gaps are.
        gaps = sorted(range(1, len(own)), key=lambda i: own[i - 1] - own[i])[: ID_RANGES - 1]
        cuts = [0, *sorted(gaps), len(own)]
        ranges = [
            f"user_id BETWEEN {own[a]} AND {own[b - 1]}" for a, b in zip(cuts, cuts[1:])
        ]
        return self.saved.where(" OR ".join(ranges))

    def __call__(self, users: DataFrame) -> DataFrame:
        sizes = users.select("user_id", F.size("seen").alias("n_seen"))
        asked = sizes.limit(self.most_ids + 1).collect()
        if len(asked) <= self.most_ids:
            saved = self.near([row.user_id for row in asked])
            most_seen = max((row.n_seen for row in asked), default=0)
        else:
            saved, most_seen = self.saved, sizes.agg(F.max("n_seen")).first()[0]
        unseen = F.filter(
            "recommendations", lambda item: ~F.array_contains("seen", item["item_id"])
        )
        joined = saved.join(users, "user_id").select(
            "user_id", "seen", F.size("recommendations").alias("n_saved"), unseen.alias("unseen")
        )
        # A list shorter than was asked for holds all items there are.
        enough = (F.size("unseen") >= self.top_n) | (F.col("n_saved") < self.depth)
        best = joined.where(enough).select(
            "user_id", F.slice("unseen", 1, self.top_n).alias("recommendations")
        )
        found = ranked_rows(best)
        if most_seen <= self.depth - self.top_n:
            return found
        short = joined.where(~enough).select("user_id", "seen")
        if self.search is None:
            if not short.isEmpty():
                raise ValueError("users have seen more than was saved, and there is no search")
            return found
        return found.unionByName(self.search.top(short, self.top_n, self.digits))


class UnseenHandler:
    """Handler for :func:`rateweave.streaming.sinks.for_each_batch`.

    Only the batch's users, each with the distinct items of the batch, are kept while
    it is worked on.
    """

    def __init__(self, find: Finder, write: WriteBatch) -> None:
        self.find, self.write = find, write

    def prepare(self, frame: DataFrame) -> None:
        """Create the table the recommendations go to."""
        prepare = getattr(self.write, "prepare", None)
        if prepare is not None:
            prepare(frame.sparkSession.createDataFrame([], RecommendationHandler.SCHEMA))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        users = with_seen(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not users.isEmpty():
                self.write(self.find(users), batch_id)
        finally:
            users.unpersist()
