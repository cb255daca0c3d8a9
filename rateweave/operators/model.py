"""Train, evaluate and tune the factor model (MLlib ALS)."""

from __future__ import annotations

import gc
import math
import time
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor, as_completed
from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateweave.functions.sampling import drawn_below, unit_hash
from rateweave.session import MB, ensure_checkpoint_dir, scan_bytes

SEED = 42
RMSE_GATE = 1.5
POOL = "spark.scheduler.pool"
# A block of users or items has so many bytes of the stored training rows, and there are
# so many blocks at least: with every iteration each factor goes to all blocks that need it.
BLOCK_BYTES = 512 * MB
LEAST_BLOCKS = 4
# Rows of a block at most where models are fitted at once, however little room they take
# where they are stored: the task that builds a block holds some 50 bytes for each of its
# rows on the heap, which Spark does not count, and models at once fill all cores with such tasks.
BLOCK_ROWS = 16_000_000
# Iterations between checkpoints; what was shuffled before one is deleted there.
CHECKPOINT_EVERY = 5


@dataclass(frozen=True)
class AlsConfig:
    rank: int = 10
    reg_param: float = 0.1
    max_iter: int = 10
    # Where the blocks of ratings stay during the fit; no part of what the model is.
    blocks_on: str = field(default="MEMORY_AND_DISK", compare=False, repr=False)


# The configurations tried when the first model misses the gate.
TUNING_GRID = (
    AlsConfig(rank=20, reg_param=0.05, max_iter=15),
    AlsConfig(rank=15, reg_param=0.01, max_iter=20),
    AlsConfig(rank=10, reg_param=0.30, max_iter=20),
    AlsConfig(rank=25, reg_param=0.05, max_iter=10),
)


@dataclass(frozen=True)
class Trial:
    """A fitted model with its error on the test rows; only the best keeps its model."""

    config: AlsConfig
    model: ALSModel | None
    rmse: float
    seconds: float
    predicted_rows: int = 0


def train_test_split(
    ratings: DataFrame,
    train_fraction: float = 0.8,
    seed: int = SEED,
    keys: Sequence[str] = ("user_id", "item_id"),
) -> tuple[DataFrame, DataFrame]:
    """Split rows at random, each on its own, by a hash of the keys.

    Which side a row is on does not depend on partitioning, so the two frames
    stay disjoint and complete however often, and on whatever executors, they
    are computed; a seeded per-partition sampler needs a sort of every partition
    and still changes with the partitioning. Both sides are plain filters.
    """
    in_train = drawn_below(keys, seed, train_fraction)
    return ratings.filter(in_train), ratings.filter(~in_train)


def split_counts(
    ratings: DataFrame, train_fraction: float = 0.8, seed: int = SEED
) -> DataFrame:
    """One row ``total_rows, train_rows, test_rows`` of the split, in one pass."""
    in_train = unit_hash(("user_id", "item_id"), seed) < train_fraction
    return ratings.agg(
        F.count("*").alias("total_rows"),
        F.count_if(in_train).alias("train_rows"),
        F.count_if(~in_train).alias("test_rows"),
    )


def build_als(config: AlsConfig = AlsConfig(), num_blocks: int | None = None) -> ALS:
    """Explicit-feedback ALS; users or items unseen in training get no prediction."""
    als = ALS(
        rank=config.rank,
        maxIter=config.max_iter,
        regParam=config.reg_param,
        userCol="user_id",
        itemCol="item_id",
        ratingCol="rating",
        coldStartStrategy="drop",
        implicitPrefs=False,
        seed=SEED,
        checkpointInterval=CHECKPOINT_EVERY,
        intermediateStorageLevel=config.blocks_on,
    )
    return als.setNumBlocks(num_blocks) if num_blocks else als


def blocks_for(size: int, cores: int) -> int:
    """Blocks for training rows of ``size`` stored bytes: by the rows, up to one per core.

    An iteration shuffles each factor once per block that has a rating of it. One block
    per core, whatever the rows, would shuffle several times what they need.
    """
    return max(1, min(cores, max(LEAST_BLOCKS, -(-size // BLOCK_BYTES))))


def blocks_of(train: DataFrame) -> int:
    """:func:`blocks_for` the columns ALS needs."""
    rows = train.select("user_id", "item_id", "rating")
    return blocks_for(scan_bytes(rows), train.sparkSession.sparkContext.defaultParallelism)


def sharing(blocks: int, by_rows: int, cores: int, at_once: int | None) -> tuple[int, int, str]:
    """Trials at a time, blocks of each, and where the blocks stay.

    Unless given, as many trials as have a core for each of their blocks: one alone
    leaves the others idle. Trials at a time have ``by_rows`` blocks at least; where that
    is more, the rows of several models would also crowd the executors' memory and stay on disk.
    """
    at_once = at_once or max(1, cores // max(blocks, by_rows))
    if at_once == 1 or by_rows <= blocks:
        return at_once, blocks, "MEMORY_AND_DISK"
    return at_once, by_rows, "DISK_ONLY"


def fit_als(
    train: DataFrame, config: AlsConfig = AlsConfig(), num_blocks: int | None = None
) -> ALSModel:
    """Fit on the three columns ALS needs, in :func:`blocks_of` blocks unless given.

    Some iterations are checkpointed to the shared folder, so that a lost executor does
    not replay all of them, and that the shuffles before can be deleted.
    """
    session = train.sparkSession
    ensure_checkpoint_dir(session)
    rows = train.select("user_id", "item_id", "rating")
    return build_als(config, num_blocks or blocks_of(train)).fit(rows)


def drop_unused(spark: SparkSession) -> None:
    """Have Spark delete the shuffles and kept factors of models nobody refers to.

    It does so once the driver's collector finds them, which otherwise runs when memory
    is short, however full the disks are.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def predict(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """Add ``prediction``; pairs with an unknown user or item are dropped."""
    return model.transform(pairs)


def rmse(predictions: DataFrame) -> DataFrame:
    """One row ``n, rmse`` (``rmse`` null when there is no prediction)."""
    error = F.col("prediction").cast("double") - F.col("rating").cast("double")
    return predictions.agg(
        F.count(error).alias("n"), F.sqrt(F.avg(error * error)).alias("rmse")
    )


def train_eval(
    train: DataFrame,
    test: DataFrame,
    config: AlsConfig = AlsConfig(),
    num_blocks: int | None = None,
) -> Trial:
    """Fit on ``train`` and measure the error on ``test``."""
    started = time.monotonic()
    model = fit_als(train, config, num_blocks)
    measured = rmse(predict(model, test)).first()
    if not measured["n"]:
        raise ValueError(
            "no test row has both its user and its item in the training rows: RMSE is undefined"
        )
    if math.isnan(measured["rmse"]):
        raise ValueError("the model predicts NaN")
    return Trial(config, model, measured["rmse"], time.monotonic() - started, measured["n"])


def _trials(
    sides: tuple[DataFrame, DataFrame], configs: Sequence[AlsConfig], num_blocks: int | None, at_once: int
) -> Iterable[tuple[int, Trial]]:
    """Place and result of each configuration's trial, as they end."""
    context = sides[0].sparkSession.sparkContext

    def run(place: int) -> Trial:
        # A local property belongs to the thread, and a thread runs several trials.
        context.setLocalProperty(POOL, f"trial-{place}")
        return train_eval(*sides, configs[place], num_blocks)

    if at_once <= 1:
        for place, config in enumerate(configs):
            yield place, train_eval(*sides, config, num_blocks)
        return
    with ThreadPoolExecutor(at_once) as threads:
        places = {threads.submit(run, place): place for place in range(len(configs))}
        try:
            for future in as_completed(list(places)):
                # Forgotten here, so that a losing model is not held by its future.
                yield places.pop(future), future.result()
                del future
        except BaseException:
            threads.shutdown(wait=False, cancel_futures=True)
            raise


def trial_table(spark: SparkSession, best: Trial, trials: Sequence[Trial]) -> DataFrame:
    """One row per trial: ``place`` (from 0), its settings, error, rows, time, and whether it is the best."""
    rows = [
        (
            place, t.config.rank, t.config.reg_param, t.config.max_iter, t.rmse, t.predicted_rows, t.seconds,
            t is best,
        )
        for place, t in enumerate(trials)
    ]
    return spark.createDataFrame(
        rows,
        "place int, rank int, reg_param double, max_iter int, rmse double, predicted_rows long, "
        "seconds double, is_best boolean",
    )


def tune_if_needed(
    train: DataFrame,
    test: DataFrame,
    grid: Iterable[AlsConfig] = TUNING_GRID,
    threshold: float = RMSE_GATE,
    first: AlsConfig = AlsConfig(),
    num_blocks: int | None = None,
    keep_split: bool = True,
    at_once: int | None = None,
) -> tuple[Trial, list[Trial]]:
    """Try ``grid`` only if the first model's RMSE is above ``threshold``.

    Returns the best trial (a later one must be strictly better) and all trials.
    Each fit reads both sides once. ``keep_split`` holds them in memory and on
    disk meanwhile; turn it off for a split of a written table, where reading
    again costs less than a second copy of the table.

    ``at_once`` trials of the grid run at a time (:func:`sharing`: unless given, as many
    as cores would else be idle), each in a scheduler pool of its own; with
    ``spark.scheduler.mode=FAIR`` the pools share the executors evenly, else
    later trials take what earlier ones leave. Trials and best are those of running
    one by one in as many blocks: of equal errors the earlier configuration is the best. The
    driver holds the best model so far and those of trials that run. If a trial fails, those
    not begun are dropped and the error is raised.
    """
    sides = (train, test)
    if keep_split:
        sides = tuple(side.persist(StorageLevel.MEMORY_AND_DISK) for side in sides)
    try:
        blocks = num_blocks or blocks_of(sides[0])
        if at_once != 1:
            by_rows = blocks if num_blocks else -(-sides[0].count() // BLOCK_ROWS)
            cores = train.sparkSession.sparkContext.defaultParallelism
            at_once, num_blocks, kept_on = sharing(blocks, by_rows, cores, at_once)
            grid = [replace(config, blocks_on=kept_on) for config in grid]
        num_blocks = num_blocks or blocks
        best = train_eval(*sides, first, num_blocks)
        trials = [best]
        configs = list(grid) if best.rmse > threshold else []
        trials += [None] * len(configs)
        best_place = 0
        for place, trial in _trials(sides, configs, num_blocks, at_once):
            trials[place + 1] = trial
            if (trial.rmse, place + 1) < (best.rmse, best_place):
                best, best_place = trial, place + 1
            # A losing model's factors need not stay, nor what was shuffled for them.
            trials = [t if t is None or t is best else replace(t, model=None) for t in trials]
            del trial
            drop_unused(train.sparkSession)
    finally:
        if keep_split:
            for side in sides:
                side.unpersist()
    return best, trials
