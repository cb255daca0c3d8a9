"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores. ``queries`` holds
the best of ``BENCH_RUNS`` runs, each to the end of its result (a no-op sink).
``alternatives`` holds the same steps written the obvious way, for comparison,
and ``microbatch_sec`` the latency of recommendation micro-batches.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from rateweave import catalog  # noqa: E402
from rateweave.operators import alerts, cleaning, events, profiling, recommend  # noqa: E402
from rateweave.operators import model as m  # noqa: E402
from rateweave.operators import window_metrics as wm  # noqa: E402
from rateweave.operators.factor_search import FactorSearch  # noqa: E402
from rateweave.plans.train_model import precompute_ranked, precompute_recommendations  # noqa: E402
from rateweave.plans.watch_events import watched_events  # noqa: E402
from rateweave.session import BASE_CONF, new_scratch  # noqa: E402
from rateweave.sinks.models import save_model  # noqa: E402
from rateweave.sinks.tables import write_ratings  # noqa: E402
from rateweave.sources import adapters  # noqa: E402
from rateweave.sources.files import stream_parquet  # noqa: E402
from rateweave.sources.models import load_model  # noqa: E402
from rateweave.sources.ratings import read_rating_lines, read_ratings  # noqa: E402
from rateweave.streaming.lifecycle import run_to_end  # noqa: E402
from rateweave.streaming.progress import ProgressTable, read_progress  # noqa: E402
from rateweave.streaming.recommendations import (  # noqa: E402
    LookUpUnseen,
    SearchUnseen,
    UnseenHandler,
    recommendation_handler,
    scored_by,
)
from rateweave.streaming.shared import write_batch  # noqa: E402
from rateweave.streaming.sinks import (  # noqa: E402
    ONCE_THROUGH,
    for_each_batch,
    to_parquet_append,
)

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
# Micro-batches that the whole event table is fed in.
BATCHES = 16


def session() -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("rateweave-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.log.level", "ERROR")
    )
    for key, value in BASE_CONF.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def timed(work: Callable[[], None], runs: int = RUNS) -> float:
    taken = []
    for _ in range(runs):
        started = time.monotonic()
        work()
        taken.append(time.monotonic() - started)
    return round(min(taken), 3)


def drain(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def microbatch_latencies(spark: SparkSession, make_handler: Callable) -> list[float]:
    """Seconds per micro-batch, the first (cold) one included."""
    path = new_scratch(spark, "latency")
    rows = spark.read.parquet(f"{SF_DIR}/events.parquet")
    records = adapters.envelope_from_events(rows)
    records.repartitionByRange(BATCHES, "timestamp").write.parquet(f"{path}/topic")
    stream = stream_parquet(spark, f"{path}/topic", records.schema, max_files_per_trigger=1)
    progress = ProgressTable(spark, f"{path}/progress", ["recommendations"])
    query = for_each_batch(
        watched_events(stream),
        "recommendations",
        make_handler(write_batch(f"{path}/out")),
        f"{path}/checkpoint",
        ONCE_THROUGH,
        "append",
    )
    run_to_end([query])
    progress.wait([query])
    progress.stop()
    steps = read_progress(spark, f"{path}/progress").where("num_input_rows > 0").orderBy("batch_id")
    return [round(step.trigger_ms / 1000, 3) for step in steps.collect()]


def main() -> None:
    spark = session()
    lines_path = new_scratch(spark, "lines")
    adapters.rating_lines(spark, SF_DIR).repartition(int(CPUS)).write.text(lines_path)
    envelope_path = new_scratch(spark, "envelope")
    adapters.event_records(spark, SF_DIR).repartition(int(CPUS)).write.parquet(envelope_path)

    lines = read_rating_lines(spark, lines_path)
    parsed = cleaning.parse_rating_lines(lines)
    clean = cleaning.clean(lines)
    ratings_path = new_scratch(spark, "ratings")
    write_ratings(clean, ratings_path)
    ratings = read_ratings(spark, ratings_path)
    records = spark.read.parquet(envelope_path)
    valid = events.valid_events(events.parse_events(records))

    window = catalog.LONG

    def items(source: DataFrame) -> DataFrame:
        return wm.item_window_metrics(source, **window)

    def users(source: DataFrame) -> DataFrame:
        return wm.user_window_metrics(source, **window)

    def append_stream(name: str, derive: Callable[[DataFrame], DataFrame]) -> None:
        path = new_scratch(spark, name)
        stream = watched_events(stream_parquet(spark, envelope_path, records.schema))
        run_to_end(
            [
                to_parquet_append(
                    derive(stream), name, f"{path}/out", f"{path}/checkpoint", ONCE_THROUGH
                )
            ]
        )

    frames = {
        "clean_lines": clean,
        "preprocess_funnel": cleaning.preprocess_funnel(parsed),
        "stage_counts": cleaning.stage_counts(parsed),
        "dataset_cardinality": profiling.dataset_cardinality(ratings),
        "rating_summary": profiling.rating_summary(ratings),
        "rating_distribution": profiling.rating_distribution(ratings),
        "valid_events": valid,
        "item_window_metrics": items(valid),
        "item_window_metrics_30s": wm.item_window_metrics(valid),
        "user_window_metrics": users(valid),
        "trending_top_k": wm.trending_top_k(wm.trending_score(items(valid))),
        "item_alerts": alerts.item_alerts(items(valid)),
        "user_alerts": alerts.user_alerts(users(valid)),
        "rerank_excluding_seen": catalog.QUERIES["rerank_excluding_seen"](spark, SF_DIR),
    }
    measured = {name: timed(lambda f=frame: drain(f)) for name, frame in frames.items()}
    measured["raw_events_stream"] = timed(lambda: append_stream("raw", lambda e: e))
    measured["item_metrics_append_stream"] = timed(lambda: append_stream("items", items))
    measured["user_alerts_append_stream"] = timed(
        lambda: append_stream("alerts", lambda e: alerts.user_alerts(users(e)))
    )

    train, test = m.train_test_split(ratings)
    trials: list[m.Trial] = []
    measured["als_train_eval"] = timed(lambda: trials.append(m.train_eval(train, test)), runs=2)
    model_path = new_scratch(spark, "model")
    save_model(trials[0].model, model_path)
    model = load_model(model_path)
    candidates_path = new_scratch(spark, "candidates")
    measured["precompute_recommendations"] = timed(
        lambda: precompute_recommendations(model_path, candidates_path), runs=2
    )
    measured["recommend_all_users"] = timed(
        lambda: drain(recommend.recommend_all(model, 5)), runs=2
    )
    ranked_path = new_scratch(spark, "ranked")
    measured["precompute_ranked"] = timed(lambda: precompute_ranked(model_path, ranked_path), runs=2)
    search = FactorSearch.of(model)
    searched = microbatch_latencies(spark, lambda write: UnseenHandler(SearchUnseen(search), write))
    looked_up = microbatch_latencies(
        spark, lambda write: UnseenHandler(LookUpUnseen(spark, ranked_path, search), write)
    )
    measured["microbatch_median_scored"] = round(statistics.median(searched), 3)
    measured["microbatch_median_looked_up"] = round(statistics.median(looked_up), 3)
    all_pairs = microbatch_latencies(
        spark, lambda write: recommendation_handler(scored_by(model), write)
    )

    alternatives = {
        "microbatch_median_all_pairs_overfetched": round(statistics.median(all_pairs), 3),
        "clean_lines_conditions_repeat_parsing": timed(lambda: drain(plainly_cleaned(lines))),
        "funnel_counted_step_by_step": timed(lambda: stepwise_counts(lines)),
        "dedup_by_global_sort": timed(
            lambda: drain(
                cleaning.filter_rating_range(cleaning.drop_null_ratings(parsed))
                .sort(F.desc("timestamp"))
                .dropDuplicates(["user_id", "item_id"])
            )
        ),
    }
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of headline queries",
                "value": round(sum(measured.values()), 3),
                "unit": "sec",
                "queries": measured,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
                "cpus": int(CPUS),
                "alternatives": alternatives,
                "microbatch_sec": {"scored": searched, "looked_up": looked_up},
                "rmse": round(trials[0].rmse, 4),
            }
        )
    )


def plainly_parsed(lines: DataFrame) -> DataFrame:
    fields = F.split("value", "::")
    kinds = {"user_id": "int", "item_id": "int", "rating": "float", "timestamp": "bigint"}
    return lines.select(
        *[F.get(fields, F.lit(i)).try_cast(k).alias(n) for i, (n, k) in enumerate(kinds.items())]
    )


def plainly_cleaned(lines: DataFrame) -> DataFrame:
    kept = cleaning.filter_rating_range(cleaning.drop_null_ratings(plainly_parsed(lines)))
    return cleaning.dedup_latest(kept)


def stepwise_counts(lines: DataFrame) -> None:
    parsed = plainly_parsed(lines)
    complete = cleaning.drop_null_ratings(parsed)
    in_range = cleaning.filter_rating_range(complete)
    distinct = in_range.sort(F.desc("timestamp")).dropDuplicates(["user_id", "item_id"])
    for step in (lines, complete, in_range, distinct):
        step.count()


if __name__ == "__main__":
    main()
