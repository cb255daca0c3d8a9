"""Command line of the batch and streaming jobs; see ``run_job.py``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import functions as F

from rateweave.operators.events import to_kafka_envelope
from rateweave.operators.model import split_counts
from rateweave.plans.clean_ratings import clean_ratings
from rateweave.plans.train_model import (
    precompute_recommendations,
    sample_recommendations,
    train_model,
)
from rateweave.plans.watch_events import start_watching
from rateweave.session import STATE_CONF, build_session
from rateweave.sinks.models import BUCKETS
from rateweave.sinks.tables import write_kafka
from rateweave.sources.kafka import read_kafka_events
from rateweave.sources.models import load_model
from rateweave.sources.ratings import read_ratings
from rateweave.streaming.lifecycle import run_until_any_stops
from rateweave.streaming.recommendations import looked_up_in, scored_by


def _clean(args: argparse.Namespace) -> None:
    spark = build_session("clean ratings")
    report = clean_ratings(spark, args.lines, args.ratings, args.files)
    for frame in (report.funnel, report.cardinality, report.summary, report.distribution):
        frame.show(100, truncate=False)


def _train(args: argparse.Namespace) -> None:
    spark = build_session("train model")
    _, trials = train_model(
        spark, args.ratings, args.model, args.metrics, num_blocks=args.blocks, at_once=args.at_once
    )
    split_counts(read_ratings(spark, args.ratings)).show()
    for trial in trials:
        print(f"{trial.config}: RMSE {trial.rmse:.4f} in {trial.seconds:.1f} s")
    sample_recommendations(spark, args.ratings, args.model).show(25, truncate=False)


def _precompute(args: argparse.Namespace) -> None:
    build_session("precompute recommendations")
    precompute_recommendations(args.model, args.candidates, buckets=args.buckets)


def _publish(args: argparse.Namespace) -> None:
    spark = build_session("publish ratings")
    stamp = F.date_format(
        F.timestamp_seconds("timestamp"), "yyyy-MM-dd'T'HH:mm:ssXXX"
    ).alias("timestamp")
    records = read_ratings(spark, args.ratings).select("user_id", "item_id", "rating", stamp)
    write_kafka(
        to_kafka_envelope(records, args.partitions), args.servers, args.topic, dict(args.option)
    )


def _watch(args: argparse.Namespace) -> None:
    spark = build_session("watch events", STATE_CONF)
    candidates = None
    model = load_model(args.model) if args.model else None
    if args.candidates:
        candidates = looked_up_in(spark, args.candidates, model)
    elif model is not None:
        candidates = scored_by(model)
    envelope = read_kafka_events(
        spark,
        args.servers,
        args.topic,
        starting_offsets=args.starting_offsets,
        min_partitions=args.min_partitions,
        max_offsets_per_trigger=args.max_offsets,
        fail_on_data_loss=args.fail_on_data_loss,
        more=dict(args.option),
    )
    run_until_any_stops(
        start_watching(
            envelope, args.out, args.checkpoints, candidates, args.window, args.slide, args.delay,
            progress_path=f"{args.out}/progress",
        )
    )


def _key_value(text: str) -> tuple[str, str]:
    key, found, value = text.partition("=")
    if not found:
        raise argparse.ArgumentTypeError(f"{text!r} is not key=value")
    return key, value


def _add_options(job: argparse.ArgumentParser) -> None:
    job.add_argument(
        "--option", type=_key_value, action="append", default=[], metavar="KEY=VALUE",
        help="any other option of the connector; may be repeated",
    )


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("clean", help="rating lines to a clean Parquet table")
    job.add_argument("--lines", required=True)
    job.add_argument("--ratings", required=True)
    job.add_argument("--files", type=int)
    job.set_defaults(run=_clean)

    job = jobs.add_parser("train", help="clean ratings to a saved model")
    job.add_argument("--ratings", required=True)
    job.add_argument("--model", required=True)
    job.add_argument("--metrics", required=True)
    job.add_argument("--blocks", type=int)
    job.add_argument("--at-once", type=int, default=1, help="tuning trials that run at a time")
    job.set_defaults(run=_train)

    job = jobs.add_parser("precompute", help="candidates of all users, for streams")
    job.add_argument("--model", required=True)
    job.add_argument("--candidates", required=True)
    job.add_argument("--buckets", type=int, default=BUCKETS)
    job.set_defaults(run=_precompute)

    job = jobs.add_parser("publish", help="ratings as events on a topic")
    job.add_argument("--ratings", required=True)
    job.add_argument("--servers", required=True)
    job.add_argument("--topic", required=True)
    job.add_argument("--partitions", type=int, default=2)
    _add_options(job)
    job.set_defaults(run=_publish)

    job = jobs.add_parser("watch", help="metrics, alerts and recommendations of a topic")
    job.add_argument("--servers", required=True)
    job.add_argument("--topic", required=True)
    job.add_argument("--out", required=True)
    job.add_argument("--checkpoints", required=True)
    job.add_argument("--model", help="score users of each batch")
    job.add_argument("--candidates", help="look users up; --model is for those who need more")
    job.add_argument("--window", default="30 seconds")
    job.add_argument("--slide", default="10 seconds")
    job.add_argument("--delay", default="1 minute")
    job.add_argument("--starting-offsets", default="latest")
    job.add_argument("--min-partitions", type=int)
    job.add_argument("--max-offsets", type=int)
    job.add_argument("--fail-on-data-loss", action="store_true")
    _add_options(job)
    job.set_defaults(run=_watch)
    return top


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(args)
