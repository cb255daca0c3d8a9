"""Streaming job: metrics, trending items, alerts, raw events, recommendations."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rateweave.operators.alerts import item_alerts, user_alerts
from rateweave.operators.events import parse_events, valid_events
from rateweave.operators.window_metrics import (
    SLIDE,
    WINDOW,
    item_window_metrics,
    trending_score,
    trending_top_k,
    user_window_metrics,
)
from rateweave.streaming.late import LateRows
from rateweave.streaming.lifecycle import stop_all
from rateweave.streaming.progress import ProgressTable
from rateweave.streaming.recommendations import (
    Candidates,
    Finder,
    UnseenHandler,
    recommendation_handler,
)
from rateweave.streaming.shared import Output, share, show_batch, unchanged, write_batch
from rateweave.streaming.sinks import (
    EVERY_10_SECONDS,
    EVERY_30_SECONDS,
    Trigger,
    for_each_batch,
)
from rateweave.streaming.watermark import DELAY, with_event_watermark


def watched_events(envelope: DataFrame, delay: str = DELAY) -> DataFrame:
    """Valid events of a stream of broker records, with a watermark."""
    return with_event_watermark(valid_events(parse_events(envelope)), delay)


class Watching(list):
    """The queries that were started, and the table of their progress, if there is one."""

    progress: ProgressTable | None = None

    def stop(self) -> None:
        """Stop the queries and write the last of their progress."""
        stop_all(self)
        if self.progress is not None:
            self.progress.wait(self)
            self.progress.stop()


def start_watching(
    envelope: DataFrame,
    out_dir: str,
    checkpoint_dir: str,
    candidates: Candidates | None = None,
    size: str = WINDOW,
    slide: str | None = SLIDE,
    delay: str = DELAY,
    fast: Trigger = EVERY_10_SECONDS,
    slow: Trigger = EVERY_30_SECONDS,
    top_k: int = 5,
    progress_path: str | None = None,
    unseen: Finder | None = None,
    late_path: str | None = None,
) -> Watching:
    """Start five queries for ten outputs.

    ====================  ======  ==================================================
    query                 mode    outputs
    ====================  ======  ==================================================
    items_changed         update  item metrics, top-k trending and item alerts, shown
    users_changed         update  user metrics and user alerts, shown
    items_final           append  ``avg_rating_per_item`` and ``alerts/item``
    users_final           append  ``alerts/user``
    events                append  ``raw_events`` and ``recommendations``
    ====================  ======  ==================================================

    Without ``candidates`` no recommendations are made, and raw events are written
    at the slow trigger. Tables exist, empty, from the start. With ``progress_path``
    the time and volume of every batch are appended to a table there, until the result
    is stopped. ``unseen`` makes the recommendations in place of ``candidates``, and with
    ``late_path`` events too late for their windows are kept there, as judged by the
    batches of the query ``events``.
    """
    events = watched_events(envelope, delay)
    items = item_window_metrics(events, size, slide)
    users = user_window_metrics(events, size, slide)

    event_outputs = [Output(unchanged, write_batch(f"{out_dir}/raw_events"))]
    event_trigger = slow
    recommendations = write_batch(f"{out_dir}/recommendations")
    if unseen is not None:
        event_trigger = fast
        event_outputs.append(Output(unchanged, UnseenHandler(unseen, recommendations)))
    elif candidates is not None:
        event_trigger = fast
        event_outputs.append(
            Output(unchanged, recommendation_handler(candidates, recommendations))
        )
    if late_path is not None:
        event_outputs.append(Output(unchanged, LateRows(late_path, size, slide, delay)))

    queries = [
        (
            "items_changed",
            items,
            "update",
            fast,
            [
                Output(unchanged, show_batch("item metrics", 10)),
                Output(
                    lambda batch: trending_top_k(trending_score(batch), top_k),
                    show_batch("trending", top_k),
                ),
                Output(item_alerts, show_batch("item alerts")),
            ],
        ),
        (
            "users_changed",
            users,
            "update",
            fast,
            [
                Output(unchanged, show_batch("user metrics", 10)),
                Output(user_alerts, show_batch("user alerts")),
            ],
        ),
        (
            "items_final",
            items,
            "append",
            slow,
            [
                Output(unchanged, write_batch(f"{out_dir}/avg_rating_per_item")),
                Output(item_alerts, write_batch(f"{out_dir}/alerts/item", skip_empty=True)),
            ],
        ),
        (
            "users_final",
            users,
            "append",
            slow,
            [Output(user_alerts, write_batch(f"{out_dir}/alerts/user", skip_empty=True))],
        ),
        ("events", events, "append", event_trigger, event_outputs),
    ]
    started = Watching()
    if progress_path is not None:
        names = [query[0] for query in queries]
        started.progress = ProgressTable(events.sparkSession, progress_path, names)
    for name, frame, mode, trigger, outputs in queries:
        checkpoint = f"{checkpoint_dir}/{name}"
        started.append(for_each_batch(frame, name, share(outputs), checkpoint, trigger, mode))
    return started
