"""Late and redelivered events, over several batches."""

import pytest
from pyspark.sql import functions as F

from rateweave.operators.factor_search import FactorSearch
from rateweave.operators.window_metrics import item_window_metrics
from rateweave.plans.watch_events import start_watching, watched_events
from rateweave.streaming.late import LateRows, without_redelivered
from rateweave.streaming.lifecycle import run_to_end
from rateweave.streaming.progress import ProgressTable, read_progress
from rateweave.streaming.recommendations import SearchUnseen
from rateweave.streaming.shared import Output, share, unchanged
from rateweave.streaming.sinks import ONCE_THROUGH, for_each_batch, to_parquet_append

from .conftest import rows
from .test_streaming import Topic, publish_trace, seconds, spans


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "topic")


def keep_late(spark, topic, path, name="late"):
    handler = share([Output(unchanged, LateRows(f"{path}/out"))])
    stream = watched_events(topic.read())
    run_to_end([for_each_batch(stream, name, handler, f"{path}/checkpoint", ONCE_THROUGH, "append")])
    late = spark.read.parquet(f"{path}/out/late").where("batch_id >= 0")
    return late.select(
        "batch_id", seconds("event_time"), seconds("window_start"), seconds("window_end"), seconds("watermark"),
        F.col("late_by_seconds"),
    )


def test_late_rows_are_those_that_the_aggregation_drops(spark, topic, tmp_path):
    publish_trace(topic)
    late = rows(keep_late(spark, topic, tmp_path))
    # The watermark of second 200 is 140; it counts from the batch after the next one.
    assert sorted(late) == [
        (3, 7, -20, 10, 140, 130.0), (3, 7, -10, 20, 140, 120.0), (3, 7, 0, 30, 140, 110.0),
    ]
    table = ProgressTable(spark, str(tmp_path / "progress"), ["dropping"])
    metrics = item_window_metrics(watched_events(topic.read()))
    query = to_parquet_append(metrics, "dropping", str(tmp_path / "m"), str(tmp_path / "c"), ONCE_THROUGH)
    run_to_end([query])
    table.wait([query])
    table.stop()
    dropped = read_progress(spark, str(tmp_path / "progress")).agg(F.sum("rows_dropped_late")).first()[0]
    assert dropped == len(late)


def test_a_restart_judges_as_before(spark, topic, tmp_path):
    topic.publish((1, 1, 4.0, 5))
    keep_late(spark, topic, tmp_path)
    topic.publish((1, 1, 4.0, 500))
    topic.publish((1, 1, 4.0, 505))
    assert rows(keep_late(spark, topic, tmp_path)) == []
    topic.publish((2, 1, 4.0, 100), (2, 1, 4.0, 440))
    late = rows(keep_late(spark, topic, tmp_path).select("batch_id", "event_time", "window_end"))
    # Of the windows of second 440, only that which ends at the watermark itself is closed.
    assert late == [(3, 100, 110), (3, 100, 120), (3, 100, 130)]
    topic.publish((3, 1, 4.0, 431))
    late = keep_late(spark, topic, tmp_path).where("batch_id = 4").select("event_time", "window_end")
    assert rows(late) == [(431, 440)]


def test_a_batch_that_runs_again_is_judged_alike(spark, topic, tmp_path):
    publish_trace(topic)
    handler = LateRows(str(tmp_path / "out"))
    events = topic.table()
    handler.prepare(events)
    for batch_id, second in ((0, 5), (1, 200), (2, 6), (3, 7), (3, 7), (2, 6), (3, 7)):
        handler(events.where(seconds("event_time") == second), batch_id)
    late = spark.read.parquet(f"{tmp_path}/out/late").where("batch_id >= 0")
    assert rows(late.select("batch_id", seconds("window_end"))) == [(3, 10), (3, 20), (3, 30)]


def test_redelivered_records_count_once(spark, topic, tmp_path):
    first, second = [(1, 1, 4.0, 5), (1, 2, 3.0, 6)], [(1, 1, 5.0, 50), (2, 1, 4.0, 50)]
    plain = Topic(spark, tmp_path / "plain")
    plain.publish(*first, *second, (9, 9, 4.0, 400))
    topic.publish(*first, *first)
    topic.publish(*second, *first)
    topic.publish(*second, *second, (9, 9, 4.0, 400))
    topic.publish(*first, *second, (9, 9, 4.0, 400))

    def run(name, source, once):
        events = watched_events(source.read())
        events = without_redelivered(events) if once else events
        out = str(tmp_path / f"out-{name}")
        query = to_parquet_append(item_window_metrics(events), name, out, str(tmp_path / f"c-{name}"), ONCE_THROUGH)
        run_to_end([query])
        return spans(spark.read.parquet(out))

    want = run("plain", plain, once=False)
    assert run("repeated", topic, once=True) == want and len(want) > 4
    assert run("counted", topic, once=False) != want


def test_the_watch_job_keeps_late_rows_and_recommends_unseen_items(spark, topic, tmp_path, capsys):
    publish_trace(topic)
    vectors = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(1, 9)], "id int, features array<float>")
    queries = start_watching(
        topic.read(), str(tmp_path / "out"), str(tmp_path / "checkpoints"), fast=ONCE_THROUGH, slow=ONCE_THROUGH,
        progress_path=str(tmp_path / "progress"), late_path=str(tmp_path / "late"),
        unseen=SearchUnseen(FactorSearch(vectors, vectors), top_n=2),
    )
    run_to_end(queries)
    queries.stop()
    late = spark.read.parquet(str(tmp_path / "late" / "late")).where("batch_id >= 0")
    assert rows(late.select(seconds("event_time"))) == [(7,)] * 3
    found = spark.read.parquet(str(tmp_path / "out" / "recommendations")).where("batch_id >= 0")
    assert {(r.user_id, r.item_id, r.rank) for r in found.collect()} == {(1, 8, 1), (1, 7, 2)} and found.count() == 10
    progress = read_progress(spark, str(tmp_path / "progress"))
    assert progress.select("query").distinct().count() == 5
