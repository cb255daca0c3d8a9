"""Restarted queries and merged stream tables."""

from pathlib import Path

import pytest

from rateweave.plans.watch_events import watched_events
from rateweave.streaming.compaction import CompactedTable, last_committed
from rateweave.streaming.lifecycle import run_to_end
from rateweave.streaming.shared import WriteBatch
from rateweave.streaming.sinks import ONCE_THROUGH, for_each_batch
from rateweave.streaming.supervise import POOL, Supervisor

from .conftest import rows
from .test_streaming import Topic


@pytest.fixture
def topic(spark, tmp_path):
    topic = Topic(spark, tmp_path / "topic")
    for batch in range(6):
        topic.publish(*[(batch, i, 4.0, 10 * batch + i) for i in range(3)])
    return topic


class Failing:
    """Writes batches; fails some times at one of them, after half of the work."""

    def __init__(self, path, at, times):
        self.write, self.at, self.left, self.pools = WriteBatch(path), at, times, []

    def prepare(self, frame):
        self.write.prepare(frame)

    def __call__(self, batch, batch_id):
        self.pools.append(batch.sparkSession.sparkContext.getLocalProperty(POOL))
        if batch_id == self.at and self.left:
            self.left -= 1
            self.write(batch.limit(1), batch_id)
            raise RuntimeError("on purpose")
        self.write(batch, batch_id)


def starts(topic, tmp_path, handlers):
    def start(name):
        return lambda: for_each_batch(
            watched_events(topic.read()), name, handlers[name], str(tmp_path / f"c-{name}"), ONCE_THROUGH, "append"
        )

    return {name: start(name) for name in handlers}


def test_a_failed_query_goes_on_where_it_stopped(spark, topic, tmp_path):
    handlers = {name: Failing(str(tmp_path / name), 2, times) for name, times in (("well", 0), ("ill", 2))}
    supervisor = Supervisor(spark, starts(topic, tmp_path, handlers), limit=3, first_wait=0.1)
    supervisor.run(poll_seconds=0.1)
    want = rows(topic.table())
    for name in handlers:
        table = spark.read.parquet(str(tmp_path / name))
        assert rows(table.drop("batch_id")) == want
        assert rows(table.select("batch_id").distinct()) == [(i,) for i in range(6)]
    assert supervisor.jobs["well"].errors == [] and len(supervisor.jobs["ill"].errors) == 2
    assert "on purpose" in supervisor.jobs["ill"].errors[0]
    # The two batches before the failure ran once.
    assert len(handlers["ill"].pools) == 6 + 2


def test_a_query_that_keeps_failing_is_given_up(spark, topic, tmp_path):
    handlers = {"ill": Failing(str(tmp_path / "ill"), 0, 99)}
    supervisor = Supervisor(spark, starts(topic, tmp_path, handlers), limit=3, first_wait=0.05)
    with pytest.raises(Exception, match="on purpose"):
        supervisor.run(poll_seconds=0.05)
    assert supervisor.jobs["ill"].failures == 3


def test_readers_see_each_row_once_while_batches_are_merged(spark, topic, tmp_path):
    path, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    stream = watched_events(topic.read())
    run_to_end([for_each_batch(stream, "out", WriteBatch(path), checkpoint, ONCE_THROUGH, "append")])
    assert last_committed(spark, checkpoint) == 5
    table = CompactedTable(spark, path, stream.schema)
    want = rows(table.read())
    assert len(want) == 18 and table.segments() == [] == table.forgettable()
    before = table.read()
    assert table.merge(3) == 12
    assert rows(before) == want == rows(table.read())
    # A folder without its row in the table of versions is not looked at.
    table.read().limit(1).write.parquet(f"{path}.segments/2")
    assert rows(table.read()) == want and [s.upto for s in table.segments()] == [3]
    # The first segment is small: it is merged again, with what is new.
    assert table.merge(5) == 18 and rows(table.read()) == want and table.merge(5) == 0
    assert [(s.first, s.upto) for s in table.segments()] == [(0, 5)]
    assert len(list(Path(f"{path}.segments/2").rglob("*.parquet"))) == 1
    assert table.forgettable() == [f"{path}/batch_id={i}" for i in range(6)] + [f"{path}.segments/1"]
    topic.publish((9, 9, 4.0, 99))
    run_to_end([for_each_batch(watched_events(topic.read()), "out", WriteBatch(path), checkpoint, ONCE_THROUGH, "append")])
    assert len(rows(table.read())) == 19
    # A segment of the full size stays as it is.
    large = CompactedTable(spark, path, stream.schema, file_bytes=100)
    assert large.merge(6) == 1 and len(rows(large.read())) == 19
    assert [(s.first, s.upto, s.n_rows) for s in large.segments()] == [(0, 5, 18), (6, 6, 1)]
