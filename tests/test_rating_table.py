"""Merging new ratings into a table of latest ones."""

import re
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rateweave import catalog
from rateweave.operators.cleaning import dedup_latest
from rateweave.sinks.rating_table import RatingTable

from .conftest import plan_of, rows

SCHEMA = "user_id int, item_id int, rating float, timestamp long"


@pytest.fixture
def table(spark, tmp_path):
    name = f"ratings_{uuid.uuid4().hex}"
    yield RatingTable(spark, name, str(tmp_path / "table"), folders=4, buckets=4)
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def drawn(spark, n, seed):
    draw = F.pmod(F.hash("id", F.lit(seed)), F.lit(10**6))
    return spark.range(n).select(
        (draw % 37).cast("int").alias("user_id"), (draw % 11).cast("int").alias("item_id"),
        (draw % 10 / 2).cast("float").alias("rating"), (draw % 5).cast("long").alias("timestamp"),
    )


def test_loads_in_steps_equal_one_load(spark, table):
    parts = [drawn(spark, n, n) for n in (300, 40, 500, 1)]
    whole = parts[0]
    for i, part in enumerate(parts):
        table.merge(part)
        whole = part if i == 0 else whole.unionAll(part)
        assert rows(table.read()) == rows(dedup_latest(whole))


def test_merging_twice_changes_nothing(spark, table):
    part = drawn(spark, 200, 1)
    table.merge(part)
    once = rows(table.read())
    table.merge(part)
    assert rows(table.read()) == once == rows(dedup_latest(part))


def test_nothing_to_merge(spark, table):
    assert table.merge(drawn(spark, 0, 1)) == [] and table.read().collect() == []


def test_only_folders_of_new_users_are_written(spark, table, tmp_path):
    table.merge(drawn(spark, 500, 1))

    def files():
        return {p: p.stat().st_mtime_ns for p in Path(tmp_path / "table").rglob("*.parquet")}

    before = files()
    new = spark.createDataFrame([(3, 3, 5.0, 99)], SCHEMA)
    (folder,) = table.merge(new)
    after = files()
    changed = {p.parent.name for p in before.keys() ^ after.keys()}
    assert changed == {f"folder={folder}"}
    assert table.read().where("timestamp = 99").count() == 1


def test_the_old_side_is_not_shuffled(spark, table):
    table.merge(drawn(spark, 500, 1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(table.merged(drawn(spark, 50, 2), [0, 1, 2, 3]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in plan and "SelectedBucketsCount: 4 out of 4" in plan
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and table.name in line)
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    assert join < scan and not any("Exchange" in line for line in lines[join:scan])
    assert len(re.findall("Exchange", plan)) <= 2


def test_an_opened_table_has_its_rows(spark, table, tmp_path):
    part = drawn(spark, 200, 1)
    table.merge(part)
    name = f"again_{uuid.uuid4().hex}"
    again = RatingTable(spark, name, str(tmp_path / "table"), folders=4, buckets=4)
    again.merge(drawn(spark, 200, 2))
    assert rows(again.read()) == rows(dedup_latest(part.unionAll(drawn(spark, 200, 2))))
    spark.sql(f"DROP TABLE {name}")


def test_steps_of_the_query_merge_lines_joined_once(spark, small_dir, monkeypatch):
    plans, real = [], RatingTable.merge
    monkeypatch.setattr(RatingTable, "merge", lambda self, own: plans.append(plan_of(own)) or real(self, own))
    catalog.QUERIES["merge_ratings"](spark, small_dir).count()
    assert len(plans) == 3 and not any("Join" in plan for plan in plans)
