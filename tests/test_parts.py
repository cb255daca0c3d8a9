"""Reports and profiles from merged sketches, rejected lines with their place."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rateweave.operators import cleaning, latency
from rateweave.operators.profile_parts import RELATIVE_ERROR, part_profile, profile_of_parts
from rateweave.operators.profiling import dataset_cardinality
from rateweave.sources.ratings import line_numbers, read_lines_with_place, read_rating_lines
from rateweave.streaming.progress import PROGRESS_SCHEMA, ProgressTable, read_progress

from .conftest import rows


def progress(spark, times, query="q", day=1):
    started = dt.datetime(2024, 1, day, 12)
    return spark.createDataFrame(
        [(query, "run", i, 1, ms, ms, 0, 0, started) for i, ms in enumerate(times)], PROGRESS_SCHEMA
    )


def test_published_latencies_give_their_median(spark):
    times = [6297, 3563, 4620, 3007, 1985, 3485, 5137]
    table = progress(spark, times).unionAll(progress(spark, [7], "other"))
    idle = progress(spark, [101]).withColumn("num_input_rows", F.lit(0).cast("long"))
    report = latency.latency_report(latency.latency_sketches(table.unionAll(idle)))
    got = {r.query: r for r in report.collect()}
    assert (got["q"].n, got["q"].p50_ms, got["q"].p95_ms, got["q"].longest_ms) == (7, 3563, 6297, 6297)
    assert (got["other"].n, got["other"].p50_ms) == (1, 7)


def test_days_merge_within_the_error(spark):
    days = [progress(spark, [(i * 7919 + day * 13) % 100_003 for i in range(4_000)], day=day) for day in (1, 2, 3)]
    sketches = [latency.latency_sketches(day) for day in days]
    assert all(s.count() == 1 for s in sketches)
    merged = latency.latency_report(sketches[0].unionAll(sketches[1]).unionAll(sketches[2]), (0.1, 0.5, 0.95)).first()
    whole = sorted((i * 7919 + day * 13) % 100_003 for i in range(4_000) for day in (1, 2, 3))
    assert merged.n == 12_000 and merged.longest_ms == whole[-1]
    for q, got in ((0.1, merged.p10_ms), (0.5, merged.p50_ms), (0.95, merged.p95_ms)):
        rank = sum(x <= got for x in whole) / len(whole)
        assert rank == pytest.approx(q, abs=2 * latency.RANK_ERROR)


def test_progress_is_written_in_parts(spark, tmp_path):
    class Step:
        batchId, numInputRows, name, runId = 0, 5, "q", "run"
        durationMs, stateOperators, timestamp = {"triggerExecution": 9}, [], "2024-01-01T00:00:00.000Z"

    class Event:
        progress = Step

    path = str(tmp_path / "progress")
    table = ProgressTable(spark, path, every_rows=3)
    try:
        counts = []
        for _ in range(7):
            table.onQueryProgress(Event)
            counts.append(read_progress(spark, path).count())
        assert counts == [0, 0, 3, 3, 3, 6, 6]
        table.every_seconds = 0
        table.onQueryIdle(None)
        assert read_progress(spark, path).count() == 7
    finally:
        table.stop()
    assert read_progress(spark, path).where("started IS NULL").count() == 0


def drawn(spark, first, last):
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 40))
    return spark.range(first, last).select(
        (draw % 9_000).cast("int").alias("user_id"), (draw % 700).cast("int").alias("item_id"),
        (draw % 10 / 2 + 0.5).cast("float").alias("rating"),
    )


def test_a_new_part_updates_the_profile(spark):
    parts = part_profile(drawn(spark, 0, 40_000), "a").unionAll(part_profile(drawn(spark, 40_000, 50_000), "b"))
    got, whole = profile_of_parts(parts).first(), drawn(spark, 0, 50_000)
    exact = dataset_cardinality(whole.distinct()).first()
    assert got.n_ratings == 50_000 and got.mean == pytest.approx(whole.agg(F.avg("rating")).first()[0])
    for mine, truth in ((got.n_users, exact.n_users), (got.n_items, exact.n_items)):
        assert mine == pytest.approx(truth, rel=RELATIVE_ERROR)
    pairs = whole.select("user_id", "item_id").distinct().count()
    assert got.n_pairs == pytest.approx(pairs, rel=RELATIVE_ERROR)
    again = profile_of_parts(parts.unionAll(part_profile(drawn(spark, 0, 100), "c"))).first()
    assert (again.n_users, again.n_pairs) == (got.n_users, got.n_pairs) and again.n_ratings == 50_100


def test_the_profile_of_nothing(spark):
    none = part_profile(drawn(spark, 0, 0), "a")
    assert profile_of_parts(none).first()[:4] == (0, 0, 0, 0)
    assert profile_of_parts(none.limit(0)).first().n_ratings == 0


LINES = ["1::2::3.0::4", "x::2::3.0::4", "1::2::NaN::", "", "1::2::9.5::4", "1::2::0.4::4", "5::6::5.0::7::8", "7"]


def test_rejected_lines_say_why_and_where(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.txt").write_text("\n".join(LINES) + "\n")
    lines = read_lines_with_place(spark, str(tmp_path))
    rejected = line_numbers(cleaning.rejected_lines(lines), lines)
    own = rejected.where("file LIKE '%/b.txt'").orderBy("line").collect()
    assert [(r.line, r.value, r.reason, r.fields) for r in own] == [
        (1, LINES[1], "null", ["user_id"]), (2, LINES[2], "null", ["rating", "timestamp"]),
        (3, "", "null", ["user_id", "item_id", "rating", "timestamp"]), (4, LINES[4], "range", ["rating"]),
        (5, LINES[5], "range", ["rating"]), (7, "7", "null", ["item_id", "rating", "timestamp"]),
    ]
    assert rejected.count() == 2 * len(own) and {r.block_start for r in own} == {0}


def test_kept_and_rejected_are_all_lines(spark, tmp_path):
    path = str(tmp_path / "lines")
    spark.range(5_000).select(
        F.concat_ws("::", F.col("id") % 90, F.col("id") % 7, (F.col("id") % 13) / 2, F.when(F.col("id") % 5 > 0, F.col("id")))
        .alias("value")
    ).repartition(3).write.text(path)
    # Several blocks to a file, read by several tasks.
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        lines = read_lines_with_place(spark, path)
        rejected = line_numbers(cleaning.rejected_lines(lines), lines)
        found = rejected.groupBy("reason").count().collect()
        numbered = line_numbers(lines, lines)
        per_block = numbered.groupBy("file", "block_start").agg(
            F.count("*").alias("n"), F.count_distinct("line").alias("lines"), F.max("line").alias("last")
        )
        assert per_block.count() > 6 and per_block.where("n <> lines OR last <> n - 1").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    counts = cleaning.stage_counts(cleaning.parse_rating_lines(read_rating_lines(spark, path))).first()
    assert {r.reason: r["count"] for r in found} == {"null": counts.null_dropped, "range": counts.range_dropped}
    assert counts.raw_count == 5_000 == counts.valid_count + sum(r["count"] for r in found)
