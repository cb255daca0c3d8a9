import datetime as dt
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rateweave.operators import alerts
from rateweave.operators import window_metrics as wm

from .conftest import plan_of, rows

SCHEMA = "user_id int, item_id int, rating float, seconds double"


def events(spark, values):
    frame = spark.createDataFrame(values, SCHEMA)
    return frame.withColumn("event_time", F.timestamp_seconds("seconds")).drop("seconds")


def plain(frame):
    spans = [F.unix_seconds(c).alias(c) for c in ("window_start", "window_end")]
    return rows(frame.select(*spans, *frame.columns[2:]))


def by_hand(values, key, size, slide):
    groups = defaultdict(list)
    for event in values:
        start = int(event[3] // slide) * slide
        while start + size > event[3]:
            groups[start, start + size, event[key]].append(event[2])
            start -= slide
    return groups


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.integers(1, 3),
            st.integers(1, 3),
            st.integers(1, 10).map(lambda n: n / 2),
            st.integers(-200, 200).map(float),
        ),
        min_size=1,
        max_size=40,
    ),
    st.sampled_from([(30, 10), (30, 30), (60, 20)]),
)
def test_metrics_against_plain_python(spark, values, span):
    size, slide = span
    frame = events(spark, values)
    lengths = f"{size} seconds", f"{slide} seconds"
    items = {k: (round(sum(v) / len(v), 3), len(v)) for k, v in by_hand(values, 1, *span).items()}
    users = {k: (len(v), round(sum(v) / len(v), 3)) for k, v in by_hand(values, 0, *span).items()}

    found = plain(wm.item_window_metrics(frame, *lengths))
    assert {f[:3]: (pytest.approx(f[3], abs=6e-4), f[4]) for f in found} == items
    found = plain(wm.user_window_metrics(frame, *lengths))
    assert {f[:3]: (f[3], pytest.approx(f[4], abs=6e-4)) for f in found} == users


def test_each_event_is_in_three_windows_by_default(spark):
    found = plain(wm.item_window_metrics(events(spark, [(1, 9, 4.5, 95.0)])))
    assert found == [(70, 100, 9, 4.5, 1), (80, 110, 9, 4.5, 1), (90, 120, 9, 4.5, 1)]


def test_windows_tumble_without_a_slide(spark):
    found = plain(wm.user_window_metrics(events(spark, [(1, 9, 4.5, 95.0)]), "30 seconds", None))
    assert found == [(90, 120, 1, 1, 4.5)]


def test_an_item_with_most_events_is_combined_before_the_shuffle(spark):
    hot = spark.range(30000).select(
        F.lit(1).alias("user_id"),
        F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id")).cast("int").alias("item_id"),
        F.lit(4.0).cast("float").alias("rating"),
        F.timestamp_seconds(F.lit(100)).alias("event_time"),
    )
    metrics = wm.item_window_metrics(hot)
    assert {r.interaction_count for r in metrics.filter("item_id = 1").collect()} == {20000}
    plan = plan_of(metrics)
    assert "partial_avg" in plan
    assert plan.count("Exchange hashpartitioning") == 1


# Published averages, counts and scores.
TRENDING = [
    (4.765, 34, 16.941),
    (4.761, 23, 15.131),
    (4.725, 20, 14.385),
    (4.559, 17, 13.177),
    (4.733, 15, 13.123),
]


def metrics(spark, values):
    """``(item, avg, n)`` rows, all in one window."""
    frame = spark.createDataFrame(values, "item_id int, avg_rating double, interaction_count bigint")
    start = F.lit("2026-05-13 02:37:10").cast("timestamp").alias("window_start")
    end = F.lit("2026-05-13 02:37:40").cast("timestamp").alias("window_end")
    return frame.select(start, end, "*")


def test_published_trending_scores(spark):
    frame = metrics(spark, [(i, avg, n) for i, (avg, n, _) in enumerate(TRENDING)])
    top = wm.trending_top_k(wm.trending_score(frame), 5).collect()
    assert [(r.item_id, r.trending_score) for r in top] == [
        (i, score) for i, (_, _, score) in enumerate(TRENDING)
    ]


def test_top_k_breaks_ties_by_item_and_is_no_full_sort(spark):
    frame = wm.trending_score(metrics(spark, [(i, 4.0, 5) for i in (9, 3, 7, 1)]))
    assert [r.item_id for r in wm.trending_top_k(frame, 3).collect()] == [1, 3, 7]
    assert "TakeOrderedAndProject" in plan_of(wm.trending_top_k(frame, 3))


def test_item_alert_bounds_and_text(spark):
    frame = metrics(spark, [(589, 4.742, 9), (1, 4.5, 3), (2, 4.499, 30), (3, 5.0, 2)])
    found = {r.item_id: r.alert_msg for r in alerts.item_alerts(frame).collect()}
    assert found == {
        589: "ALERT: Item 589 is trending — avg_rating = 4.742 (threshold ≥ 4.5)",
        1: "ALERT: Item 1 is trending — avg_rating = 4.5 (threshold ≥ 4.5)",
    }


def test_item_alert_looks_at_the_rounded_average(spark):
    # 4.49964 on average: below the threshold before rounding to 4.5.
    values = [(u, 1, 4.5, 5.0) for u in range(1388)] + [(9, 1, 4.0, 5.0)]
    found = alerts.item_alerts(wm.item_window_metrics(events(spark, values), "10 seconds", None))
    assert [r.avg_rating for r in found.collect()] == [4.5]


def test_user_alert_bounds_and_text(spark):
    start = dt.datetime(2026, 5, 13, 2, 37, 30)
    frame = spark.createDataFrame(
        [(start, start, 2178, 3, 4.0), (start, start, 5, 2, 4.0)],
        "window_start timestamp, window_end timestamp, user_id int, "
        "interaction_count bigint, avg_rating_given double",
    )
    found = alerts.user_alerts(frame)
    assert found.columns == [
        "window_start", "window_end", "user_id", "interaction_count", "alert_msg",
    ]
    assert [r.alert_msg for r in found.collect()] == [
        "ALERT: User 2178 spike — 3 interactions in window"
    ]
    assert alerts.user_alerts(frame, threshold=10).count() == 0
