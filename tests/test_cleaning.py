import math
import struct

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rateweave.operators import cleaning as c
from rateweave.schemas import RATING

from .conftest import plan_of, rows


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def ratings(spark, values):
    return spark.createDataFrame(values, RATING)


@pytest.mark.parametrize(
    ("line", "expected"),
    [
        ("1::1193::5::978300760", (1, 1193, 5.0, 978300760)),
        (" 1 :: 2 :: 3.5 :: 4 ", (1, 2, 3.5, 4)),
        ("1::2::bad::4", (1, 2, None, 4)),
        ("1::2::3", (1, 2, 3.0, None)),
        ("1::2::3::4::5", (1, 2, 3.0, 4)),
        ("3000000000::2::3::4", (None, 2, 3.0, 4)),
        ("1.7::2::3::4", (None, 2, 3.0, 4)),
        ("1:2:3:4", (None, None, None, None)),
        ("", (None, None, None, None)),
        (None, (None, None, None, None)),
    ],
)
def test_parse_line(spark, line, expected):
    assert rows(c.parse_rating_lines(lines(spark, [line]))) == [expected]


def test_delimiter_is_literal_text(spark):
    parsed = c.parse_rating_lines(lines(spark, ["1|2|3|4"]), "|")
    assert rows(parsed) == [(1, 2, 3.0, 4)]


def test_range_includes_its_bounds_and_rejects_nan(spark):
    values = [0.5, 5.0, 0.4999, 5.0001, float("nan"), -1.0, float("inf")]
    frame = ratings(spark, [(i, 1, v, 1) for i, v in enumerate(values)])
    assert [r.rating for r in c.filter_rating_range(frame).orderBy("user_id").collect()] == [
        0.5,
        5.0,
    ]


def test_dedup_keeps_latest_then_highest(spark):
    frame = ratings(
        spark,
        [(1, 1, 5.0, 10), (1, 1, 2.0, 20), (1, 1, 3.0, 20), (1, 2, 1.0, 5), (2, 1, 4.0, -7)],
    )
    assert rows(c.dedup_latest(frame)) == [(1, 1, 3.0, 20), (1, 2, 1.0, 5), (2, 1, 4.0, -7)]


def test_dedup_does_not_depend_on_partitioning(spark):
    frame = spark.range(3000).select(
        (F.col("id") % 20).cast("int").alias("user_id"),
        (F.col("id") % 7).cast("int").alias("item_id"),
        ((F.col("id") % 10 + 1) / 2).cast("float").alias("rating"),
        (F.col("id") % 13).alias("timestamp"),
    )
    assert rows(c.dedup_latest(frame.repartition(7))) == rows(c.dedup_latest(frame.coalesce(1)))


def test_a_pair_holding_half_the_rows_leaves_each_task_as_one_row(spark):
    hot = spark.range(20000).select(
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).cast("int").alias("user_id"),
        F.lit(1).alias("item_id"),
        F.lit(3.0).cast("float").alias("rating"),
        F.col("id").alias("timestamp"),
    )
    kept = c.dedup_latest(hot)
    assert kept.count() == 10000
    assert kept.filter("user_id = 1").first().timestamp == 19998
    # The maximum is taken before the one shuffle, and nothing is sorted globally.
    plan = plan_of(c.dedup_latest(hot))
    assert "partial_max" in plan
    assert plan.count("Exchange") == 1
    assert "rangepartitioning" not in plan


def test_funnel_in_one_shuffle_agrees_with_the_steps(spark):
    text = ["1::1::5::1", "1::1::4::2", "x::1::4::2", "1::2::9::2", "1::3::0.5::2", "1::4"]
    parsed = c.parse_rating_lines(lines(spark, text))
    assert rows(c.preprocess_funnel(parsed)) == [(6, 2, 1, 1, 2)]
    assert rows(c.stage_counts(parsed)) == [(6, 2, 1, 3)]
    assert "hashpartitioning" not in plan_of(c.stage_counts(parsed))


def test_funnel_of_nothing(spark):
    empty = c.parse_rating_lines(lines(spark, []))
    assert rows(c.preprocess_funnel(empty)) == [(0, 0, 0, 0, 0)]
    assert rows(c.stage_counts(empty)) == [(0, 0, 0, 0)]


def test_lines_are_split_once(spark, tmp_path):
    """Filters must not repeat the parsing of the projection below them."""
    path = str(tmp_path / "lines")
    lines(spark, ["1::2::3::4"]).write.text(path)
    parsed = c.parse_rating_lines(spark.read.text(path))
    plan = plan_of(c.filter_rating_range(c.drop_null_ratings(parsed)))
    assert plan.count("split(") == 1
    assert plan.count("try_cast") == 4


def _float32(value):
    return struct.unpack("f", struct.pack("f", value))[0]


field = st.one_of(
    st.integers(0, 3).map(str),
    st.sampled_from(["", "x", "4.5", "0.5", "5", "5.5", "-1", "1e0", "99999999999", "NaN"]),
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(field, min_size=1, max_size=5), max_size=40))
def test_clean_against_plain_python(spark, table):
    def to_int(text, bits):
        try:
            value = int(text)
        except ValueError:
            return None
        return value if -(2 ** (bits - 1)) <= value < 2 ** (bits - 1) else None

    def to_float(text):
        try:
            return _float32(float(text))
        except ValueError:
            return None

    best = {}
    dropped = {"null": 0, "range": 0}
    for parts in table:
        padded = (parts + [""] * 4)[:4]
        user, item = to_int(padded[0], 32), to_int(padded[1], 32)
        rating, when = to_float(padded[2]), to_int(padded[3], 64)
        if None in (user, item, rating, when) or math.isnan(rating):
            dropped["null"] += 1
        elif not 0.5 <= rating <= 5.0:
            dropped["range"] += 1
        else:
            best[user, item] = max(best.get((user, item), (when, rating)), (when, rating))

    frame = lines(spark, ["::".join(parts) for parts in table])
    assert rows(c.clean(frame)) == sorted(
        ((u, i, r, t) for (u, i), (t, r) in best.items()), key=repr
    )
    funnel = c.preprocess_funnel(c.parse_rating_lines(frame)).first()
    assert (funnel.raw_count, funnel.null_dropped, funnel.range_dropped, funnel.final_count) == (
        len(table),
        dropped["null"],
        dropped["range"],
        len(best),
    )
