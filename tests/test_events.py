import datetime as dt

import pytest
from pyspark.sql import functions as F

from rateweave.functions.event_time import event_time
from rateweave.operators import events as e
from rateweave.schemas import ENVELOPE

from .conftest import plan_of, rows

INGEST = dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc)
PLAIN_INGEST = INGEST.replace(tzinfo=None)


def envelope(spark, texts):
    body = [(None, None if t is None else t.encode(), INGEST) for t in texts]
    return spark.createDataFrame(body, ENVELOPE)


def parsed(spark, text):
    frame = e.parse_events(envelope(spark, [text]))
    return tuple(frame.withColumn("event_time", F.col("event_time").cast("timestamp_ntz")).first())


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ('{"user_id":1,"item_id":2,"rating":4.5}', (1, 2, 4.5)),
        ("not json", (None, None, None)),
        ("[]", (None, None, None)),
        ("", (None, None, None)),
        (None, (None, None, None)),
        ('{"user_id":"a","item_id":2,"rating":4}', (None, 2, 4.0)),
        ('{"user_id":1.5,"item_id":2,"rating":"4.5"}', (None, 2, None)),
        ('{"user_id":1}', (1, None, None)),
        ('{"user_id":3000000000,"item_id":2,"rating":1}', (None, 2, 1.0)),
        ('{"user_id":1,"item_id":2,"rating":3,"extra":{"a":[1]}}', (1, 2, 3.0)),
    ],
)
def test_json_never_fails(spark, text, expected):
    assert parsed(spark, text) == (*expected, PLAIN_INGEST)


TIMES = [
    ("2026-05-13T02:37:30.123456+00:00", dt.datetime(2026, 5, 13, 2, 37, 30, 123456)),
    ("2026-05-13T02:37:30.123+00:00", dt.datetime(2026, 5, 13, 2, 37, 30, 123000)),
    ("2026-05-13T02:37:30+00:00", dt.datetime(2026, 5, 13, 2, 37, 30)),
    ("2026-05-13T02:37:30Z", dt.datetime(2026, 5, 13, 2, 37, 30)),
    ("2026-05-13T02:37:30+05:30", dt.datetime(2026, 5, 12, 21, 7, 30)),
    ("2026-05-13T02:37:30.123456", dt.datetime(2026, 5, 13, 2, 37, 30, 123456)),
    ("2026-05-13T02:37:30", dt.datetime(2026, 5, 13, 2, 37, 30)),
    ("2026-05-13 02:37:30", None),
    ("2026-05-13T02:37", None),
    ("2026-05-13T02:37:30.", None),
    ("2026-05-13T02:37:30.1234567", None),
    ("2026-05-13T02:37:30+0000", None),
    ("2026-02-30T00:00:00", None),
    ("2026-05-13T24:00:00", None),
    ("", None),
    (None, None),
]


@pytest.mark.parametrize(("text", "expected"), TIMES)
def test_event_time_falls_back_to_ingest_time(spark, text, expected):
    field = "null" if text is None else f'"{text}"'
    record = f'{{"user_id":1,"item_id":2,"rating":4,"timestamp":{field}}}'
    assert parsed(spark, record)[3] == (expected or PLAIN_INGEST)


def test_one_format_equals_its_four_variants(spark):
    frame = spark.createDataFrame([(text,) for text, _ in TIMES], "t string")
    day_time = "yyyy-MM-dd'T'HH:mm:ss"
    variants = [day_time + tail for tail in (".SSSSSSXXX", "XXX", ".SSSSSS", "")]
    separate = F.coalesce(*[F.try_to_timestamp("t", F.lit(v)) for v in variants])
    together = event_time(F.col("t"), F.lit(None).cast("timestamp"))
    assert frame.filter(~separate.eqNullSafe(together)).count() == 0


def test_validity(spark):
    good = '{"user_id":1,"item_id":2,"rating":%s,"timestamp":"2026-05-13T02:37:30Z"}'
    texts = [good % r for r in ("0.5", "5.0", "0.4", "5.5", '"NaN"', "null")]
    texts += ["junk", '{"user_id":1,"rating":3}', '{"item_id":1,"rating":3}']
    frame = e.valid_events(e.parse_events(envelope(spark, texts)))
    assert sorted(r.rating for r in frame.collect()) == [0.5, 5.0]


def test_event_without_any_time_is_invalid(spark):
    record = '{"user_id":1,"item_id":2,"rating":3}'
    frame = spark.createDataFrame([(None, record.encode(), None)], ENVELOPE)
    assert e.valid_events(e.parse_events(frame)).count() == 0


def test_json_and_time_are_parsed_once(spark, tmp_path):
    path = str(tmp_path / "envelope")
    envelope(spark, ["x"]).write.parquet(path)
    plan = plan_of(e.valid_events(e.parse_events(spark.read.parquet(path))))
    assert plan.count("from_json(") == 1
    assert plan.count("gettimestamp(") == 1


def test_published_records_parse_back(spark):
    records = spark.createDataFrame(
        [(7, 3, 4.5, "2026-05-13T02:37:30.000001+00:00"), (-3, 4, 1.0, "2026-05-13T00:00:00Z")],
        "user_id int, item_id int, rating float, timestamp string",
    )
    published = e.to_kafka_envelope(records, 2)
    assert [(r.key, r.partition) for r in published.orderBy("key").collect()] == [
        ("-3", 1),
        ("7", 1),
    ]
    back = e.parse_events(
        published.select(
            F.col("key").cast("binary").alias("key"),
            F.col("value").cast("binary").alias("value"),
            F.lit(INGEST).cast("timestamp").alias("timestamp"),
        )
    )
    assert rows(back.select("user_id", "item_id", "rating")) == [(-3, 4, 1.0), (7, 3, 4.5)]
