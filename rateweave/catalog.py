"""Every operator as a query over the given tables, with SQL to check it by.

``QUERIES`` maps a name to ``f(spark, sf_dir) -> DataFrame``; ``ORACLES`` maps
most of the names to equivalent SQL. Ratings come from line items joined with
orders and events from the event table, both whole
(:mod:`rateweave.sources.adapters`).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rateweave.operators import alerts, cleaning, events, latency, model, profiling, recommend
from rateweave.operators import window_metrics as wm
from rateweave.operators.factor_search import FactorSearch
from rateweave.operators.profile_parts import RELATIVE_ERROR, part_profile, profile_of_parts
from rateweave.plans.train_model import precompute_recommendations
from rateweave.plans.watch_events import start_watching, watched_events
from rateweave.session import new_scratch
from rateweave.sinks.models import save_model, save_ranked
from rateweave.sinks.rating_table import RatingTable
from rateweave.sinks.tables import write_metrics, write_ratings
from rateweave.sources import adapters
from rateweave.sources.files import stream_parquet
from rateweave.sources.models import load_model, read_recommendations
from rateweave.sources.ratings import (
    line_numbers,
    read_lines_with_place,
    read_rating_lines,
    read_ratings,
)
from rateweave.streaming.late import LateRows, without_redelivered
from rateweave.streaming.lifecycle import run_to_end
from rateweave.streaming.progress import ProgressTable, read_progress
from rateweave.streaming.recommendations import (
    Finder,
    LookUpUnseen,
    SearchUnseen,
    UnseenHandler,
    looked_up_in,
    recommendation_handler,
    scored_by,
)
from rateweave.streaming.shared import Output, share, unchanged, write_batch
from rateweave.streaming.sinks import ONCE_THROUGH, for_each_batch, to_parquet_append

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Events are minutes apart, so windows of the default length hold one each; the
# long windows give averages and alerts something to work on.
LONG = {"size": "1 day", "slide": "8 hours"}


def _register(sql: str | None = None) -> Callable[[Query], Query]:
    def wrap(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # Times are compared as UTC: the frame is planned, and streams run, in it.
            before = spark.conf.get("spark.sql.session.timeZone")
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            try:
                return query(spark, sf_dir.rstrip("/"))
            finally:
                spark.conf.set("spark.sql.session.timeZone", before)

        run.__doc__ = query.__doc__
        QUERIES[query.__name__] = run
        if sql is not None:
            ORACLES[query.__name__] = sql
        return query

    return wrap


# --- SQL fragments ---------------------------------------------------------

_RATINGS = """
lines AS (
  SELECT concat_ws('::', o_custkey, l_partkey,
           CASE WHEN l_orderkey % 97 = 0 THEN 'bad' WHEN l_orderkey % 101 = 0 THEN 'NaN'
                ELSE (l_quantity / 10)::VARCHAR END,
           CASE WHEN l_orderkey % 89 <> 0 THEN epoch(o_orderdate)::BIGINT::VARCHAR END) AS value
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
parts AS (SELECT string_split(value, '::') AS p FROM lines),
parsed AS (
  SELECT try_cast(p[1] AS INTEGER) AS user_id, try_cast(p[2] AS INTEGER) AS item_id,
         try_cast(p[3] AS FLOAT) AS rating, try_cast(p[4] AS BIGINT) AS "timestamp"
  FROM parts),
complete AS (
  SELECT * FROM parsed WHERE user_id IS NOT NULL AND item_id IS NOT NULL
     AND rating IS NOT NULL AND NOT isnan(rating) AND "timestamp" IS NOT NULL),
in_range AS (SELECT * FROM complete WHERE rating BETWEEN 0.5 AND 5.0),
latest AS (
  SELECT user_id, item_id, rating, "timestamp" FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, item_id
                                 ORDER BY "timestamp" DESC, rating DESC) AS rn
    FROM in_range) WHERE rn = 1)
"""

_RATING_COLUMNS = 'user_id, item_id, rating::DOUBLE AS rating, "timestamp"'
# NaN, which engines compare differently, is shown as -1.
_PARSED_COLUMNS = (
    'user_id, item_id, CASE WHEN isnan(rating) THEN -1 ELSE rating::DOUBLE END AS rating, "timestamp"'
)

_SPLIT = (
    _RATINGS
    + """,
drawn AS (
  SELECT user_id, item_id, rating,
         ('0x' || substr(md5(concat_ws(':', '42', user_id, item_id)), 1, 8))::BIGINT
           / 4294967296.0::DOUBLE < 0.8 AS in_train
  FROM latest)
"""
)

_RECORDS = """
records AS (
  SELECT event_id, ts, user_id::INTEGER AS user_id, (props ->> '$.k')::INTEGER AS item_id,
         (5.0 - floor(value / 10) / 2)::FLOAT AS rating,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS stamp
  FROM events)
"""

_EVENTS = (
    _RECORDS
    + """,
envelope AS (
  SELECT CASE WHEN event_id % 50 = 1 THEN 'not json' ELSE json_object(
           'user_id', user_id, 'item_id', item_id,
           'rating', CASE WHEN event_id % 50 <> 2 THEN rating END,
           'timestamp', CASE WHEN event_id % 50 = 3 THEN 'n/a' ELSE stamp END)::VARCHAR END AS value,
         ts + INTERVAL 5 SECOND AS ingest_time
  FROM records),
bodies AS (SELECT try_cast(value AS JSON) AS body, ingest_time FROM envelope),
parsed AS (
  SELECT (body ->> '$.user_id')::INTEGER AS user_id, (body ->> '$.item_id')::INTEGER AS item_id,
         (body ->> '$.rating')::FLOAT AS rating,
         coalesce(try_strptime(body ->> '$.timestamp', '%Y-%m-%dT%H:%M:%S.%f+00:00'),
                  ingest_time) AS event_time
  FROM bodies),
valid AS (
  SELECT * FROM parsed WHERE user_id IS NOT NULL AND item_id IS NOT NULL
     AND rating BETWEEN 0.5 AND 5.0 AND event_time IS NOT NULL)
"""
)


def _windows_sql(size_s: int, slide_s: int) -> str:
    return (
        _EVENTS
        + f""",
placed AS (
  SELECT v.*, time_bucket(INTERVAL {slide_s} SECOND, event_time, TIMESTAMP '1970-01-01')
                - i * INTERVAL {slide_s} SECOND AS window_start
  FROM valid v, range({size_s // slide_s}) t(i)),
item_metrics AS (
  SELECT window_start, window_start + INTERVAL {size_s} SECOND AS window_end, item_id,
         round(avg(rating::DOUBLE), 3) AS avg_rating, count(*) AS interaction_count
  FROM placed GROUP BY ALL),
user_metrics AS (
  SELECT window_start, window_start + INTERVAL {size_s} SECOND AS window_end, user_id,
         count(*) AS interaction_count, round(avg(rating::DOUBLE), 3) AS avg_rating_given
  FROM placed GROUP BY ALL),
trending AS (
  SELECT *, round(avg_rating * ln(1 + interaction_count::DOUBLE), 3) AS trending_score
  FROM item_metrics),
item_alerts AS (
  SELECT *, concat_ws(' ', 'ALERT: Item', item_id, 'is trending — avg_rating =', avg_rating,
                      '(threshold ≥ 4.5)') AS alert_msg
  FROM item_metrics WHERE avg_rating >= 4.5 AND interaction_count >= 3),
user_alerts AS (
  SELECT * EXCLUDE (avg_rating_given),
         concat_ws(' ', 'ALERT: User', user_id, 'spike —', interaction_count,
                   'interactions in window') AS alert_msg
  FROM user_metrics WHERE interaction_count >= 3)
"""
    )


_LONG_WINDOWS = _windows_sql(86400, 28800)
_SHORT_WINDOWS = _windows_sql(30, 10)
# What an append stream has given out after one pass: the windows behind the watermark.
_CLOSED = "WHERE window_end <= (SELECT max(event_time) - INTERVAL 1 MINUTE FROM valid)"

_CANDIDATES = """
pairs AS (
  SELECT o_custkey::INTEGER AS user_id, l_partkey::INTEGER AS item_id, l_returnflag
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
candidates AS (
  SELECT DISTINCT user_id, item_id,
         ((user_id::BIGINT * 7919 + item_id::BIGINT * 104729) % 500) / 100.0::DOUBLE
           AS predicted_rating
  FROM pairs),
seen AS (SELECT DISTINCT user_id, item_id FROM pairs WHERE l_returnflag = 'R'),
unseen AS (SELECT * FROM candidates ANTI JOIN seen USING (user_id, item_id))
"""


def _ranked_sql(relation: str, n: int) -> str:
    return f"""
SELECT user_id, item_id, predicted_rating, rk::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id
                               ORDER BY predicted_rating DESC, item_id) AS rk
  FROM {relation}) WHERE rk <= {n}"""


# --- Frames the queries start from -----------------------------------------


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.parse_rating_lines(adapters.rating_lines(spark, sf_dir))


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(adapters.rating_lines(spark, sf_dir))


def _plain(ratings: DataFrame) -> DataFrame:
    """Ratings as double, and NaN as -1: what SQL engines compare exactly."""
    return ratings.withColumn("rating", F.nanvl(F.col("rating").cast("double"), F.lit(-1.0)))


def _utc(frame: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the SQL gives them."""
    casts = {
        name: F.col(name).cast("timestamp_ntz")
        for name, kind in frame.dtypes
        if kind == "timestamp"
    }
    return frame.withColumns(casts)


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.valid_events(events.parse_events(adapters.event_records(spark, sf_dir)))


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir}/events.parquet"
    rows = stream_parquet(spark, path, spark.read.parquet(path).schema)
    return watched_events(adapters.envelope_from_events(rows))


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("int").alias("user_id"),
        F.col("l_partkey").cast("int").alias("item_id"),
        "l_returnflag",
    )


def _candidates(pairs: DataFrame) -> DataFrame:
    mixed = F.col("user_id").cast("bigint") * 7919 + F.col("item_id").cast("bigint") * 104729
    return pairs.select("user_id", "item_id").distinct().withColumn(
        "predicted_rating", (mixed % 500) / 100.0
    )


def _seen(pairs: DataFrame) -> DataFrame:
    return pairs.filter(F.col("l_returnflag") == "R")


# --- Cleaning ---------------------------------------------------------------


@_register(f"WITH {_RATINGS} SELECT {_PARSED_COLUMNS} FROM parsed")
def parse_rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_parsed(spark, sf_dir))


@_register(f"WITH {_RATINGS} SELECT {_PARSED_COLUMNS} FROM parsed")
def read_rating_lines_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines written as text and read back with the text source."""
    path = new_scratch(spark, "lines")
    adapters.rating_lines(spark, sf_dir).write.text(path)
    return _plain(cleaning.parse_rating_lines(read_rating_lines(spark, path)))


@_register(f"WITH {_RATINGS} SELECT {_RATING_COLUMNS} FROM complete")
def drop_null_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(cleaning.drop_null_ratings(_parsed(spark, sf_dir)))


@_register(f"WITH {_RATINGS} SELECT {_RATING_COLUMNS} FROM in_range")
def filter_rating_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    complete = cleaning.drop_null_ratings(_parsed(spark, sf_dir))
    return _plain(cleaning.filter_rating_range(complete))


@_register(f"WITH {_RATINGS} SELECT {_RATING_COLUMNS} FROM latest")
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_clean(spark, sf_dir))


@_register(f"WITH {_RATINGS} SELECT {_RATING_COLUMNS} FROM latest")
def write_read_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean ratings through the Parquet sink and source."""
    path = new_scratch(spark, "ratings")
    write_ratings(_clean(spark, sf_dir), path)
    return _plain(read_ratings(spark, path))


@_register(f"WITH {_RATINGS} SELECT {_RATING_COLUMNS} FROM latest")
def merge_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest ratings of all lines, taken into a table in three steps."""
    path = new_scratch(spark, "merged")
    table = RatingTable(spark, f"ratings_{uuid.uuid4().hex}", path, folders=4, buckets=8)
    # Each step reads its lines twice: they are joined once and kept.
    dealt = adapters.rating_lines(spark, sf_dir).withColumn("step", F.pmod(F.xxhash64("value"), F.lit(3)))
    kept = new_scratch(spark, "lines")
    dealt.write.partitionBy("step").parquet(kept)
    lines = spark.read.schema("value string, step int").parquet(kept)
    for step in range(3):
        own = lines.where(F.col("step") == step)
        table.merge(cleaning.filter_rating_range(cleaning.drop_null_ratings(cleaning.parse_rating_lines(own))))
    return _plain(table.read())


@_register(
    f"""WITH {_RATINGS}
SELECT (SELECT count(*) FROM parsed) AS raw_count,
       (SELECT count(*) FROM parsed) - (SELECT count(*) FROM complete) AS null_dropped,
       (SELECT count(*) FROM complete) - (SELECT count(*) FROM in_range) AS range_dropped,
       (SELECT count(*) FROM in_range) AS valid_count"""
)
def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.stage_counts(_parsed(spark, sf_dir))


@_register(
    f"""WITH {_RATINGS}
SELECT (SELECT count(*) FROM parsed) AS raw_count,
       (SELECT count(*) FROM parsed) - (SELECT count(*) FROM complete) AS null_dropped,
       (SELECT count(*) FROM complete) - (SELECT count(*) FROM in_range) AS range_dropped,
       (SELECT count(*) FROM in_range) - (SELECT count(*) FROM latest) AS duplicate_dropped,
       (SELECT count(*) FROM latest) AS final_count"""
)
def preprocess_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.preprocess_funnel(_parsed(spark, sf_dir))


@_register(
    f"""WITH {_RATINGS},
judged AS (
  SELECT value, user_id, item_id, rating, "timestamp",
         CASE WHEN user_id IS NULL OR item_id IS NULL OR rating IS NULL OR isnan(rating)
                   OR "timestamp" IS NULL THEN 'null'
              WHEN rating NOT BETWEEN 0.5 AND 5.0 THEN 'range' END AS reason
  FROM (SELECT value, try_cast(p[1] AS INTEGER) AS user_id, try_cast(p[2] AS INTEGER) AS item_id,
               try_cast(p[3] AS FLOAT) AS rating, try_cast(p[4] AS BIGINT) AS "timestamp"
        FROM (SELECT value, string_split(value, '::') AS p FROM lines)))
SELECT value, reason, CASE WHEN reason = 'range' THEN 'rating' ELSE concat_ws(',',
         CASE WHEN user_id IS NULL THEN 'user_id' END, CASE WHEN item_id IS NULL THEN 'item_id' END,
         CASE WHEN rating IS NULL OR isnan(rating) THEN 'rating' END,
         CASE WHEN "timestamp" IS NULL THEN 'timestamp' END) END AS fields, true AS placed
FROM judged WHERE reason IS NOT NULL"""
)
def rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a text table that cleaning drops, and whether each has its own place."""
    path = new_scratch(spark, "lines")
    adapters.rating_lines(spark, sf_dir).write.text(path)
    lines = read_lines_with_place(spark, path)
    rejected = line_numbers(cleaning.rejected_lines(lines), lines)
    place = Window.partitionBy("file", "block_start", "line")
    placed = (F.count("*").over(place) == 1) & (F.col("line") >= 0) & F.col("file").contains(path)
    return rejected.select("value", "reason", F.array_join("fields", ",").alias("fields"), placed.alias("placed"))


# --- Profiling --------------------------------------------------------------


@_register(
    f"""WITH {_RATINGS}
SELECT count(*) AS n_ratings, round(avg(rating::DOUBLE), 6) AS mean, min(rating)::DOUBLE AS min_rating,
       max(rating)::DOUBLE AS max_rating, count(DISTINCT user_id) AS n_users,
       count(DISTINCT item_id) AS n_items, count(DISTINCT (user_id, item_id)) AS n_pairs,
       true AS within_error
FROM in_range"""
)
def profile_from_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of three parts merged; beside exact counts, and whether they agree."""
    path = new_scratch(spark, "profiles")
    # Joined and parsed once, and kept: the parts and the exact counts are passes over it.
    write_ratings(cleaning.filter_rating_range(cleaning.drop_null_ratings(_parsed(spark, sf_dir))), f"{path}/valid")
    valid = read_ratings(spark, f"{path}/valid")
    for i in range(3):
        # A part is profiled when it comes; earlier rows are not needed again.
        part = valid.where(F.col("item_id") % 3 == i)
        part_profile(part, f"part {i}").write.mode("append").parquet(f"{path}/parts")
    about = profile_of_parts(spark.read.parquet(f"{path}/parts"))
    # Counted apart: in one aggregation every row would be shuffled three times, with all columns.
    exact = profiling.distinct_counts(valid, users=("user_id",), items=("item_id",), pairs=("user_id", "item_id"))

    def near(estimate: str, truth: str):
        return F.abs(F.col(estimate) - F.col(truth)) <= RELATIVE_ERROR * F.col(truth)

    return about.join(exact, F.lit(True)).select(
        "n_ratings", F.round("mean", 6).alias("mean"), F.col("min_rating").cast("double").alias("min_rating"),
        F.col("max_rating").cast("double").alias("max_rating"), F.col("users").alias("n_users"),
        F.col("items").alias("n_items"), F.col("pairs").alias("n_pairs"),
        (near("n_users", "users") & near("n_items", "items") & near("n_pairs", "pairs")).alias("within_error"),
    )


@_register(
    f"""WITH {_RATINGS}
SELECT count(*) AS n_ratings, count(DISTINCT user_id) AS n_users,
       count(DISTINCT item_id) AS n_items,
       round(1.0 - count(*)::DOUBLE
             / (count(DISTINCT user_id)::DOUBLE * count(DISTINCT item_id)), 9) AS sparsity
FROM latest"""
)
def dataset_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = profiling.dataset_cardinality(_clean(spark, sf_dir))
    return measured.withColumn("sparsity", F.round("sparsity", 9))


@_register(
    f"""WITH {_RATINGS}
SELECT count(*) AS n, round(avg(rating::DOUBLE), 6) AS mean,
       round(stddev_samp(rating::DOUBLE), 6) AS stddev,
       min(rating)::DOUBLE AS min_rating, max(rating)::DOUBLE AS max_rating
FROM latest"""
)
def rating_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = profiling.rating_summary(_clean(spark, sf_dir))
    return summary.withColumns({c: F.round(c, 6) for c in ("mean", "stddev")})


@_register(
    f"""WITH {_RATINGS}
SELECT rating::DOUBLE AS rating, count(*) AS count FROM latest GROUP BY rating"""
)
def rating_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(profiling.rating_distribution(_clean(spark, sf_dir)))


# --- Events -----------------------------------------------------------------

_EVENT_COLUMNS = "user_id, item_id, rating::DOUBLE AS rating, event_time"


@_register(f"WITH {_EVENTS} SELECT {_EVENT_COLUMNS} FROM parsed")
def parse_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _utc(_plain(events.parse_events(adapters.event_records(spark, sf_dir))))


@_register(f"WITH {_EVENTS} SELECT {_EVENT_COLUMNS} FROM valid")
def valid_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _utc(_plain(_valid(spark, sf_dir)))


@_register(
    f"""WITH {_RECORDS}
SELECT user_id::VARCHAR AS key,
       concat('{{"user_id":', user_id, ',"item_id":', item_id, ',"rating":', rating::VARCHAR,
              ',"timestamp":"', stamp, '"}}') AS value,
       (user_id % 2)::INTEGER AS partition
FROM records"""
)
def kafka_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.to_kafka_envelope(adapters.records_from_events(rows), 2)


# --- Window metrics, trending, alerts ---------------------------------------

_ITEM_COLUMNS = "window_start, window_end, item_id, avg_rating, interaction_count"
_USER_COLUMNS = "window_start, window_end, user_id, interaction_count"


@_register(f"WITH {_LONG_WINDOWS} SELECT {_ITEM_COLUMNS} FROM item_metrics")
def item_window_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _utc(wm.item_window_metrics(_valid(spark, sf_dir), **LONG))


@_register(f"WITH {_SHORT_WINDOWS} SELECT {_ITEM_COLUMNS} FROM item_metrics")
def item_window_metrics_30s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _utc(wm.item_window_metrics(_valid(spark, sf_dir)))


@_register(f"WITH {_LONG_WINDOWS} SELECT {_USER_COLUMNS}, avg_rating_given FROM user_metrics")
def user_window_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _utc(wm.user_window_metrics(_valid(spark, sf_dir), **LONG))


@_register(f"WITH {_SHORT_WINDOWS} SELECT {_USER_COLUMNS}, avg_rating_given FROM user_metrics")
def user_window_metrics_30s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _utc(wm.user_window_metrics(_valid(spark, sf_dir)))


@_register(f"WITH {_LONG_WINDOWS} SELECT {_ITEM_COLUMNS}, trending_score FROM trending")
def trending_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _utc(wm.trending_score(wm.item_window_metrics(_valid(spark, sf_dir), **LONG)))


_TOP_TRENDING = f"""WITH {_LONG_WINDOWS}
SELECT {_ITEM_COLUMNS}, trending_score FROM trending
ORDER BY trending_score DESC, window_start, item_id LIMIT 5"""


@_register(_TOP_TRENDING)
def trending_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = wm.item_window_metrics(_valid(spark, sf_dir), **LONG)
    return _utc(wm.trending_top_k(wm.trending_score(metrics)))


@_register(f"WITH {_LONG_WINDOWS} SELECT {_ITEM_COLUMNS}, alert_msg FROM item_alerts")
def item_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _utc(alerts.item_alerts(wm.item_window_metrics(_valid(spark, sf_dir), **LONG)))


@_register(f"WITH {_LONG_WINDOWS} SELECT {_USER_COLUMNS}, alert_msg FROM user_alerts")
def user_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _utc(alerts.user_alerts(wm.user_window_metrics(_valid(spark, sf_dir), **LONG)))


# --- Streams: the same operators behind a stream source ----------------------


def _appended(spark: SparkSession, frame: DataFrame, name: str) -> DataFrame:
    path = new_scratch(spark, name)
    run_to_end(
        [to_parquet_append(frame, name, f"{path}/out", f"{path}/checkpoint", ONCE_THROUGH)]
    )
    return _utc(spark.read.parquet(f"{path}/out"))


@_register(f"WITH {_LONG_WINDOWS} SELECT {_ITEM_COLUMNS} FROM item_metrics {_CLOSED}")
def item_metrics_append_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = wm.item_window_metrics(_stream(spark, sf_dir), **LONG)
    return _appended(spark, metrics, "item_metrics")


@_register(f"WITH {_LONG_WINDOWS} SELECT {_USER_COLUMNS}, alert_msg FROM user_alerts {_CLOSED}")
def user_alerts_append_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = wm.user_window_metrics(_stream(spark, sf_dir), **LONG)
    return _appended(spark, alerts.user_alerts(metrics), "user_alerts")


@_register(f"WITH {_LONG_WINDOWS} SELECT {_ITEM_COLUMNS}, alert_msg FROM item_alerts {_CLOSED}")
def item_alerts_append_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics and alerts written by one query; the alerts are returned."""
    path = new_scratch(spark, "item_outputs")
    outputs = [
        Output(unchanged, write_batch(f"{path}/metrics")),
        Output(alerts.item_alerts, write_batch(f"{path}/alerts")),
    ]
    metrics = wm.item_window_metrics(_stream(spark, sf_dir), **LONG)
    checkpoint = f"{path}/checkpoint"
    run_to_end(
        [
            for_each_batch(
                metrics, "item_outputs", share(outputs), checkpoint, ONCE_THROUGH, "append"
            )
        ]
    )
    return _utc(spark.read.parquet(f"{path}/alerts").drop("batch_id"))


@_register(f"WITH {_LONG_WINDOWS} SELECT {_USER_COLUMNS}, avg_rating_given FROM user_metrics")
def user_metrics_update_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every window the stream changed; the pass over the table is one batch."""
    path = new_scratch(spark, "user_metrics")
    metrics = wm.user_window_metrics(_stream(spark, sf_dir), **LONG)
    handler = share([Output(unchanged, write_batch(f"{path}/out"))])
    run_to_end([for_each_batch(metrics, "users", handler, f"{path}/checkpoint", ONCE_THROUGH)])
    return _utc(spark.read.parquet(f"{path}/out").drop("batch_id"))


@_register(_TOP_TRENDING)
def trending_foreach_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top k of each update micro-batch; the pass over the table is one batch."""
    path = new_scratch(spark, "trending")
    scored = wm.trending_score(wm.item_window_metrics(_stream(spark, sf_dir), **LONG))
    handler = share([Output(wm.trending_top_k, write_batch(f"{path}/out"))])
    run_to_end([for_each_batch(scored, "trending", handler, f"{path}/checkpoint", ONCE_THROUGH)])
    return _utc(spark.read.parquet(f"{path}/out").drop("batch_id"))


@_register(f"WITH {_EVENTS} SELECT {_EVENT_COLUMNS} FROM valid")
def raw_events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_appended(spark, _stream(spark, sf_dir), "raw_events"))


@_register("SELECT 'progress' AS query, 0::BIGINT AS batch_id, count(*) AS num_input_rows FROM events")
def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress rows of a stateless query; the times in them are left out here."""
    path = new_scratch(spark, "progress")
    table = ProgressTable(spark, f"{path}/progress", ["progress"])
    query = to_parquet_append(
        _stream(spark, sf_dir), "progress", f"{path}/out", f"{path}/checkpoint", ONCE_THROUGH
    )
    run_to_end([query])
    table.wait([query])
    table.stop()
    return read_progress(spark, f"{path}/progress").select("query", "batch_id", "num_input_rows")


_SPANS = """
spans AS (SELECT event_type AS query, 1000 + floor(value * 100)::BIGINT AS ms FROM events)
"""


@_register(
    f"""WITH {_SPANS}
SELECT query, count(*) AS n, max(ms) AS longest_ms, true AS median_near, true AS p95_near
FROM spans GROUP BY query"""
)
def latency_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median and p95 from merged daily sketches, and whether their ranks are near.

    Each event stands for a batch, its value for the time that took.
    """
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    progress = rows.select(
        F.col("event_type").alias("query"), F.col("ts").cast("timestamp").alias("started"),
        F.lit(1).alias("num_input_rows"),
        (1000 + F.floor(F.col("value") * 100)).cast("long").alias("trigger_ms"),
    )
    path = new_scratch(spark, "sketches")
    latency.latency_sketches(progress).write.parquet(path)
    report = latency.latency_report(spark.read.parquet(path))
    ms = F.col("trigger_ms")

    def near(column: str, q: float):
        """The quantile's place among all values, against the share it stands for."""
        below = F.count_if(ms < F.col(column)) / F.count("*")
        to = F.count_if(ms <= F.col(column)) / F.count("*")
        allowed = F.lit(3 * latency.RANK_ERROR)
        return (below <= q + allowed) & (to >= q - allowed)

    both = progress.select("query", "trigger_ms").join(report, "query")
    return both.groupBy("query", "n", "longest_ms").agg(
        near("p50_ms", 0.5).alias("median_near"), near("p95_ms", 0.95).alias("p95_near")
    )


# Streams of several batches: events dealt to batches by their number.
BATCHES = 4
_EVENTS_BY_ID = (
    _EVENTS.replace("AS ingest_time\n  FROM records", "AS ingest_time, event_id\n  FROM records")
    .replace("AS body, ingest_time FROM", "AS body, ingest_time, event_id FROM")
    .replace("AS event_time\n  FROM bodies", "AS event_time, event_id\n  FROM bodies")
)
_IN_ORDER = f"event_id * {BATCHES} // (SELECT max(event_id) + 1 FROM events)"


def _batches(spark: SparkSession, sf_dir: str, parts: list[DataFrame]) -> DataFrame:
    """A stream of valid events with one batch for each part of the event table."""
    path, files = new_scratch(spark, "batches"), spark.sparkContext.defaultParallelism
    for part in parts:
        # The file stream takes older files first, as many to a batch as a part has.
        envelope = adapters.envelope_from_events(part)
        envelope.repartition(files).write.mode("append").parquet(path)
    return watched_events(stream_parquet(spark, path, envelope.schema, files))


def _in_order(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The event table in parts, one after the other."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    last = rows.agg(F.max("event_id")).first()[0]
    part = F.floor(F.col("event_id") * BATCHES / (last + 1))
    return [rows.where(part == i) for i in range(BATCHES)]


def _in_disorder(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The event table in parts that all span the whole time."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    return [rows.where(F.col("event_id") % BATCHES == i) for i in range(BATCHES)]


@_register(
    f"""WITH {_LONG_WINDOWS.replace("FROM valid v,", "FROM (SELECT DISTINCT * FROM valid) v,")}
SELECT {_ITEM_COLUMNS} FROM item_metrics {_CLOSED}"""
)
def item_metrics_redelivered_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record delivered twice at once, and again with the next batch: counted once."""
    parts = _in_order(spark, sf_dir)
    delivered = [
        part.unionAll(part) if i == 0 else part.unionAll(part).unionAll(parts[i - 1])
        for i, part in enumerate(parts)
    ]
    events = without_redelivered(_batches(spark, sf_dir, delivered))
    return _appended(spark, wm.item_window_metrics(events, **LONG), "redelivered")


# A batch drops what is late by the watermark that the batch before it had.
_LATE = f"""WITH {_EVENTS_BY_ID},
dealt AS (SELECT *, event_id % {BATCHES} AS batch FROM valid),
times AS (SELECT batch, max(event_time) AS latest FROM dealt GROUP BY batch),
marks AS (
  SELECT b.batch, max(t.latest) - INTERVAL 1 MINUTE AS watermark
  FROM times b LEFT JOIN times t ON t.batch <= b.batch - 2 GROUP BY b.batch),
placed AS (
  SELECT d.*, watermark, time_bucket(INTERVAL 28800 SECOND, event_time, TIMESTAMP '1970-01-01')
                - i * INTERVAL 28800 SECOND AS window_start
  FROM dealt d JOIN marks USING (batch), range(3) t(i)),
judged AS (
  SELECT *, window_start + INTERVAL 1 DAY AS window_end,
         coalesce(window_start + INTERVAL 1 DAY <= watermark, false) AS late
  FROM placed)
"""


def _late_rows(spark: SparkSession, stream: DataFrame) -> DataFrame:
    path = new_scratch(spark, "late")
    handler = share([Output(unchanged, LateRows(f"{path}/out", **LONG))])
    run_to_end(
        [for_each_batch(stream, "late", handler, f"{path}/checkpoint", ONCE_THROUGH, "append")]
    )
    return spark.read.parquet(f"{path}/out/late")


@_register(
    _LATE
    + """SELECT batch::INTEGER AS batch_id, user_id, item_id, rating::DOUBLE AS rating, event_time,
       window_start, window_end, watermark,
       round((epoch_us(watermark) - epoch_us(window_end)) / 1e6, 6) AS late_by_seconds
FROM judged WHERE late"""
)
def late_rows_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that come too late for their windows, in batches that overlap in time."""
    late = _late_rows(spark, _batches(spark, sf_dir, _in_disorder(spark, sf_dir)))
    late = late.where("batch_id >= 0").withColumn("late_by_seconds", F.round("late_by_seconds", 6))
    return _utc(_plain(late))


@_register(
    _LATE
    + """SELECT window_start, item_id, count(*) FILTER (WHERE NOT late) AS n_kept,
       count(*) FILTER (WHERE late) AS n_late
FROM judged GROUP BY window_start, item_id"""
)
def kept_and_late_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the windowed aggregation counted, beside what it left out as late."""
    stream = _batches(spark, sf_dir, _in_disorder(spark, sf_dir))
    path = new_scratch(spark, "kept")
    handler = share([Output(unchanged, write_batch(f"{path}/out"))])
    metrics = wm.item_window_metrics(stream, **LONG)
    run_to_end([for_each_batch(metrics, "kept", handler, f"{path}/checkpoint", ONCE_THROUGH)])
    # Of each window, the last batch that changed it has the final count.
    kept = spark.read.parquet(f"{path}/out").groupBy("window_start", "item_id").agg(
        F.max(F.struct("batch_id", "interaction_count"))["interaction_count"].alias("n_kept")
    )
    late = _late_rows(spark, stream).groupBy("window_start", "item_id").agg(F.count("*").alias("n_late"))
    both = kept.join(late, ["window_start", "item_id"], "full_outer")
    return _utc(both.fillna(0, ["n_kept", "n_late"]))


# --- Recommendations after the model -----------------------------------------


@_register(f"WITH {_CANDIDATES} SELECT user_id, item_id, predicted_rating FROM unseen")
def exclude_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _pairs(spark, sf_dir)
    return recommend.exclude_seen(_candidates(pairs), _seen(pairs))


@_register(f"WITH {_CANDIDATES} {_ranked_sql('candidates', 5)}")
def rerank_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend.rerank_top_n(_candidates(_pairs(spark, sf_dir)))


@_register(f"WITH {_CANDIDATES} {_ranked_sql('unseen', 5)}")
def rerank_excluding_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _pairs(spark, sf_dir)
    unseen = recommend.exclude_seen(_candidates(pairs), _seen(pairs))
    return recommend.rerank_top_n(unseen)


@_register(
    f"""WITH {_CANDIDATES}
SELECT user_id, item_id, round((predicted_rating + 0.0004)::FLOAT::DOUBLE, 3) AS predicted_rating
FROM ({_ranked_sql('candidates', 20)})"""
)
def flatten_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One array of 20 ranked items per user, as the model gives them, flattened."""
    ranked = recommend.rerank_top_n(_candidates(_pairs(spark, sf_dir)), 20)
    rating = (F.col("predicted_rating") + 0.0004).cast("float").alias("rating")
    arrays = ranked.groupBy("user_id").agg(
        F.collect_list(F.struct("item_id", rating)).alias("recommendations")
    )
    flat = recommend.flatten_recommendations(arrays)
    return flat.withColumn(
        "predicted_rating", F.round(F.col("predicted_rating").cast("double"), 3)
    )


# --- Model --------------------------------------------------------------------


@_register(f"WITH {_SPLIT} SELECT user_id, item_id, in_train FROM drawn")
def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = model.train_test_split(_clean(spark, sf_dir))

    def side(rows: DataFrame, in_train: bool) -> DataFrame:
        return rows.select("user_id", "item_id", F.lit(in_train).alias("in_train"))

    return side(train, True).unionAll(side(test, False))


@_register(
    f"""WITH {_SPLIT}
SELECT count(*) AS total_rows, count(*) FILTER (WHERE in_train) AS train_rows,
       count(*) FILTER (WHERE NOT in_train) AS test_rows
FROM drawn"""
)
def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.split_counts(_clean(spark, sf_dir))


@_register(
    f"""WITH {_SPLIT}
SELECT DISTINCT user_id FROM drawn WHERE in_train ORDER BY user_id LIMIT 5"""
)
def sample_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = model.train_test_split(_clean(spark, sf_dir))
    return recommend.sample_users(train)


@_register(
    f"""WITH {_RATINGS},
predicted AS (SELECT rating::DOUBLE AS r, ((user_id + item_id) % 10 + 1) / 2.0::DOUBLE AS p FROM latest)
SELECT count(*) AS n, round(sqrt(avg((p - r) * (p - r))), 6) AS rmse FROM predicted"""
)
def rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The error measure, on predictions any engine can make."""
    prediction = ((F.col("user_id") + F.col("item_id")) % 10 + 1) / 2.0
    predicted = _clean(spark, sf_dir).withColumn("prediction", prediction)
    return model.rmse(predicted).withColumn("rmse", F.round("rmse", 6))


def _split_on_disk(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    path = new_scratch(spark, "ratings")
    write_ratings(_clean(spark, sf_dir), path)
    return model.train_test_split(read_ratings(spark, path))


def _saved_model(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """A model of the training rows, saved; and those rows."""
    train, _ = _split_on_disk(spark, sf_dir)
    path = new_scratch(spark, "model")
    save_model(model.fit_als(train), path)
    return path, train


# What the model must give can be said in SQL, up to the values of the factors:
# which rows there are, and checks that are computed from all of them.
_KNOWN = (
    _SPLIT
    + """,
train AS (SELECT * FROM drawn WHERE in_train),
predictable AS (
  SELECT user_id, item_id, rating FROM drawn
  WHERE NOT in_train AND user_id IN (SELECT user_id FROM train)
    AND item_id IN (SELECT item_id FROM train)),
n_items AS (SELECT count(DISTINCT item_id) AS n FROM train)
"""
)


@_register(
    f"""WITH {_KNOWN}
SELECT 10 AS rank, (SELECT count(*) FROM train) AS train_rows,
       (SELECT count(*) FROM drawn WHERE NOT in_train) AS test_rows,
       (SELECT count(*) FROM predictable) AS predicted_rows, true AS same_rmse"""
)
def als_train_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a trial, and whether its error is that of its predictions."""
    train, test = _split_on_disk(spark, sf_dir)
    trial = model.train_eval(train, test)
    miss = F.pow(F.col("prediction").cast("double") - F.col("rating").cast("double"), 2)
    sides = model.split_counts(train.unionAll(test)).first()
    return (
        model.predict(trial.model, test)
        .agg(F.count("*").alias("predicted_rows"), F.avg(miss).alias("square"))
        .select(
            F.lit(trial.config.rank).alias("rank"), F.lit(sides.train_rows).cast("bigint").alias("train_rows"),
            F.lit(sides.test_rows).cast("bigint").alias("test_rows"), "predicted_rows",
            (F.abs(F.sqrt("square") - trial.rmse) < 1e-9).alias("same_rmse"),
        )
    )


def _tried(grid: str) -> str:
    """SQL for the trials of a grid: each predicts the rows that are known from the ratings."""
    return f"""WITH {_KNOWN}
SELECT place, rank, reg_param::DOUBLE AS reg_param, max_iter, (SELECT count(*) FROM predictable) AS predicted_rows,
       true AS is_best_least, true AS due
FROM (VALUES {grid}) AS tried(place, rank, reg_param, max_iter)"""


def _trial_rows(spark: SparkSession, best: model.Trial, trials: list[model.Trial], gate: float) -> DataFrame:
    """A row per trial: is the best one, and only it, the first of least error; was it due."""
    least, due = min(t.rmse for t in trials), (trials[0].rmse > gate) == (len(trials) > 1)
    first = min(n for n, t in enumerate(trials) if t.rmse == least)
    return model.trial_table(spark, best, trials).select(
        "place", "rank", "reg_param", "max_iter", "predicted_rows",
        (F.col("is_best") == (F.col("place") == first)).alias("is_best_least"), F.lit(due).alias("due"),
    )


@_register(_tried("(0, 10, 0.1, 10), (1, 20, 0.05, 15), (2, 15, 0.01, 20), (3, 10, 0.3, 20), (4, 25, 0.05, 10)"))
def als_tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The configurations tried, since the first model misses the gate; as many at a time as the cores hold."""
    best, trials = model.tune_if_needed(*_split_on_disk(spark, sf_dir), keep_split=False)
    return _trial_rows(spark, best, trials, model.RMSE_GATE)


@_register(_tried("(0, 4, 0.1, 3), (1, 6, 0.05, 3), (2, 4, 0.3, 3), (3, 8, 0.1, 2)"))
def als_tuned_at_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A grid of small models, three at a time, each in a pool of its own, over one kept split."""
    first, *grid = (
        model.AlsConfig(4, 0.1, 3), model.AlsConfig(6, 0.05, 3), model.AlsConfig(4, 0.3, 3), model.AlsConfig(8, 0.1, 2),
    )
    best, trials = model.tune_if_needed(*_split_on_disk(spark, sf_dir), grid, 0.0, first, at_once=3)
    return _trial_rows(spark, best, trials, 0.0)


@_register(f"WITH {_KNOWN} SELECT user_id, item_id, rating::DOUBLE AS rating FROM predictable")
def als_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test rows the model can predict."""
    train, test = _split_on_disk(spark, sf_dir)
    predicted = model.predict(model.fit_als(train), test).where("NOT isnan(prediction)")
    return _plain(predicted.select("user_id", "item_id", "rating"))


@_register(
    f"""WITH {_KNOWN}
SELECT 'user' AS kind, user_id AS id FROM train GROUP BY ALL
UNION ALL SELECT 'item', item_id FROM train GROUP BY ALL"""
)
def model_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users and items of a model that was saved and loaded again."""
    path, _ = _saved_model(spark, sf_dir)
    loaded = load_model(path)
    return loaded.userFactors.select(F.lit("user").alias("kind"), "id").unionAll(
        loaded.itemFactors.select(F.lit("item"), "id")
    )


def _counted(recommendations: DataFrame) -> DataFrame:
    """Rows per user, and whether no score rises along the list."""
    rising = F.exists(
        F.sequence(F.lit(1), F.size("recommendations")),
        lambda i: F.coalesce(
            F.get(F.col("recommendations.rating"), i) > F.get(F.col("recommendations.rating"), i - 1),
            F.lit(False),
        ),
    )
    falling = recommendations.select("user_id", (~rising).alias("falling"))
    listed = recommend.flatten_recommendations(recommendations)
    counts = listed.groupBy("user_id").agg(F.count("*").alias("n_items"))
    return counts.join(falling, "user_id")


@_register(
    f"""WITH {_KNOWN}
SELECT DISTINCT user_id, least(5, (SELECT n FROM n_items)) AS n_items, true AS falling
FROM train ORDER BY user_id LIMIT 5"""
)
def als_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of a few users."""
    path, train = _saved_model(spark, sf_dir)
    return _counted(recommend.recommend(load_model(path), recommend.sample_users(train)))


@_register(
    f"""WITH {_KNOWN}
SELECT DISTINCT user_id, least(20, (SELECT n FROM n_items)) AS n_items, true AS falling FROM train"""
)
def als_recommendations_all_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of every user, as saved for streams."""
    path, _ = _saved_model(spark, sf_dir)
    out = new_scratch(spark, "candidates")
    precompute_recommendations(path, out)
    return _counted(read_recommendations(spark, out))


def _streamed_recommendations(spark: SparkSession, sf_dir: str, precomputed: bool) -> DataFrame:
    model_path, _ = _saved_model(spark, sf_dir)
    path = new_scratch(spark, "recommendations")
    loaded = load_model(model_path)
    if precomputed:
        precompute_recommendations(model_path, f"{path}/candidates")
        candidates = looked_up_in(spark, f"{path}/candidates", loaded)
    else:
        candidates = scored_by(loaded)
    handler = recommendation_handler(candidates, write_batch(f"{path}/out"))
    run_to_end(
        [
            for_each_batch(
                _stream(spark, sf_dir),
                "recommendations",
                handler,
                f"{path}/checkpoint",
                ONCE_THROUGH,
                "append",
            )
        ]
    )
    if not precomputed:
        candidates.release()
    found = spark.read.parquet(f"{path}/out").drop("batch_id")
    seen = _valid(spark, sf_dir).select("user_id", "item_id").distinct().withColumn("old", F.lit(1))
    by_rank = Window.partitionBy("user_id").orderBy("rank")
    before = F.lag("predicted_rating").over(by_rank)
    checked = found.join(seen, ["user_id", "item_id"], "left").select(
        "user_id", "old",
        (F.row_number().over(by_rank) == F.col("rank")).alias("numbered"),
        F.coalesce(F.col("predicted_rating") <= before, F.lit(True)).alias("lower"),
    )
    return checked.groupBy("user_id").agg(
        F.count("*").alias("n_items"), F.count("old").alias("n_seen"),
        F.bool_and(F.col("numbered") & F.col("lower")).alias("falling"),
    )


# One pass over the events is one batch: what a user has seen is all of their events.
_STREAMED = f"""WITH {_KNOWN}, {_EVENTS.replace("parsed", "parsed_events")},
seen AS (
  SELECT DISTINCT user_id, item_id, item_id IN (SELECT item_id FROM train) AS known FROM valid
  WHERE user_id IN (SELECT user_id FROM train)),
left_over AS (
  SELECT user_id, least(5, any_value(n) - count(*) FILTER (WHERE known)) AS n_items
  FROM seen, n_items GROUP BY user_id)
SELECT user_id, n_items, 0::BIGINT AS n_seen, true AS falling FROM left_over WHERE n_items > 0"""


@_register(_STREAMED)
def stream_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of each micro-batch scored by the model."""
    return _streamed_recommendations(spark, sf_dir, precomputed=False)


@_register(_STREAMED)
def stream_recommendations_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of each micro-batch looked up in saved candidates."""
    return _streamed_recommendations(spark, sf_dir, precomputed=True)


# Factors that any engine has: vectors as those of items, and backwards as those of users.
_FACTORS = """
items AS (SELECT vec_id AS item_id, list_transform(embedding, lambda x: x::DOUBLE) AS f FROM embeddings),
users AS (SELECT item_id AS user_id, list_reverse(f) AS f FROM items)
"""


def _scored_sql(users: str, keys: str, unseen: str) -> str:
    """The five best unseen items of each user, over all scores."""
    return f"""
scored AS (
  SELECT {keys}, u.user_id::INTEGER AS user_id, i.item_id::INTEGER AS item_id,
         round(list_inner_product(u.f, i.f)::FLOAT::DOUBLE, 2) AS predicted_rating
  FROM {users} u, items i WHERE {unseen})
SELECT {keys.replace("u.", "")}, user_id, item_id, predicted_rating, row_number() OVER (
  PARTITION BY {keys.replace("u.", "")}, user_id ORDER BY predicted_rating DESC, item_id)::INTEGER AS rank
FROM scored QUALIFY rank <= 5"""


def _factors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Factors of users and items."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    items = vectors.select(F.col("vec_id").cast("int").alias("id"), F.col("embedding").alias("features"))
    return items.withColumn("features", F.reverse("features")), items


def _two_digits(found: DataFrame) -> DataFrame:
    rating = F.round(F.col("predicted_rating").cast("double"), 2)
    return found.withColumn("predicted_rating", rating)


@_register(
    f"""WITH {_FACTORS},
{_scored_sql("users", "0 AS batch_id", "i.item_id NOT BETWEEN u.user_id AND u.user_id + 60").replace("0 AS batch_id, user_id ORDER", "user_id ORDER")}"""
)
def recommendations_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best items of every user, some sixty of them seen, by the pruned search."""
    users, items = _factors(spark, sf_dir)
    search = FactorSearch(users, items)
    seen = F.sequence("id", F.col("id") + 60).alias("seen")
    found = search.top(users.select(F.col("id").alias("user_id"), seen), recommend.TOP_N, 2)
    return _two_digits(found).withColumn("batch_id", F.lit(0))


_UNSEEN_BY_BATCH = f"""WITH {_FACTORS}, {_EVENTS_BY_ID},
seen AS (SELECT DISTINCT ({_IN_ORDER})::INTEGER AS batch_id, user_id, item_id FROM valid),
asked AS (SELECT DISTINCT batch_id, user_id, f FROM seen JOIN users USING (user_id)),
{_scored_sql("asked", "u.batch_id", "NOT EXISTS (FROM seen s WHERE s.batch_id = u.batch_id AND s.user_id = u.user_id AND s.item_id = i.item_id)")}"""


def _unseen_by_batch(spark: SparkSession, sf_dir: str, find: Finder) -> DataFrame:
    path = new_scratch(spark, "unseen")
    stream = _batches(spark, sf_dir, _in_order(spark, sf_dir))
    handler = UnseenHandler(find, write_batch(f"{path}/out"))
    run_to_end(
        [for_each_batch(stream, "unseen", handler, f"{path}/checkpoint", ONCE_THROUGH, "append")]
    )
    return _two_digits(spark.read.parquet(f"{path}/out").where("batch_id >= 0"))


@_register(_UNSEEN_BY_BATCH)
def stream_unseen_searched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best unseen items of the users of each of several batches, searched in factors."""
    search = FactorSearch(*_factors(spark, sf_dir))
    return _unseen_by_batch(spark, sf_dir, SearchUnseen(search))


@_register(_UNSEEN_BY_BATCH)
def stream_unseen_looked_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, looked up in lists of 30 items saved once."""
    users, items = _factors(spark, sf_dir)
    search, path = FactorSearch(users, items), new_scratch(spark, "ranked")
    save_ranked(search.lists(users.select(F.col("id").alias("user_id")), 30, 2), path, 30, 2)
    return _unseen_by_batch(spark, sf_dir, LookUpUnseen(spark, path, search))


# --- Whole jobs -----------------------------------------------------------------


@_register(
    f"""WITH {_RATINGS}
SELECT round(count(*)::DOUBLE, 4) AS n, round(avg(rating::DOUBLE), 4) AS mean FROM latest"""
)
def write_read_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named numbers through the metrics table."""
    path = new_scratch(spark, "metrics")
    measured = profiling.rating_summary(_clean(spark, sf_dir)).first()
    write_metrics(spark, path, n=measured["n"], mean=measured["mean"])
    return spark.read.schema("n double, mean double").json(path)


@_register(
    f"""WITH {_LONG_WINDOWS}
SELECT 'avg_rating_per_item' AS output, count(*) AS n FROM item_metrics {_CLOSED}
UNION ALL SELECT 'alerts/item', count(*) FROM item_alerts {_CLOSED}
UNION ALL SELECT 'alerts/user', count(*) FROM user_alerts {_CLOSED}
UNION ALL SELECT 'raw_events', count(*) FROM valid"""
)
def watch_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that the whole streaming job writes in one pass over the events."""
    path = f"{sf_dir}/events.parquet"
    rows = stream_parquet(spark, path, spark.read.parquet(path).schema)
    out = new_scratch(spark, "watch")
    run_to_end(
        start_watching(
            adapters.envelope_from_events(rows), f"{out}/tables", f"{out}/checkpoints",
            fast=ONCE_THROUGH, slow=ONCE_THROUGH, **LONG,
        )
    )
    tables = ("avg_rating_per_item", "alerts/item", "alerts/user", "raw_events")
    counts = [
        spark.read.parquet(f"{out}/tables/{name}").agg(
            F.lit(name).alias("output"), F.count("*").alias("n")
        )
        for name in tables
    ]
    return reduce(DataFrame.unionAll, counts)
