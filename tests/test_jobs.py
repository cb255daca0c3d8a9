import pytest

from rateweave import session
from rateweave.jobs import main, parser
from rateweave.operators.cleaning import clean, parse_rating_lines, preprocess_funnel
from rateweave.plans.clean_ratings import clean_ratings
from rateweave.plans.train_model import precompute_recommendations
from rateweave.operators import model as m
from rateweave.sinks.models import save_model
from rateweave.sinks.tables import kafka_writer_options
from rateweave.sources.adapters import rating_lines
from rateweave.sources.models import read_recommendations
from rateweave.sources.ratings import read_rating_lines, read_ratings

from .conftest import rows


def test_clean_job(spark, small_dir, tmp_path):
    text, out = str(tmp_path / "lines"), str(tmp_path / "ratings")
    rating_lines(spark, small_dir).write.text(text)
    report = clean_ratings(spark, text, out)
    lines = read_rating_lines(spark, text)
    assert rows(read_ratings(spark, out)) == rows(clean(lines))
    # Counted from the written table, the funnel is that of the one-pass operator.
    assert rows(report.funnel) == rows(preprocess_funnel(parse_rating_lines(lines)))
    assert report.cardinality.first().n_ratings == report.summary.first().n
    assert sum(r["count"] for r in report.distribution.collect()) == report.summary.first().n


def test_clean_job_from_the_command_line(spark, small_dir, tmp_path, capsys):
    text, out = str(tmp_path / "lines"), tmp_path / "ratings"
    rating_lines(spark, small_dir).write.text(text)
    main(["clean", "--lines", text, "--ratings", str(out), "--files", "4"])
    assert len(list(out.glob("*.parquet"))) == 4
    shown = capsys.readouterr().out
    for column in ("duplicate_dropped", "sparsity", "stddev", "count"):
        assert column in shown


def test_precomputed_candidates_are_one_row_per_user(spark, small_dir, tmp_path):
    model, out = str(tmp_path / "model"), str(tmp_path / "candidates")
    ratings = clean(rating_lines(spark, small_dir))
    save_model(m.fit_als(ratings, m.AlsConfig(rank=2, max_iter=1)), model)
    precompute_recommendations(model, out, top_n=2, over_fetch=3)
    found = read_recommendations(spark, out)
    assert found.count() == found.select("user_id").distinct().count()
    assert {len(r.recommendations) for r in found.collect()} == {6}


@pytest.mark.parametrize(
    "line",
    [
        "clean --lines a --ratings b --files 4",
        "train --ratings a --model b --metrics c --blocks 20",
        "precompute --model a --candidates b",
        "publish --ratings a --servers s --topic t --partitions 2",
        "watch --servers s --topic t --out o --checkpoints c --model m --min-partitions 2",
        "watch --servers s --topic t --out o --checkpoints c --fail-on-data-loss "
        "--option kafka.security.protocol=SSL --option a=b=c",
    ],
)
def test_command_lines(line):
    assert callable(parser().parse_args(line.split()).run)


def test_connector_options_on_the_command_line():
    line = "publish --ratings a --servers s --topic t --option kafka.acks=1 --option x=y=z"
    args = parser().parse_args(line.split())
    options = kafka_writer_options(args.servers, args.topic, dict(args.option))
    assert (options["kafka.acks"], options["x"], options["topic"]) == ("1", "y=z", "t")
    with pytest.raises(SystemExit):
        parser().parse_args([*line.split(), "--option", "none"])


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_dir(spark) == named
    assert session.new_scratch(spark, "x").startswith(f"{named}/x-")
    session.ensure_checkpoint_dir(spark)
    assert named in spark.sparkContext.getCheckpointDir()


class _Cluster:
    """A session on a cluster that names no shared folder."""

    class conf:
        @staticmethod
        def get(key, default):
            return default

    class sparkContext:
        master = "spark://head:7077"


@pytest.mark.parametrize("master", ["spark://head:7077", "local-cluster[2,1,1024]", "yarn"])
def test_no_machine_local_folder_on_a_cluster(monkeypatch, master):
    monkeypatch.setattr(_Cluster.sparkContext, "master", master)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(_Cluster)


def test_partitions_follow_the_input():
    gb = 1 << 30
    initial, split = session.INITIAL_PARTITIONS, session.SPLIT_BYTES
    small = session.partition_plan(10 * session.MB, 200)
    assert (small[initial], small[split]) == ("200", str(128 * session.MB))
    assert session.partition_plan(100 * gb, 200)[initial] == "800"
    huge = session.partition_plan(100 * 1024 * gb, 200)
    assert (huge[initial], huge[split]) == ("819200", str(128 * session.MB))
    coarse = session.partition_plan(100 * 1024 * gb, 200, gb)
    assert (coarse[initial], coarse[split]) == ("102400", str(gb))
    # A setting above the bound is the user's choice.
    assert session.partition_plan(gb, 50_000)[initial] == "50000"


def test_sizing_reads_file_sizes_and_restores_settings(spark, tmp_path):
    path = str(tmp_path / "lines")
    spark.range(1000).selectExpr("string(id) AS value").coalesce(1).write.text(path)
    scan = read_rating_lines(spark, path)
    assert session.scan_bytes(scan) == 3890
    before = spark.conf.get(session.SPLIT_BYTES)
    with session.sized_for(scan):
        assert spark.conf.get(session.INITIAL_PARTITIONS) == "4"
    assert spark.conf.get(session.INITIAL_PARTITIONS, None) is None
    assert spark.conf.get(session.SPLIT_BYTES) == before
