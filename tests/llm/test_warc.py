import gzip
import hashlib

import duckdb
import pytest

from pyarrow import fs

from rateweave.llm import warc
from rateweave.llm.queries import ORACLES, op8_write_archives
from rateweave.session import new_scratch


def archives(manifest, folder):
    store, root = fs.FileSystem.from_uri(folder)
    names = sorted(r.name for r in manifest.collect())
    return {n: store.open_input_stream(f"{root}/{n}", compression=None).read() for n in names}


def test_pages_come_back_whole(spark, small_dir):
    pages = spark.read.parquet(f"{small_dir}/pages.parquet")
    more = pages.limit(20).selectExpr("page_id + 100000 AS page_id", "url", "html")
    pages = pages.unionByName(more)
    folder = new_scratch(spark, "warc-pages")
    manifest = warc.write_archives(pages, folder, shard_bytes=100_000, file_bytes=20_000)
    files = archives(manifest, folder)
    assert len(files) > 5
    for row in manifest.collect():
        assert hashlib.sha256(files[row.name]).hexdigest() == row.sha256 and len(files[row.name]) == row.bytes
        assert gzip.decompress(files[row.name]).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
        assert row.bytes <= 20_000 or row.records == 1
    first, texts = {}, {}
    for page_id, url, html in sorted(pages.collect()):
        first.setdefault(html, page_id)
        texts[page_id] = (url, html)
    got = warc.read_archives(manifest, folder).collect()
    assert sorted(r.page_id for r in got) == sorted(texts)
    for row in got:
        url, html = texts[row.page_id]
        payload = html.encode()
        again = first[html] != row.page_id and len(payload) >= 100
        assert row.url == url and row.record_type == ("revisit" if again else "response")
        assert row.refers_to == (first[html] if again else None)
        assert row.payload == (None if again else payload)
        assert (row.payload_bytes, row.payload_digest) == (len(payload), hashlib.sha256(payload).hexdigest())
    assert sum(r.record_type == "revisit" for r in got) >= 20


def test_the_same_pages_give_the_same_archives(spark, small_dir):
    pages = spark.read.parquet(f"{small_dir}/pages.parquet")
    both = []
    for _ in range(2):
        folder = new_scratch(spark, "warc-again")
        both.append(archives(warc.write_archives(pages, folder, shard_bytes=200_000), folder))
    assert both[0] == both[1]


def test_a_repeated_commit_changes_nothing(spark, small_dir):
    pages = spark.read.parquet(f"{small_dir}/pages.parquet")
    folder = new_scratch(spark, "warc-commit")
    manifest = warc.write_archives(pages, folder)
    before = archives(manifest, folder)
    list(warc._commit(iter([manifest.toPandas()]), folder))
    assert archives(manifest, folder) == before


def headers(member):
    return dict(line.split(": ", 1) for line in member.partition(b"\r\n\r\n")[0].decode().split("\r\n")[1:])


def test_every_revisit_names_a_response(spark):
    rows = [(i % 7, f"u{i}", "x" * (100 + i % 5)) for i in range(60)] + [(None, "n", "x" * 102)]
    folder = new_scratch(spark, "warc-revisits")
    manifest = warc.write_archives(
        spark.createDataFrame(rows, "page_id long, url string, html string"), folder, shard_bytes=500, file_bytes=900
    )
    store, root = fs.FileSystem.from_uri(folder)
    found = [headers(m) for r in manifest.collect() for m in warc.members(store, f"{root}/{r.name}")]
    found = [h for h in found if h["WARC-Type"] != "warcinfo"]
    names = {h["WARC-Record-ID"]: h for h in found}
    assert len(names) == len(found) == 61
    revisits = [h for h in found if h["WARC-Type"] == "revisit"]
    assert len(revisits) == 61 - 5
    for h in revisits:
        target = names[h["WARC-Refers-To"]]
        assert target["WARC-Type"] == "response" and target["Page-ID"] == h["Refers-To-Page"]
        assert target["WARC-Payload-Digest"] == h["WARC-Payload-Digest"]


def test_many_files_are_read_by_many_tasks_and_only_listed_ones(spark):
    pages = spark.range(500).selectExpr("id AS page_id", "'u' AS url", "concat(repeat('x', 90), id, repeat('y', 20)) AS html")
    folder = new_scratch(spark, "warc-many")
    manifest = warc.write_archives(pages, folder, file_bytes=1)
    assert manifest.count() == 500
    records = warc.read_archives(warc.committed(spark, folder), folder)
    assert records.rdd.getNumPartitions() >= 4 and records.count() == 500
    assert warc.dealt_by_size(manifest, 10_000).rdd.getNumPartitions() > 10
    store, root = fs.FileSystem.from_uri(folder)
    for name in ("part-000009-000000.warc.gz", "part-000000-000000.warc.gz.0.tmp"):
        with store.open_output_stream(f"{root}/{name}", compression=None) as out:
            out.write(b"lost")
    assert sorted(r.name for r in warc.left_over(spark, folder).collect()) == [
        "part-000000-000000.warc.gz.0.tmp", "part-000009-000000.warc.gz",
    ]
    assert warc.read_archives(warc.committed(spark, folder), folder).count() == 500
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        warc.write_archives(pages, folder)


def test_repeated_and_null_ids_are_as_in_sql(spark, tmp_path):
    big = "a" * 100
    rows = [(1, "u", big), (1, "u", big), (1, "v", big + "b"), (2, "u", big), (None, "u", big), (None, "u", big + "c"),
            (None, "u", big + "c"), (None, None, None), (3, "u", big + "b"), (3, "u", "s"), (3, "u", "s")]
    path = str(tmp_path / "pages.parquet")
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(path)
    database = duckdb.connect()
    database.execute(f"CREATE VIEW pages AS SELECT * FROM '{path}/*.parquet'")
    want = database.execute(ORACLES["op8_write_archives"]).fetchall()
    got = [tuple(r) for r in op8_write_archives(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
