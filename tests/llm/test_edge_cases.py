"""Every operator on nulls, empty and long texts, repeated rows, clashing columns, empty tables."""

import pytest
from pyspark.sql import functions as F

from rateweave.llm import (
    hmm, kdtree, mixing, negatives, packing, phrases, pii, quality, secrets, simhash, toxicity, urls, warc,
)
from rateweave.session import new_scratch

LONG = "lorem ipsum dolor " * 20_000
ODD = [
    (1, "one two three four", "a"), (1, "one two three four", "a"), (2, "", "a"), (3, None, None),
    (None, "one two three four", "b"), (None, None, "b"), (4, LONG, "c"), (5, "\t \n", "c"),
    (2**60 + 1, "password = hunter22 mail a@b.co", None),
]
CLASHING = (
    "size", "rank", "leaf", "place", "row", "fp", "root", "node", "n", "c", "block", "key", "labels", "kept_id",
    "first", "length", "base", "weak", "t", "text_mark", "found", "target", "shard", "group", "word", "times",
)


def documents(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return docs.withColumns({c: F.lit(f"mine {c}") for c in CLASHING})


def labels(spark, rows=((1, 1, 0), (4, 0, 1), (None, 1, 1), (2, None, None))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def judged_toxic(docs):
    return toxicity.classify(docs, toxicity.train(docs, labels(docs.sparkSession)))


OPERATORS = {
    "hmm": hmm.score,
    "simhash": simhash.near_duplicates,
    "packing": packing.pack,
    "secrets": secrets.find_secrets,
    "quality": lambda docs: quality.judge(docs, labels(docs.sparkSession).where("quality = 1")),
    "toxicity": judged_toxic,
    "pii": lambda docs: pii.digests(pii.find_personal_data(docs)),
    "mixing": mixing.mix,
}


def write_pages(spark):
    pages = spark.createDataFrame([(1, "u", "a" * 100), (2, "u", "a" * 100)], "page_id long, url string, html string")
    folder = new_scratch(spark, "warc-few")
    return warc.read_archives(warc.write_archives(pages, folder), folder)


def search_few(spark):
    return kdtree.top_k(spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>"))


def mine_few(spark):
    rows = [(0, [1.0], 1), (1, [2.0], 1), (2, [1.0], 2)]
    return negatives.mine(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))


def judge_few(spark):
    pages = spark.createDataFrame([(1, "http://a.org/"), (2, None)], "page_id long, url string")
    rules = spark.createDataFrame([("org", "/", "allow")], "host string, path string, verdict string")
    return urls.blocked_out(urls.judge(pages, rules).join(pages, "page_id").select(pages.columns), rules)


def phrases_of_few(spark):
    return phrases.collocations(spark.createDataFrame([("en", "a b c d")] * 9, "lang string, text string"), least=3)


# Operators on other tables than documents, or with other results.
TABLES = {
    "warc": write_pages, "kdtree": search_few, "negatives": mine_few, "urls": judge_few, "phrases": phrases_of_few,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_each_give_a_result(spark, name):
    out = OPERATORS[name](documents(spark, ODD)).collect()
    assert all("mine" not in str(row) for row in out)
    if name == "packing":
        out = [row for row in out if row.piece == 0]
    ids = sorted((r.doc_id for r in out), key=lambda i: (i is None, i))
    assert ids == sorted((r[0] for r in ODD), key=lambda i: (i is None, i))


@pytest.mark.parametrize("name", OPERATORS)
def test_an_empty_table_gives_no_rows(spark, name):
    assert OPERATORS[name](documents(spark, [])).collect() == []


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [1.0, 2.0]), (3, None), (4, [nan, 1.0]),
        (5, [inf, 1.0]), (6, [None, 1.0]), (None, [1.0, 1.0]), (7, []), (8, [1.0]), (200, [3.0, 0.0]),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    table = table.withColumns({c: F.lit("mine") for c in ("dim", "shard", "v", "score", "rank")})
    got = sorted(tuple(r) for r in kdtree.top_k(table).collect())
    k = 1024 * 1024
    assert got == [
        (0, 1, 200, 3 * k), (0, 2, 1, k), (0, 3, 2, k),
        (200, 1, 0, 3 * k), (200, 2, 0, 3 * k), (200, 3, 1, 3 * k), (200, 4, 2, 3 * k),
    ]
    assert kdtree.top_k(table.limit(0)).collect() == []


def test_odd_pages(spark):
    big = "x" * 300_000
    rows = [
        (1, "u", "a" * 100), (2, None, "a" * 100), (2, None, "a" * 100), (3, "u", "short"), (4, "u", "short"),
        (5, "u\r\nX: y", None), (None, "u", "a" * 100), (None, None, None), (6, "é", big), (7, "", ""),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages = pages.withColumns({c: F.lit("mine") for c in ("digest", "first", "bytes", "name", "n")})
    folder = new_scratch(spark, "warc-odd")
    manifest = warc.write_archives(pages, folder)
    got = warc.read_archives(manifest, folder).collect()
    assert len(got) == len(rows)
    kinds = sorted((r.page_id or -1, r.record_type, r.refers_to, r.payload_bytes) for r in got)
    assert kinds == sorted([
        (1, "response", None, 100), (2, "revisit", 1, 100), (2, "revisit", 1, 100), (3, "response", None, 5),
        (4, "response", None, 5), (5, "response", None, 0), (-1, "revisit", 1, 100), (-1, "response", None, 0),
        (6, "response", None, 300_000), (7, "response", None, 0),
    ])
    empty = new_scratch(spark, "warc-empty")
    assert warc.read_archives(warc.write_archives(pages.limit(0), empty), empty).collect() == []


def test_filters_keep_clashing_columns(spark):
    docs = documents(spark, ODD)
    clean = toxicity.without_toxic(docs, toxicity.train(docs, labels(spark)))
    assert clean.columns == docs.columns
    once = simhash.one_of_each(docs)
    assert once.columns == docs.columns
    assert sorted(once.toPandas().text.fillna("").str[:5]) == ["", "lorem", "one t", "passw"]
    hidden = secrets.hide_secrets(docs)
    assert hidden.columns == docs.columns and hidden.count() == len(ODD)
    assert hidden.where("text LIKE '%hunter22%'").count() == 0
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns


def test_filters_of_an_empty_table(spark):
    docs = documents(spark, [])
    assert toxicity.without_toxic(docs, toxicity.train(documents(spark, ODD), labels(spark))).collect() == []
    for step in (simhash.one_of_each, secrets.hide_secrets, mixing.mixed):
        out = step(docs)
        assert out.columns == docs.columns and out.collect() == []


def hot_documents(spark):
    """4,500 rows, a third of them one row."""
    return spark.range(4500).selectExpr(
        "if(id % 3 = 0, 7, id + 10) AS doc_id",
        "if(id % 3 = 0, 'a row that comes again', concat('words of ', hex(xxhash64(id)), repeat(' w', id % 9))) AS text",
        "if(id % 3 = 0, 'hot', concat('s', id % 2)) AS source",
    )


def test_a_hot_row_is_dealt_to_many_leaves(spark, monkeypatch):
    docs, real, leaves = hot_documents(spark), mixing.keep, []

    def watched(frame, label, *more):
        out = real(frame, label, *more)
        if label == "mix-leaves":
            leaves.extend(r["count"] for r in out.groupBy("leaf").count().collect())
        return out

    monkeypatch.setattr(mixing, "keep", watched)
    got = mixing.mix(docs, leaf_rows=300).collect()
    assert len(got) == sum(leaves) == 4500 and max(leaves) < 1000
    for source in ("hot", "s0", "s1"):
        rows = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= max(r["size"] for r in rows)
    again = sorted(map(tuple, mixing.mix(docs.repartition(5), leaf_rows=300).collect()))
    assert sorted(map(tuple, got)) == again
    copies = {r.doc_id: r["count"] for r in mixing.mixed(docs).groupBy("doc_id").count().collect()}
    assert copies[7] == sum(r.copies for r in mixing.mix(docs).collect() if r.doc_id == 7) > 500


def test_a_hot_row_is_packed_row_by_row(spark):
    got = packing.pack(hot_documents(spark), rank_rows=200).collect()
    assert len(got) == 4500 and sum(r.doc_id == 7 for r in got) == 1500
    held = {}
    for r in got:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(held) == -(-sum(r.length for r in got) // 2048)


def test_a_hot_row_is_kept_once(spark):
    docs = hot_documents(spark).withColumn("mine", F.lit(1))
    once = simhash.one_of_each(docs)
    assert once.where("doc_id = 7").count() == 1 and once.columns == docs.columns
    assert {r.doc_id for r in once.collect()} == {
        r.component_id for r in simhash.near_duplicates(docs).select("component_id").distinct().collect()
    }
