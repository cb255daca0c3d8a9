"""URL filter against a plain reading of the rules, and the digest files by themselves."""

import re

import numpy as np
import pytest

from rateweave.llm import urls
from rateweave.llm.queries import URL_RULES

RULES = [
    *URL_RULES, ("b.org", "/aa", "block"), ("a.b.org", "/", "allow"), ("Shop.com", "", "block"),
    ("x.net", "/é", "block"), ("x.net", "/é", "allow"), (None, "/", "block"), ("", "/", "block"), ("y.net", None, "block"),
    ("z.net", "/1", None),
]
ODD = [
    "https://A.B.org/aab", "http://b.org/aa", "http://b.org/ab", "http://b.org", "http://b.org?x=/aa", "HTTP://B.ORG#/",
    "://org/", "x://", "no scheme", "", None, "http://shop.com", "http://m.shop.com/?q", "http://myshop.com/fr/x",
    "http://x.net/été", "http://x.net/e", "http://.net/", "http://org./", "http://a..org/x://com/fr/", "http://y.net",
    "http://z.net/1", "http://casino.net/", "http://my-casino.org/", "http://casinos.net/", "http://a.com/fr/\n/x",
    "http://CASINO.net", "ftp://u:p@h.com:80/de/1?2#3", "http://free_bets.net/" + "a" * 300_000, "http://" + "a." * 50_000 + "org/es/",
]


def plain(url, rules, words=urls.WORDS):
    lower = str.maketrans(urls.CAPITALS, urls.CAPITALS.lower())
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
        host = host.translate(lower)
    fits = []
    for own, begin, verdict in rules:
        own, begin = (own or "").translate(lower), begin or ""
        if own and verdict and (host == own or host.endswith("." + own)) and path.startswith(begin):
            fits.append((len(own + begin), len(own), verdict, own + begin))
    if fits:
        _, _, verdict, rule = max(fits)
        return host, path, rule, verdict
    return host, path, None, "block" if set(re.split(r"[.\-_]", host)) & set(words) else "allow"


def frames(spark, listed=RULES, addresses=ODD):
    pages = spark.createDataFrame([(i if i % 5 else None, u) for i, u in enumerate(addresses)], "page_id long, url string")
    pages = pages.selectExpr("*", "'mine' AS host", "1 AS rule", "2 AS verdict", "3 AS word")
    return pages, spark.createDataFrame(listed, "host string, path string, verdict string")


@pytest.mark.parametrize("file_entries", [1 << 22, 3])
def test_verdicts_are_those_of_the_rules(spark, file_entries):
    pages, rules = frames(spark, addresses=ODD * 2)
    got = urls.judge(pages, rules, file_entries=file_entries).drop("word").collect()
    want = [(i if i % 5 else None, *plain(u, RULES)) for i, u in enumerate(ODD * 2)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    allowed = urls.blocked_out(pages, rules)
    assert allowed.columns == pages.columns
    assert sorted(map(repr, (r.url for r in allowed.collect()))) == sorted(
        repr(u) for u in ODD * 2 if plain(u, RULES)[3] == "allow"
    )


def test_empty_tables_and_lists(spark):
    pages, rules = frames(spark)
    assert urls.judge(pages.limit(0), rules).collect() == []
    none = spark.createDataFrame([], "word string")
    got = urls.judge(pages, rules.limit(0), none).collect()
    assert len(got) == len(ODD) and all(r.verdict == "allow" and r.rule is None for r in got)


def test_a_list_too_large_for_a_machine_is_refused(spark):
    pages, rules = frames(spark)
    with pytest.raises(ValueError, match="bytes"):
        urls.judge(pages, rules, most_bytes=100)


def test_many_rules(spark):
    listed = [(f"h{i % 700}.net", f"/{i}", "block" if i % 3 else "allow") for i in range(5_000)]
    addresses = [f"http://{'w.' * (i % 3)}h{i % 900}.net/{i}{'/x' * (i % 2)}" for i in range(4_000)]
    pages, rules = frames(spark, listed, addresses)
    got = urls.judge(pages, rules, file_entries=1_000).drop("word").collect()
    by_host = {}
    for rule in listed:
        by_host.setdefault(rule[0], []).append(rule)
    want = [
        (i if i % 5 else None, *plain(u, by_host.get(u.split("/")[2].removeprefix("w.").removeprefix("w."), [])))
        for i, u in enumerate(addresses)
    ]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_strings_that_share_a_key_are_told_apart(tmp_path):
    class Row:
        def __init__(self, key, text, value):
            self.key, self.text, self.value = key, text, value

    rows = [Row(-5, "Ra/", "allow"), Row(7, "Rb/", "block"), Row(7, "Rc/", "allow"), Row(7, "Hlong.host", "1"), Row(9, "Wx", "")]
    part = urls._write(str(tmp_path / "f"), tuple(rows))
    assert part.longest_host == len("long.host")
    opened = urls.Digests(str(tmp_path / "f"), part)
    assert isinstance(opened.keys, np.memmap)
    strings = [b"Rc/", b"Rb/", b"Rd/", b"Wx", b"Ra/"]
    assert opened.find(strings, np.array([7, 7, 7, 9, 5])) == {b"Rc/": "allow", b"Rb/": "block", b"Wx": ""}


def test_keys_are_those_of_sql(spark):
    texts = ["", "a", "Rexample.org/es/", "é" * 50]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("t", "xxhash64(t) AS key")
    assert {r.t: r.key for r in frame.collect()} == dict(zip(texts, urls.digests([t.encode() for t in texts]).tolist()))
