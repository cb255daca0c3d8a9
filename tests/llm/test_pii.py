import hashlib
import math
import random
import re

import pytest

from rateweave.llm import pii


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def digits(match):
    return re.sub("[^0-9]", "", match[0])


# Fixed patterns of the strict kinds, as they are defined, and what a match must meet.
STRICT = (
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
    (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
    (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
)


def strict_spans(text):
    found = [
        (m.start(), kind, m.end())
        for kind, (pattern, good) in enumerate(STRICT)
        for m in re.finditer(pattern, text)
        if good(m)
    ]
    return sorted(found)


def joined(spans):
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def test_strict_spans_equal_the_patterns(spark, small_dir):
    random.seed(3)
    parts = [
        "a", "B.", "@", "b-", "._", "%", "1", "22", "255", ".", ".", " ", "-", "  ", "+", "+49", "(", "é", "\n",
        "4111111111111111", "4111 1111 1111 1111", "\U0001f600", "x@y.z", "1.2.3.4", "\x01", "_", "0300",
    ]
    texts = ["".join(random.choices(parts, k=random.randint(0, 60))) for _ in range(1500)]
    texts += [
        "1 " * 30_000, "a.b@" + "c." * 20_000 + "d", "7" * 50_000, "+1" + "-1" * 20_000, "a@b.c " * 5000,
        "é 10.0.0.1 " * 3000,
    ]
    texts += [r.text for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = pii.digests(pii.find_personal_data(docs)).collect()
    assert len(got) == len(texts)
    for row in got:
        spans = strict_spans(texts[row.doc_id])
        assert row.base_sha256 == hashlib.sha256(joined(spans).encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [
            sum(k == kind for _, k, _ in spans) for kind in range(4)
        ]
        assert {f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans} <= set(row.spans.split(",")) or not spans


def test_candidates_are_accepted_by_their_context(spark):
    good = "please phone 415-555-0132 or, with ssn 123-45-6789, write"
    bad = "order 915-115-0132 and part 987-65-0000 arrived"
    docs = spark.createDataFrame(
        [(i, f"{good} no {i}") for i in range(60)] + [(100 + i, f"{bad} no {i}") for i in range(60)],
        "doc_id long, text string",
    )
    got = {r.doc_id: r.spans for r in pii.digests(pii.find_personal_data(docs)).collect()}
    assert got[0] == "local_phone:13:25,national_id:39:50"
    assert got[100] == ""


def test_reliabilities_are_recovered():
    random.seed(8)
    right = [(0.9, 0.05), (0.8, 0.2), (0.7, 0.1)]
    counts, truth = {}, {}
    for _ in range(20_000):
        true = random.random() < 0.4
        votes = tuple(int(random.random() < r[0 if true else 1]) for r in right)
        counts[votes] = counts.get(votes, 0) + 1
        truth[votes] = truth.get(votes, 0) + true
    patterns = [pii.Vote(4, v, n) for v, n in sorted(counts.items())]
    for p, post in zip(patterns, pii.posteriors(patterns), strict=True):
        assert post == pytest.approx(truth[p.votes] / p.n, abs=0.15)


def drawn_numbers(n, rng):
    """Texts with a number each, whether it is a phone number, and where it stands.

    Labelers err often and independently; the characters around a number tell more.
    """
    out = []
    for i in range(n):
        true = rng.random() < 0.5
        area = "313" if rng.random() < (0.9 if true else 0.5) else "113"
        middle = "555" if rng.random() < (0.7 if true else 0.25) else "444"
        cue = "call" if rng.random() < (0.6 if true else 0.2) else "take"
        lead, tail = ("no: ", "\n") if rng.random() < (0.9 if true else 0.1) else ("no ", "/b")
        out.append((i, f"{cue} {lead}{area}-{middle}-{rng.randint(1000, 9999)}{tail}", true))
    return out


def test_the_classifier_beats_the_votes_on_spans_it_has_not_seen(spark):
    rows = drawn_numbers(4000, random.Random(5))
    schema = "doc_id long, text string, truth boolean"

    def spans_of(own):
        docs = spark.createDataFrame(own, schema)
        seen = pii.candidates(docs).withColumn("row", pii.F.col("doc_id"))
        return pii.with_votes(seen, pii.public_codes(spark)), docs.select("doc_id", "truth")

    first, _ = spans_of(rows[:2000])
    model, patterns = pii.fit(first), pii.vote_counts(first)
    post = dict(zip(["".join(map(str, p.votes)) for p in patterns], pii.posteriors(patterns), strict=True))
    spans, truth = spans_of(rows[2000:])
    F = pii.F
    by_votes = F.create_map(*[F.lit(x) for pair in post.items() for x in pair])[F.concat("v0", "v1", "v2")]
    majority = F.col("v0") + F.col("v1") + F.col("v2") >= 2
    held = spans.join(truth, spans.row == truth.doc_id)
    right = lambda said: F.avg((said == F.col("truth")).cast("int"))
    got = held.agg(
        F.count("*").alias("n"), right(majority).alias("majority"), right(by_votes > 0.5).alias("votes"),
        right(pii.odds(model) > 0).alias("both"),
    ).first()
    assert got.n == 2000
    assert got.both > max(got.votes, got.majority) + 0.05
    assert got.both > 0.88


def test_the_gazetteer_grows_with_the_corpus_and_with_a_table(spark):
    text = "mail ada.lovelace@example.org and +1 (628) 200-3000 no"
    docs = spark.createDataFrame([(i, f"{text} {i}") for i in range(3)], "doc_id long, text string")
    seen = pii.candidates(docs).withColumn("row", pii.F.col("doc_id"))
    shown = {(r.kind, r.entry) for r in pii.shown_entries(seen).collect()}
    assert shown == {(8, "ada"), (8, "lovelace"), (4, "628")}
    assert pii.shown_entries(seen, 4).count() == 0

    people = [(i, f"we met Mr Quux, no {i}") for i in range(40)]
    docs = spark.createDataFrame(people, "doc_id long, text string")
    none = pii.digests(pii.find_personal_data(docs, least_votes=2)).collect()
    assert {r.spans for r in none} == {""}
    table = spark.createDataFrame([("person", "quux"), ("nobody", "quux"), (None, None)], "kind string, entry string")
    some = pii.digests(pii.find_personal_data(docs, 0.5, 2, table)).collect()
    assert {r.spans for r in some} == {"person:7:14"}


def test_chances_equal_a_plain_sum(spark):
    spans = [pii.Seen((0, 1, 2, 3, 0), 30, 27.0), pii.Seen((1, 1, 2, 3, 1), 50, 5.0), pii.Seen((1, 2, 0, 3, 0), 20, 9.0)]
    one = pii.train(spans)
    for key in one.added:  # at the optimum no weight has a slope
        slope = sum(
            s.n / (1 + math.exp(-one.always - sum(one.added[k] for k in enumerate(s.traits)))) - s.true
            for s in spans if s.traits[key[0]] == key[1]
        )
        assert slope + 5.0 * one.added[key] == pytest.approx(0, abs=0.05)
    model = pii.Model({4: one}, {(1, 0, 1): 0.7})
    row = spark.range(1).selectExpr(
        "4 as kind", "1 as v0", "0 as v1", "1 as v2", "1 as lead", "1 as front", "2 as tail", "3 as written", "1 as near"
    )
    want = 0.7 + one.always + sum(one.added[k] for k in enumerate((1, 1, 2, 3, 1)))
    assert row.select(pii.odds(model)).first()[0] == pytest.approx(want)


def test_no_python_on_the_main_path(spark, small_dir):
    from tests.conftest import plan_of

    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    for frame in (pii.candidates(docs), pii.digests(pii.find_personal_data(docs))):
        assert not re.search("Python|Pandas|Arrow|ExistingRDD", plan_of(frame))
