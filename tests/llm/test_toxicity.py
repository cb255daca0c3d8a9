import numpy as np
import pytest
from pyspark.sql import functions as F

from rateweave.llm import toxicity


def test_unseen_documents_are_told_apart(spark, small_dir):
    sf = small_dir.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    half = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)) == 0
    model = toxicity.train(docs, labels.where(half))
    got = toxicity.classify(docs, model).join(labels.where(~half).withColumnRenamed("toxic", "label"), "doc_id")
    counts = {(r.label, r.toxic): r["count"] for r in got.groupBy("label", "toxic").count().collect()}
    assert counts.get((0, True), 0) <= 0.02 * counts[0, False]
    assert counts[1, True] >= 0.5 * (counts[1, True] + counts.get((1, False), 0))
    kept = {r.doc_id for r in toxicity.without_toxic(docs, model).collect()}
    assert kept == {r.doc_id for r in toxicity.classify(docs, model).where("NOT toxic").collect()}


def test_capitals_are_counted_over_the_whole_text():
    for text in ("Abcdefghi\n" * 2_000, "aBcdefghi\n" * 2_000, "É\U0001d400ǅ\ud800x" * 300_000, "Ab", ""):
        share = toxicity.dense_features(text, [], 0)[1]
        assert share == sum(map(str.isupper, text)) / max(1, len(text))


def rows_of(n, rng):
    """Two features and noise; the second label follows from the first one."""
    first, second = rng.random(n) < 0.5, rng.random(n) < 0.5
    sparse = [[i for i, on in enumerate((a, b)) if on] for a, b in zip(first, second)]
    labels = np.column_stack([first, first & second]).astype(int)
    return toxicity.gather(sparse, [[0, 0, 0, 1]] * n, 2), labels


def test_later_models_use_earlier_probabilities():
    rows, labels = rows_of(600, np.random.default_rng(1))
    chain = toxicity.fit_chain(rows, labels)
    assert len(chain[1]) == len(chain[0]) + 1
    chances = toxicity.predict_chain(rows, chain)
    for chance, label in zip(chances, labels.T, strict=True):
        assert ((chance > 0.5) == label).all()
    shuffled = [chain[0], chain[1].copy()]
    shuffled[1][-1] = 0
    assert np.abs(toxicity.predict_chain(rows, shuffled)[1] - chances[1]).max() > 0.01


def test_the_fit_is_the_optimum():
    rng = np.random.default_rng(2)
    rows, labels = rows_of(200, rng)
    goal = np.where(rng.random(200) < 0.1, 1 - labels[:, 0], labels[:, 0])
    weights = toxicity.fit(rows, goal, rounds=3000, penalty=1.0)
    gradient = rows.back(toxicity.probability(rows.times(weights)) - goal) + weights
    assert gradient == pytest.approx(np.zeros_like(gradient), abs=1e-3)


def test_open_labels_of_one_category_leave_the_others(spark):
    """The same verdicts whether the quality is known, or null everywhere."""
    bad = "awful nasty vile words here"
    docs = spark.createDataFrame(
        [(i, bad if i % 2 else f"a pleasant walk by the river {i}") for i in range(200)], "doc_id long, text string"
    )
    for quality in ("1", "CAST(NULL AS INT)"):
        labels = docs.selectExpr("doc_id", f"{quality} AS quality", "CAST(doc_id % 2 AS INT) AS toxic")
        got = toxicity.classify(docs, toxicity.train(docs, labels))
        assert got.where("toxic").count() == 100, quality


def test_an_id_shared_by_many_rows_stays_within_the_sample(spark):
    docs = spark.range(300).selectExpr("0L AS doc_id", "concat('text ', id % 150) AS text")
    labels = spark.createDataFrame([(0, 1, 1)], "doc_id long, quality int, toxic int")
    seen = []
    plain = toxicity.fit_chain
    toxicity.fit_chain = lambda rows, marked: seen.append(len(marked)) or plain(rows, marked)
    try:
        toxicity.train(docs, labels, sample=100)
        toxicity.train(docs, labels)
    finally:
        toxicity.fit_chain = plain
    assert seen == [100, 150]


def plain_chain(rows, labels, folds=3):
    """The chain as a loop: fold models by a plain gradient descent on dense features."""

    def table(extra):
        wide = np.zeros((len(labels), rows.n_places))
        wide[rows.doc, rows.place] = 1
        return np.column_stack([wide, rows.dense, *extra])

    def slow_fit(x, y):
        w = np.zeros(x.shape[1])
        for _ in range(20_000):
            w -= 0.002 * (x.T @ (toxicity.probability(x @ w) - y) + 0.3 * w)
        return w

    fold, chain, extra = np.arange(len(labels)) % folds, [], []
    for label in labels.T:
        x, out = table(extra), np.zeros(len(labels))
        for f in range(folds):
            out[fold == f] = toxicity.probability(x[fold == f] @ slow_fit(x[fold != f], label[fold != f]))
        chain.append(slow_fit(x, label))
        extra.append(out)
    return chain


def test_the_chain_equals_a_plain_chain():
    rows, labels = rows_of(300, np.random.default_rng(3))
    got = toxicity.fit_chain(rows, labels)
    for mine, plain in zip(got, plain_chain(rows, labels), strict=True):
        assert mine == pytest.approx(plain, abs=0.02)
