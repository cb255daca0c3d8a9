"""Toxicity by a chain of linear classifiers.

Categories are predicted one after the other: each model sees the text's features
and the probabilities of the categories before it. The models are fitted on a
bounded sample of labelled documents, where the earlier probabilities come from
models that have not seen the document; every document is then classified.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rateweave.llm.tables import id_text, keep, text_mark

# Category and the condition on the labels that makes it true, in the chain's order.
CATEGORIES = {
    "low_quality": "quality = 0",
    "toxic": "toxic = 1",
    "toxic_low_quality": "toxic = 1 AND quality = 0",
}
VERDICT, THRESHOLD = "toxic", 0.5
SAMPLE = 20_000
# Features kept per category: those most over-represented among its documents.
PER_CATEGORY = 512
FOLDS = 3
STEM = (3, 8)
WORD = re.compile(r"[^\W\d_]+")
DENSE = 4
MOST_CACHED = 1 << 18


def word_features(word: str) -> tuple[int, ...]:
    """Hashes of a word and of its beginnings, as signed 64 bits."""
    names = ["=" + word] + [word[:n] + "*" for n in range(STEM[0], min(STEM[1] + 1, len(word)))]
    return tuple(
        h - (1 << 64) if h >> 63 else h
        for h in (xxhash.xxh64_intdigest(n.encode("utf-8", "surrogatepass")) for n in names)
    )


def capitals(text: str) -> int:
    """Upper-case characters of the whole text."""
    return sum(text.count(c) for c in set(text) if c.isupper())


def dense_features(text: str, words: list[str], distinct: int) -> list[float]:
    """Shares of symbols and capitals, repetition of words, and one for all texts."""
    size = max(1, len(text))
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return [
        min(1.0, 10 * symbols / size),
        capitals(text) / size,
        1 - distinct / max(1, len(words)),
        1.0,
    ]


def _count(batches: Iterator[pd.DataFrame], n_labels: int) -> Iterator[pd.DataFrame]:
    counts: dict[int, np.ndarray] = {}
    for batch in batches:
        for text, labels in zip(batch.text, batch.labels, strict=True):
            own = np.array([1, *[v > 0 for v in labels]], np.int64)
            words = set(WORD.findall((text or "").lower()))
            for key in {f for word in words for f in word_features(word)}:
                if key in counts:
                    counts[key] += own
                else:
                    counts[key] = own.copy()
            if len(counts) > 4 * MOST_CACHED:
                yield _counted(counts, n_labels)
                counts = {}
    yield _counted(counts, n_labels)


def _counted(counts: dict[int, np.ndarray], n_labels: int) -> pd.DataFrame:
    values = np.array(list(counts.values()), np.int64).reshape(len(counts), 1 + n_labels)
    columns = {"n": values[:, 0]} | {f"n{i}": values[:, 1 + i] for i in range(n_labels)}
    return pd.DataFrame({"key": np.fromiter(counts, np.int64, len(counts)), **columns})


def _present(texts: list[str | None], place: dict[int, int]) -> Iterator[tuple[list[int], list[float]]]:
    """Places of the selected features that each text has, and its dense features."""
    cache: dict[str, tuple[int, ...]] = {}
    for text in texts:
        text = text or ""
        words = WORD.findall(text.lower())
        distinct = set(words)
        found: set[int] = set()
        for word in distinct:
            own = cache.get(word)
            if own is None:
                if len(cache) > MOST_CACHED:
                    cache.clear()
                own = cache[word] = tuple(place[f] for f in word_features(word) if f in place)
            if own:
                found.update(own)
        yield sorted(found), dense_features(text, words, len(distinct))


def _describe(batches: Iterator[pd.DataFrame], place: dict[int, int]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = list(_present(batch.text.tolist(), place))
        batch["sparse"], batch["dense"] = [r[0] for r in rows], [r[1] for r in rows]
        yield batch[["doc_id", "text_mark", "labels", "sparse", "dense"]]


class Rows(NamedTuple):
    """Sparse and dense features of some documents."""

    doc: np.ndarray  # document of each sparse feature
    place: np.ndarray  # which feature
    dense: np.ndarray
    n_places: int

    def times(self, weights: np.ndarray) -> np.ndarray:
        hit = np.bincount(self.doc, weights[self.place], len(self.dense))
        return hit + self.dense @ weights[self.n_places :]

    def back(self, values: np.ndarray) -> np.ndarray:
        hit = np.bincount(self.place, values[self.doc], self.n_places)
        return np.concatenate([hit, values @ self.dense])

    def with_columns(self, columns: list[np.ndarray]) -> Rows:
        return self._replace(dense=np.column_stack([self.dense, *columns]))

    def pick(self, chosen: np.ndarray) -> Rows:
        to = np.cumsum(chosen) - 1
        own = chosen[self.doc]
        return Rows(to[self.doc[own]], self.place[own], self.dense[chosen], self.n_places)


def gather(sparse: list, dense: list, n_places: int) -> Rows:
    sizes = [len(s) for s in sparse]
    flat = np.concatenate([np.asarray(s, np.int64) for s in sparse]) if sparse else np.zeros(0, np.int64)
    table = np.array([list(d) for d in dense], float).reshape(len(dense), DENSE)
    return Rows(np.repeat(np.arange(len(sizes)), sizes), flat, table, n_places)


def probability(score: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(score, -30, 30)))


def fit(rows: Rows, goal: np.ndarray, rounds: int = 150, penalty: float = 0.3) -> np.ndarray:
    """Logistic regression by accelerated gradient steps with per-feature step sizes."""
    width = rows.n_places + rows.dense.shape[1]
    weights = np.zeros(width)
    # How often a feature occurs, times the features per document, bounds the curvature.
    per_doc = np.bincount(rows.doc, minlength=len(rows.dense)) + np.abs(rows.dense).sum(axis=1)
    curve = np.concatenate([
        np.bincount(rows.place, per_doc[rows.doc], rows.n_places), per_doc @ np.abs(rows.dense)
    ]) / 4 + penalty
    ahead, momentum = weights, 1.0
    for _ in range(rounds):
        gradient = rows.back(probability(rows.times(ahead)) - goal) + penalty * ahead
        new = ahead - gradient / curve
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = new + (momentum - 1) / following * (new - weights)
        weights, momentum = new, following
    return weights


def fit_chain(rows: Rows, labels: np.ndarray, folds: int = FOLDS) -> list[np.ndarray]:
    """Weights of each category's model; earlier probabilities are out of fold.

    A label of -1 is unknown: its row takes no part in fitting that category.
    """
    fold = np.arange(len(labels)) % folds
    chain, earlier = [], []
    for c in range(labels.shape[1]):
        seen, goal, known = rows.with_columns(earlier), labels[:, c].astype(float), labels[:, c] >= 0
        unseen = np.zeros(len(goal))
        for f in range(folds):
            if (fold == f).any():
                others = known & (fold != f)
                model = fit(seen.pick(others), goal[others])
                unseen[fold == f] = probability(seen.pick(fold == f).times(model))
        chain.append(fit(seen.pick(known), goal[known]))
        earlier.append(unseen)
    return chain


def predict_chain(rows: Rows, chain: list[np.ndarray]) -> list[np.ndarray]:
    earlier: list[np.ndarray] = []
    for weights in chain:
        earlier.append(probability(rows.with_columns(earlier).times(weights)))
    return earlier


class Model(NamedTuple):
    categories: tuple[str, ...]
    place: dict[int, int]
    chain: list[np.ndarray]


def train(
    docs: DataFrame,
    labels: DataFrame,
    categories: dict[str, str] = CATEGORIES,
    sample: int = SAMPLE,
    per_category: int = PER_CATEGORY,
) -> Model:
    """Fit the chain on at most ``sample`` labelled documents, those of least hash.

    A category that the labels leave open (null) for a document learns nothing from
    it, the other categories do; a document without any is unlabelled. Of repeated
    labels the largest count, of documents with one id and text one row does, and of
    those that share an id, and so may be many, the texts of least hash within
    ``sample``. Without labels every probability is one half.
    """
    names = [f"n{i}" for i in range(len(categories))]
    marks = labels.select(
        id_text("doc_id"),
        *[F.expr(f"CAST({rule} AS INT)").alias(n) for n, rule in zip(names, categories.values(), strict=True)],
    ).dropna(subset=["doc_id"]).dropna(how="all", subset=names)
    marks = marks.groupBy("doc_id").agg(
        F.array(*[F.coalesce(F.max(n), F.lit(-1)) for n in names]).alias("labels")
    )
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(id_text("doc_id"), "text", text_mark().alias("text_mark")).dropna(subset=["doc_id"])
    labelled = texts.join(F.broadcast(marks), "doc_id")
    # Ids and marks alone decide which rows are taken: no text is shuffled.
    rows = labelled.groupBy("doc_id", "text_mark").count()
    order = (F.xxhash64("doc_id"), "doc_id", "text_mark")
    rows = rows.orderBy(*order).limit(sample).select("doc_id", "text_mark")
    chosen = labelled.join(F.broadcast(rows), ["doc_id", "text_mark"], "left_semi")
    one = Window.partitionBy("doc_id", "text_mark").orderBy("text")
    chosen = chosen.withColumn("row", F.row_number().over(one)).where("row = 1").drop("row")
    chosen = keep(chosen, "toxic-sample")

    n = len(categories)
    schema = "key long, n long, " + ", ".join(f"{x} long" for x in names)
    counts = chosen.select("text", "labels").mapInPandas(lambda it: _count(it, n), schema)
    counts = counts.groupBy("key").agg(F.sum("n").alias("n"), *[F.sum(x).alias(x) for x in names])
    counts = keep(counts, "toxic-counts")
    totals = chosen.agg(
        F.count("*").alias("n"), *[F.count_if(F.get("labels", F.lit(i)) > 0).alias(x) for i, x in enumerate(names)]
    ).first()
    place: dict[int, int] = {}
    for x in names:
        share = (totals[x] or 0) / max(1, totals.n)
        expected = F.col("n") * share
        over = (F.col(x) - expected) / F.sqrt(expected + 1)
        best = counts.where(over > 2).orderBy(F.desc(over), "key").limit(per_category)
        for row in best.select("key").collect():
            place.setdefault(row.key, len(place))
    described = chosen.mapInPandas(
        lambda it: _describe(it, place),
        "doc_id string, text_mark long, labels array<int>, sparse array<int>, dense array<double>",
    )
    rows = described.orderBy(F.xxhash64("doc_id"), "doc_id", "text_mark").collect()
    features = gather([r.sparse for r in rows], [r.dense for r in rows], len(place))
    marked = np.array([list(r.labels) for r in rows], int).reshape(len(rows), n)
    return Model(tuple(categories), place, fit_chain(features, marked))


def _classify(batches: Iterator[pd.DataFrame], model: Model) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = list(_present(batch.text.tolist(), model.place))
        features = gather([r[0] for r in rows], [r[1] for r in rows], len(model.place))
        chances = predict_chain(features, model.chain)
        yield pd.DataFrame({"doc_id": batch.doc_id} | {
            f"p_{c}": p for c, p in zip(model.categories, chances, strict=True)
        })


def _without_toxic(batches: Iterator[pa.RecordBatch], model: Model, threshold: float):
    verdict = model.categories.index(VERDICT)
    for batch in batches:
        rows = list(_present(batch.column("text").to_pylist(), model.place))
        features = gather([r[0] for r in rows], [r[1] for r in rows], len(model.place))
        yield batch.filter(pa.array(predict_chain(features, model.chain)[verdict] <= threshold))


def without_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all columns, that :func:`classify` does not reject."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))
    return docs.mapInArrow(
        lambda it: _without_toxic(it, Model(*shared.value), threshold), docs.schema
    )


def classify(docs: DataFrame, model: Model, key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """Probability of each category and the verdict for each document.

    Takes ``key`` (an integer) and ``text``; other columns are ignored. Gives one row
    per input row: the key, ``p_<category>`` and ``toxic``, whether the verdict's
    probability is above ``threshold``. A null or empty text has no words; repeated
    rows and null keys keep their rows; an empty table gives none.
    """
    # A plain tuple: broadcast values are pickled by reference to their classes.
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))
    chances = [f"p_{c}" for c in model.categories]
    scored = docs.select(id_text(key).alias("doc_id"), "text").mapInPandas(
        lambda it: _classify(it, Model(*shared.value)), "doc_id string, " + ", ".join(f"{c} double" for c in chances)
    )
    return scored.select(
        F.col("doc_id").cast("long").alias(key), *chances, (F.col(f"p_{VERDICT}") > threshold).alias("toxic")
    )
