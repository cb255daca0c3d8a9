"""A hidden Markov language model over words, trained by Baum-Welch.

A state emits a class of words and the class a word: words belong to classes by a
hash, the states' emission table has one row per class, and within a class words
have their smoothed share of the corpus counts. The counts, of every word, grow with
the corpus and stay in tables; the number of classes follows the number of different
words up to a bound. Tasks add up expected counts of their documents; the sums make
the next model, until the likelihood of the training texts hardly grows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateweave.llm import words
from rateweave.llm.tables import id_text, keep

STATES = 6
# Classes follow the vocabulary: some so many words share one. The bound keeps what a
# task holds, and sends on after each round, at 3 MB for six states.
WORDS_PER_CLASS = 4
LEAST_CLASS_BITS, MOST_CLASS_BITS = 6, 16
# Sums of so many classes travel together; so many tasks' sums are added at once.
SLAB = 1 << 12
FAN_IN = 1 << 10
# Training ends once a round adds less to the ln-likelihood of a token, and less than
# the round before. Where it starts the states are nearly alike, and the first rounds
# add little before they part: they are no reason to end.
LEAST_GAIN = 0.1
LEAST_ROUNDS = 4
MOST_ROUNDS = 12
LEAST_PRIOR = 1000.0
FOLDS, HELD = 7, 2
# Documents run side by side, token by token. A longer one is cut into stretches of
# so many tokens, which run side by side too.
STRETCH = 2048
GROUP_TOKENS = 1 << 20
BLOCK_CHARS = 1 << 23
END = np.uint64(0x9B05688C2B3E6C1F)
SCALE_EVERY = 8

BLOCK = (
    "block long, doc_ids array<string>, held array<boolean>, sizes array<int>, "
    "vocabulary binary, trained binary, tokens binary"
)
SCORE = (
    "doc_id string, held_out boolean, n_tokens long, n_known long, "
    "base_ln double, model_ln double"
)


class Params(NamedTuple):
    start: np.ndarray  # states
    move: np.ndarray  # states x states
    emit: np.ndarray  # classes x states


class Layout(NamedTuple):
    """Stretches of a block, longest first."""

    begin: np.ndarray  # first token of each stretch
    size: np.ndarray
    doc: np.ndarray
    at: list[np.ndarray]  # at[j]: the j-th stretch of each document that has one
    last: np.ndarray  # whether a stretch ends its document


def layout(sizes: np.ndarray) -> Layout:
    count = -(-sizes // STRETCH)
    doc = np.repeat(np.arange(len(sizes)), count)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    begin = np.repeat(np.cumsum(sizes) - sizes, count) + number * STRETCH
    size = np.minimum(STRETCH, np.repeat(sizes, count) - number * STRETCH)
    order = np.argsort(-size, kind="stable")
    doc, number, begin, size = doc[order], number[order], begin[order], size[order]
    by_number = np.lexsort((doc, number))
    cuts = np.searchsorted(number[by_number], np.arange(1, int(count.max(initial=0))))
    return Layout(begin, size, doc, np.split(by_number, cuts), number == count[doc] - 1)


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / x.max(axis=tuple(range(1, x.ndim)), keepdims=True)


class Steps(NamedTuple):
    """Tokens of some stretches, step by step: all their first ones, all second ones, and so on."""

    at: np.ndarray  # first token of each step, and the number of all
    classes: np.ndarray
    seen: np.ndarray  # states x tokens: emissions


def steps_of(classes: np.ndarray, lay: Layout, params: Params, chosen: np.ndarray) -> Steps:
    """A row per state: what is done to a step runs along its tokens, of all stretches."""
    size, begin = lay.size[chosen], lay.begin[chosen]
    longer = len(size) - np.cumsum(np.bincount(size, minlength=1))
    at = np.append(0, np.cumsum(longer[:-1]))  # the longest come first
    step = np.repeat(np.arange(len(at) - 1), np.diff(at))
    own = classes[begin[np.arange(at[-1]) - at[step]] + step]
    return Steps(at, own, np.take(np.ascontiguousarray(params.emit.T), own, axis=1))


def _transfers(classes: np.ndarray, lay: Layout, params: Params) -> np.ndarray:
    """What each full stretch does to the state: product of emissions and moves.

    Stretches that end a document keep the identity; they are never passed.
    """
    k = len(params.start)
    out = np.broadcast_to(np.eye(k), (len(lay.begin), k, k)).copy()
    inner = np.flatnonzero(~lay.last)
    if len(inner):
        step = out[inner]
        for n in range(STRETCH):
            seen = params.emit[classes[lay.begin[inner] + n]]
            step = ((step * seen[:, None, :]).reshape(-1, k) @ params.move).reshape(-1, k, k)
            if n % SCALE_EVERY == SCALE_EVERY - 1:
                step = _scaled(step)
        out[inner] = step
    return out


def entering(lay: Layout, params: Params, transfers: np.ndarray) -> np.ndarray:
    """State chances ahead of each stretch, by the products of those before it."""
    ahead = np.empty((len(lay.begin), len(params.start)))
    for j, here in enumerate(lay.at):
        if j == 0:
            ahead[here] = params.start
        else:
            before = lay.at[j - 1][entry_rows(lay, j)]
            passed = np.einsum("ns,nst->nt", ahead[before], transfers[before])
            ahead[here] = passed / passed.sum(axis=1, keepdims=True)
    return ahead


def forward(steps: Steps, params: Params, ahead: np.ndarray, keep: bool):
    """Filtered state chances of each token, and ln-likelihood, of some stretches.

    Stretches start from the chances ``ahead``, so they run at once; scaling at each
    token gives the likelihood. Unless told to ``keep`` the emissions it writes over them.
    """
    ahead, at, move = np.ascontiguousarray(ahead.T), steps.at.tolist(), np.ascontiguousarray(params.move.T)
    alpha, norms = np.empty_like(steps.seen) if keep else steps.seen, np.empty(at[-1])
    total = np.zeros(ahead.shape[1])
    for lo, hi in zip(at[:-1], at[1:], strict=True):
        own = np.multiply(ahead[:, : hi - lo], steps.seen[:, lo:hi], out=alpha[:, lo:hi])
        own /= np.add.reduce(own, axis=0, out=norms[lo:hi])
        ahead = move @ own
    np.log(norms, out=norms)
    for lo, hi in zip(at[:-1], at[1:], strict=True):
        total[: hi - lo] += norms[lo:hi]
    return alpha, total


def entry_rows(lay: Layout, j: int) -> np.ndarray:
    """Rows of ``at[j - 1]`` whose documents go on in ``at[j]``."""
    return np.searchsorted(lay.doc[lay.at[j - 1]], lay.doc[lay.at[j]])


def backward(steps: Steps, params: Params, last, alpha, after, collect=None):
    """From the end of some stretches to their start.

    ``after`` is the likelihood of what follows each stretch by the state of the next
    token, unused where a document ends, as ``last`` tells. Gives the same for the
    stretch itself; ``collect`` gets the posteriors: of the moves, and instead of
    ``alpha`` of the states.
    """
    after, at, n = np.ascontiguousarray(after.T), steps.at.tolist(), 0
    for lo, hi in zip(at[-2::-1], at[:0:-1], strict=True):
        # Stretches from the n-th on end here.
        ends, n = n + np.flatnonzero(last[n : hi - lo]), hi - lo
        own = after[:, :n]
        beta = params.move @ own
        beta[:, ends] = 1.0
        if collect is not None:
            here = alpha[:, lo:hi]
            joint = here * beta
            norm = np.add.reduce(joint, axis=0)
            here /= norm
            here[:, ends] = 0.0
            collect += here @ own.T
            np.divide(joint, norm, out=here)
        beta *= steps.seen[:, lo:hi]
        np.divide(beta, np.add.reduce(beta, axis=0), out=own)
    return after.T


def groups(size: np.ndarray) -> list[np.ndarray]:
    """Stretches, in order, in groups of some ``GROUP_TOKENS`` tokens."""
    number = (np.cumsum(size) - size) // GROUP_TOKENS
    return np.split(np.arange(len(size)), np.flatnonzero(np.diff(number)) + 1)


def expected_counts(classes: np.ndarray, sizes: np.ndarray, params: Params):
    """Expected starts, moves and emissions of some documents, and their ln-likelihood.

    What enters each stretch from both sides is found first; then some stretches at
    a time are worked on, so memory does not grow with the length of a document.
    """
    lay, k = layout(sizes), len(params.start)
    transfers = _transfers(classes, lay, params)
    ahead = entering(lay, params, transfers)
    after = np.ones((len(lay.begin), k))
    longer = np.zeros(len(sizes), bool)
    if len(lay.at) > 1:
        longer[lay.doc[lay.at[1]]] = True
    ends = np.flatnonzero(lay.last & longer[lay.doc])
    entry = np.empty_like(after)
    for some in groups(lay.size[ends]):
        own = ends[some]
        entry[own] = backward(steps_of(classes, lay, params, own), params, lay.last[own], None, after[own])
    for j in range(len(lay.at) - 1, 0, -1):
        before = lay.at[j - 1][entry_rows(lay, j)]
        after[before] = entry[lay.at[j]]
        entry[before] = _scaled(np.einsum("nst,nt->ns", transfers[before], after[before]))
    starts, moves, emits, log = np.zeros(k), np.zeros((k, k)), np.zeros((len(params.emit), k)), 0.0
    first = np.zeros(len(lay.begin), bool)
    if lay.at:
        first[lay.at[0]] = True
    for chosen in groups(lay.size):
        steps = steps_of(classes, lay, params, chosen)
        alpha, total = forward(steps, params, ahead[chosen], keep=True)
        backward(steps, params, lay.last[chosen], alpha, after[chosen], moves)
        for s in range(k):
            emits[:, s] += np.bincount(steps.classes, alpha[s], len(params.emit))
        starts += alpha[:, : len(chosen)][:, first[chosen]].sum(axis=1)
        log += total.sum()
    return starts, moves * params.move, emits, log


def likelihood(classes: np.ndarray, sizes: np.ndarray, params: Params) -> np.ndarray:
    """Exact ln-likelihood of each document, by the scaled forward recursion."""
    lay = layout(sizes)
    ahead = entering(lay, params, _transfers(classes, lay, params))
    total = np.zeros(len(lay.begin))
    for chosen in groups(lay.size):
        _, total[chosen] = forward(steps_of(classes, lay, params, chosen), params, ahead[chosen], keep=False)
    return np.bincount(lay.doc, total, len(sizes))


def tokens_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each token of each text, its end included, and the number per text."""
    data, starts = words.joined(texts, lower=True)
    begin, end = words.word_bounds(data)
    doc = words.owner(begin, starts)
    sizes = np.bincount(doc, minlength=len(texts)) + 1
    out = np.full(len(begin) + len(texts), END, np.uint64)
    out[np.arange(len(begin)) + doc] = words.word_hashes(data, begin, end)
    return out, sizes


def is_held_out(doc_id: str | None) -> bool:
    return doc_id is not None and zlib.crc32(doc_id.encode()) % FOLDS == HELD


def packed(numbers: np.ndarray) -> bytes:
    """Numbers with equal bytes side by side, compressed: most of them are small."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    block = TaskContext.get().partitionId() << 32
    for batch in batches:
        texts, doc_ids = batch.text.tolist(), batch.doc_id.tolist()
        for a, b in words.batches(texts, BLOCK_CHARS):
            tokens, sizes = tokens_of(texts[a:b])
            held = np.array([is_held_out(i) for i in doc_ids[a:b]])
            vocabulary, place, n = np.unique(tokens, return_inverse=True, return_counts=True)
            often = np.argsort(-n, kind="stable")  # small numbers for frequent words
            to = np.empty(len(often), np.uint32)
            to[often] = np.arange(len(often), dtype=np.uint32)
            place = to[place]
            trained = np.bincount(place[~np.repeat(held, sizes)], minlength=len(often))
            yield pd.DataFrame({
                "block": [block], "doc_ids": [doc_ids[a:b]], "held": [held.tolist()],
                "sizes": [sizes.tolist()], "vocabulary": [vocabulary[often].tobytes()],
                "trained": [trained.astype(np.uint32).tobytes()], "tokens": [packed(place)],
            })
            block += 1


def _words_of_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for row in batch.itertuples(index=False):
            word = np.frombuffer(row.vocabulary, np.int64)
            n = np.frombuffer(row.trained, np.uint32).astype(np.int64)
            yield pd.DataFrame({
                "block": row.block, "place": np.arange(len(word), dtype=np.int32), "word": word, "n": n
            })


def _token_classes(row, bits: int) -> np.ndarray:
    vocabulary = np.frombuffer(row.vocabulary, np.uint64)
    classes = (vocabulary & np.uint64((1 << bits) - 1)).astype(np.int64)
    return classes[unpacked(row.tokens)]


def _expect(batches: Iterator[pd.DataFrame], params: tuple) -> Iterator[pd.DataFrame]:
    """Expected counts of a task as rows (task, slab, sums), see :func:`slabs`."""
    params = Params(*params)
    size, k = params.emit.shape
    sums = np.zeros((size + k + 2, k))
    for batch in batches:
        for row in batch.itertuples(index=False):
            sizes, free = np.array(row.sizes, np.int64), ~np.array(row.held, bool)
            classes = _token_classes(row, size.bit_length() - 1)[np.repeat(free, sizes)]
            if free.any():
                starts, moves, emits, log = expected_counts(classes, sizes[free], params)
                sums[:size] += emits
                sums[size : size + k] += moves
                sums[size + k] += starts
                sums[size + k + 1, 0] += log
    task = TaskContext.get().partitionId()
    for slab, data in slabs(sums, size):
        yield pd.DataFrame({"task": [task // FAN_IN], "slab": [slab], "sums": [data]})


def slabs(sums: np.ndarray, size: int) -> Iterator[tuple[int, bytes]]:
    """Sums of ``size`` classes in slabs, those of moves, starts and likelihood as number -1.

    Classes' sums are rounded to single precision once per task; zeros cost nothing.
    """
    packer = zstandard.ZstdCompressor(level=3)
    for a in range(0, size, SLAB):
        if sums[a : min(size, a + SLAB)].any():
            yield a // SLAB, packer.compress(sums[a : min(size, a + SLAB)].astype("<f4").tobytes())
    yield -1, sums[size:].astype("<f8").tobytes()


def slab_sums(slab: int, data: bytes) -> np.ndarray:
    if slab < 0:
        return np.frombuffer(data, "<f8")
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<f4").astype(float)


def _added(rows: pd.DataFrame) -> pd.DataFrame:
    slab = int(rows.slab.iloc[0])
    total = sum(slab_sums(slab, data) for data in rows.sums)
    if slab < 0:
        data = total.astype("<f8").tobytes()
    else:
        data = zstandard.ZstdCompressor(level=3).compress(total.astype("<f4").tobytes())
    return pd.DataFrame({"slab": [slab], "sums": [data]})


def first_params(class_counts: np.ndarray, states: int) -> Params:
    """Emissions near the corpus shares, disturbed by a hash; states that tend to stay."""
    share = (class_counts + 1) / (class_counts.sum() + len(class_counts))
    key = np.arange(len(share) * states, dtype=np.uint64) + np.uint64(1)
    noise = words.mix64(key * np.uint64(0x9E3779B97F4A7C15)).astype(float) / 2**64
    emit = share[:, None] * (0.25 + noise.reshape(len(share), states))
    move = np.full((states, states), 0.1 / max(1, states - 1)) + np.eye(states) * 0.9
    return Params(
        np.full(states, 1 / states), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0)
    )


def next_params(sums: np.ndarray, class_counts: np.ndarray, prior: float | None = None) -> Params:
    """Model from expected counts, each drawn a little towards the corpus shares.

    Unless given, ``prior`` counts one token per class and state: with classes that
    follow the vocabulary, rare ones would otherwise be learnt by heart.
    """
    size, k = len(class_counts), sums.shape[1]
    prior = max(LEAST_PRIOR, float(size)) if prior is None else prior
    share = (class_counts + 1) / (class_counts.sum() + size)
    emit = sums[:size] + prior * share[:, None]
    move, start = sums[size : size + k] + 1, sums[size + k] + 1
    return Params(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def _score(block: pd.DataFrame, counts: pd.DataFrame, shared: tuple) -> pd.DataFrame:
    params, class_n, class_v, total, distinct = shared
    params = Params(*params)
    out = []
    for row in block.itertuples(index=False):
        sizes = np.array(row.sizes, np.int64)
        tokens = unpacked(row.tokens)
        n = np.zeros(len(row.vocabulary) // 8)
        n[counts.place.to_numpy()] = counts.c.to_numpy()
        n = n[tokens]
        classes = _token_classes(row, len(params.emit).bit_length() - 1)
        within = np.log((n + 1) / (class_n + class_v + 1)[classes])
        base = np.log((n + 1) / (total + distinct + 1))
        doc = np.repeat(np.arange(len(sizes)), sizes)
        add = lambda x, doc=doc, sizes=sizes: np.bincount(doc, x, len(sizes))
        out.append(pd.DataFrame({
            "doc_id": row.doc_ids, "held_out": np.array(row.held, bool), "n_tokens": sizes,
            "n_known": add((n > 0).astype(float)).astype(np.int64), "base_ln": add(base),
            "model_ln": likelihood(classes, sizes, params) + add(within),
        }))
    return pd.concat(out) if out else pd.DataFrame(columns=[f.split()[0] for f in SCORE.split(", ")])


def train(
    blocks: DataFrame, class_n: np.ndarray, states: int, least_gain: float, most_rounds: int
) -> Params:
    """Baum-Welch over all blocks, until :func:`has_settled` or after ``most_rounds``."""
    spark, size = blocks.sparkSession, len(class_n)
    params, reached = first_params(class_n, states), []
    for _ in range(most_rounds):
        shared = spark.sparkContext.broadcast(tuple(params))
        parts = blocks.select("held", "sizes", "vocabulary", "tokens").mapInPandas(
            lambda it, s=shared: _expect(it, s.value), "task long, slab int, sums binary"
        )
        added = parts.groupBy("task", "slab").applyInPandas(_added, "slab int, sums binary")
        sums = np.zeros((size + states + 2, states))
        for row in added.groupBy("slab").applyInPandas(_added, "slab int, sums binary").collect():
            own = slab_sums(row.slab, row.sums).reshape(-1, states)
            at = size if row.slab < 0 else row.slab * SLAB
            sums[at : at + len(own)] = own
        shared.unpersist()
        params = next_params(sums, class_n)
        # The likelihood is that of the model before this round's step.
        reached.append(sums[-1, 0] / max(1.0, class_n.sum()))
        if has_settled(reached, least_gain):
            break
    return params


def has_settled(reached: list[float], least_gain: float) -> bool:
    """Whether the last of these likelihoods is the end of training."""
    if len(reached) < LEAST_ROUNDS:
        return False
    before, last = np.diff(reached[-3:])
    return last < least_gain and last <= before


def class_bits_for(distinct: int, most: int = MOST_CLASS_BITS) -> int:
    """Bits of the class number, for so many different words."""
    wanted = max(1, distinct // WORDS_PER_CLASS).bit_length()
    return min(most, max(LEAST_CLASS_BITS, wanted))


def score(
    docs: DataFrame,
    states: int = STATES,
    least_gain: float = LEAST_GAIN,
    most_rounds: int = MOST_ROUNDS,
    class_bits: int | None = None,
) -> DataFrame:
    """Train on the documents that are not held out, and score all of them.

    Takes ``doc_id`` and ``text``; other columns are ignored. Gives per input row:
    doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, the last
    two as log10. A null or empty text is the end token alone; a null id is not held
    out; repeated rows count and are scored each; an empty table gives no rows.
    A text is taken whole, however long. Words are told apart by a 64-bit hash: among
    v different words two are taken for one with a chance of v squared over 2**65.

    Texts become blocks of numbered tokens. Counts go from the blocks to a table by
    word and back to the block as the counts of its own words, so no task holds the
    vocabulary. The model, ``2**class_bits`` rows of ``states``, is broadcast; unless
    given, ``class_bits`` follows the number of different training words, see
    :func:`class_bits_for`. Training ends with the round that adds less than
    ``least_gain`` to the ln-likelihood of a training token, and less than the round
    before, from the fourth on; or after ``most_rounds``.
    """
    spark = docs.sparkSession
    blocks = keep(docs.select(id_text("doc_id"), "text").mapInPandas(_blocks, BLOCK), "hmm-blocks")
    found = blocks.select("block", "vocabulary", "trained").mapInPandas(
        _words_of_blocks, "block long, place int, word long, n long"
    )
    counts = found.where("n > 0").groupBy("word").agg(F.sum("n").alias("c"))
    counts = keep(counts, "hmm-counts")
    distinct = counts.count()
    bits = class_bits_for(distinct) if class_bits is None else class_bits
    group = F.col("word").bitwiseAND(F.lit((1 << bits) - 1)).cast("int")
    by_class = counts.groupBy(group.alias("class")).agg(F.sum("c").alias("n"), F.count("*").alias("v"))
    by_class = by_class.toPandas()
    class_n, class_v = np.zeros(1 << bits), np.zeros(1 << bits)
    class_n[by_class["class"].to_numpy(int)] = by_class.n.to_numpy(float)
    class_v[by_class["class"].to_numpy(int)] = by_class.v.to_numpy(float)
    total = int(class_n.sum())

    params = train(blocks, class_n, states, least_gain, most_rounds)
    known = found.select("block", "place", "word").join(counts, "word").select("block", "place", "c")
    model = spark.sparkContext.broadcast((tuple(params), class_n, class_v, total, distinct))
    scored = blocks.drop("trained").groupBy("block").cogroup(known.groupBy("block")).applyInPandas(
        lambda left, right: _score(left, right, model.value), SCORE
    )
    ln10 = float(np.log(10))
    return scored.select(
        F.col("doc_id").cast("long").alias("doc_id"), "held_out", "n_tokens", "n_known",
        F.lit(total).cast("long").alias("train_tokens"), (F.col("base_ln") / ln10).alias("base_score"),
        (F.col("model_ln") / ln10).alias("score"),
    )
