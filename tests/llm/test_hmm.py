import math
import zlib
from collections import Counter

import numpy as np
import pytest

from rateweave.llm import hmm


def slow_counts(classes, sizes, params):
    """Baum-Welch counts of each document, token by token."""
    starts, moves, emits = (np.zeros_like(x) for x in params)
    logs, at = [], 0
    for size in sizes:
        seen, at = classes[at : at + size], at + size
        ahead, alpha, log = params.start, [], 0.0
        for c in seen:
            own = ahead * params.emit[c]
            log += math.log(own.sum())
            alpha.append(own / own.sum())
            ahead = alpha[-1] @ params.move
        beta = [np.ones(len(starts))]
        for c in reversed(seen[1:]):
            own = params.move @ (params.emit[c] * beta[0])
            beta.insert(0, own / own.sum())
        for t, c in enumerate(seen):
            state = alpha[t] * beta[t] / (alpha[t] @ beta[t])
            emits[c] += state
            starts += state * (t == 0)
            if t + 1 < size:
                joint = alpha[t][:, None] * params.move * (params.emit[seen[t + 1]] * beta[t + 1])
                moves += joint / joint.sum()
        logs.append(log)
    return starts, moves, emits, logs


@pytest.mark.parametrize("stretch", [4, 64, 4096])
def test_counts_and_likelihood_equal_the_plain_recursion(stretch, monkeypatch):
    monkeypatch.setattr(hmm, "STRETCH", stretch)
    monkeypatch.setattr(hmm, "GROUP_TOKENS", 150)
    rng = np.random.default_rng(stretch)
    states, size = 3, 16
    params = hmm.Params(
        rng.dirichlet(np.ones(states)), rng.dirichlet(np.ones(states), states),
        rng.dirichlet(np.ones(size), states).T,
    )
    sizes = np.array([1, 2, 3, 4, 5, 8, 63, 64, 65, 128, 129, 300, 1])
    classes = rng.integers(0, size, sizes.sum())
    want, got = slow_counts(classes, sizes, params), hmm.expected_counts(classes, sizes, params)
    for a, b in zip(want[:3], got[:3], strict=True):
        assert np.allclose(a, b)
    assert np.allclose(hmm.likelihood(classes, sizes, params), want[3])
    assert got[3] == pytest.approx(sum(want[3]))


def test_likelihood_of_all_sequences_sums_to_one():
    rng = np.random.default_rng(7)
    params = hmm.Params(rng.dirichlet([1, 1]), rng.dirichlet([1, 1], 2), rng.dirichlet([1, 1, 1], 2).T)
    every = np.array([[i, j, k] for i in range(3) for j in range(3) for k in range(3)])
    logs = hmm.likelihood(every.ravel(), np.full(27, 3), params)
    assert np.exp(logs).sum() == pytest.approx(1)


def test_training_raises_the_likelihood():
    rng = np.random.default_rng(3)
    sizes = np.full(50, 40)
    classes = np.where(np.repeat(rng.random(50) < 0.5, 40), rng.integers(0, 8, 2000), rng.integers(8, 16, 2000))
    counts = np.bincount(classes, minlength=16)
    params, logs = hmm.first_params(counts, 2), []
    for _ in range(6):
        starts, moves, emits, log = hmm.expected_counts(classes, sizes, params)
        logs.append(log)
        params = hmm.next_params(np.vstack([emits, moves, starts[None]]), counts, prior=0.1)
    assert all(b >= a - 1e-6 for a, b in zip(logs, logs[1:])) and logs[-1] > logs[0] + 100


def test_scores_of_all_documents(spark, small_dir):
    sf = small_dir.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    tokens = {r.doc_id: [*(r.text or "").encode().lower().split(), None] for r in docs.collect()}
    counts = Counter()
    for doc_id, own in tokens.items():
        if zlib.crc32(str(doc_id).encode()) % 7 != 2:
            counts.update(own)
    total, distinct = sum(counts.values()), len(counts)
    got = hmm.score(docs).collect()
    assert sorted(r.doc_id for r in got) == sorted(tokens)
    for row in got:
        own = tokens[row.doc_id]
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in own)
        assert row.base_score == pytest.approx(base)
        assert (row.n_tokens, row.n_known) == (len(own), sum(counts[w] > 0 for w in own))
        assert row.train_tokens == total
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 7 == 2)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_classes_follow_the_vocabulary():
    assert hmm.class_bits_for(0) == hmm.class_bits_for(200) == hmm.LEAST_CLASS_BITS
    assert hmm.class_bits_for(4 * 1000) == 10
    assert hmm.class_bits_for(10**12) == hmm.MOST_CLASS_BITS
    bits = [hmm.class_bits_for(n) for n in range(1, 10**6, 997)]
    assert bits == sorted(bits)


def test_training_ends_with_the_likelihood(spark, small_dir, monkeypatch):
    """The model of a run is that of as many rounds as the likelihood asked for."""
    docs, reached = spark.read.parquet(f"{small_dir}/documents.parquet"), []
    step = hmm.next_params

    def watched(sums, class_counts):
        reached.append(sums[-1, 0] / class_counts.sum())
        return step(sums, class_counts)

    monkeypatch.setattr(hmm, "next_params", watched)
    by_gain = {r.doc_id: r.score for r in hmm.score(docs, least_gain=0.02).collect()}
    gains, rounds = np.diff(reached), len(reached)
    assert hmm.LEAST_ROUNDS <= rounds < hmm.MOST_ROUNDS
    assert gains[-1] < min(0.02, gains[-2])
    assert not any(hmm.has_settled(reached[:n], 0.02) for n in range(1, rounds))
    by_rounds = {r.doc_id: r.score for r in hmm.score(docs, least_gain=-9.0, most_rounds=rounds).collect()}
    assert by_gain == pytest.approx(by_rounds)


def test_small_first_steps_do_not_end_the_training():
    assert not hmm.has_settled([-9.0, -8.95], 0.1)
    assert not hmm.has_settled([-9.0, -8.95, -8.92], 0.1)
    assert not hmm.has_settled([-9.0, -8.99, -8.97, -8.9], 0.1)
    assert not hmm.has_settled([-9.0, -8.9, -8.5, -8.3], 0.1)
    assert hmm.has_settled([-9.0, -8.9, -8.5, -8.3, -8.25], 0.1)


def test_reruns_agree(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    by_gain, by_rounds = ({r.doc_id: r.score for r in hmm.score(docs, most_rounds=2).collect()} for _ in range(2))
    assert by_gain == pytest.approx(by_rounds)


def test_scores_equal_the_plain_forward_recursion(spark, monkeypatch):
    """Training and scoring end to end against lists of tokens on one machine."""
    rng = np.random.default_rng(2)
    texts = [" ".join(rng.choice(list("abcdefgh"), rng.integers(0, 30))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.score for r in hmm.score(docs, 2, -9.0, 2, 3).collect()}
    tokens, sizes = hmm.tokens_of(texts)
    doc = np.repeat(np.arange(60), sizes)
    free = np.array([not hmm.is_held_out(str(i)) for i in range(60)])
    counts = Counter(tokens[free[doc]].tolist())
    n, v = np.zeros(8), np.zeros(8)
    for word, c in counts.items():
        n[word & 7] += c
        v[word & 7] += 1
    classes = (tokens & np.uint64(7)).astype(int)
    params = hmm.first_params(n, 2)
    for _ in range(2):
        starts, moves, emits, _ = slow_counts(classes[free[doc]], sizes[free], params)
        params = hmm.next_params(np.vstack([emits, moves, starts[None]]), n)
    *_, logs = slow_counts(classes, sizes, params)
    for i in range(60):
        own = sum(
            math.log((counts[w] + 1) / (n[w & 7] + v[w & 7] + 1)) for w in tokens[doc == i].tolist()
        )
        assert got[i] == pytest.approx((logs[i] + own) / math.log(10), rel=1e-6)


def test_a_step_is_one_run_of_tokens_with_a_row_per_state(monkeypatch):
    """What is done to a token of each stretch at once lies side by side, each token once."""
    monkeypatch.setattr(hmm, "STRETCH", 16)
    rng = np.random.default_rng(5)
    sizes = np.array([1, 40, 16, 7, 17, 3])
    classes, params = rng.integers(0, 32, sizes.sum()), hmm.first_params(np.ones(32), 3)
    lay = hmm.layout(sizes)
    steps = hmm.steps_of(classes, lay, params, np.arange(len(lay.begin)))
    assert steps.seen.shape == (3, sizes.sum()) and steps.seen.flags.c_contiguous
    assert (steps.seen == params.emit[steps.classes].T).all()
    for n, (lo, hi) in enumerate(zip(steps.at[:-1], steps.at[1:], strict=True)):
        assert steps.classes[lo:hi].tolist() == classes[lay.begin[lay.size > n] + n].tolist()


def test_scoring_holds_a_group_of_tokens_at_a_time(monkeypatch):
    held, whole = [], hmm.steps_of

    def watched(classes, lay, params, chosen):
        steps = whole(classes, lay, params, chosen)
        held.append(len(steps.classes))
        return steps

    monkeypatch.setattr(hmm, "STRETCH", 16)
    monkeypatch.setattr(hmm, "GROUP_TOKENS", 50)
    monkeypatch.setattr(hmm, "steps_of", watched)
    rng = np.random.default_rng(6)
    sizes = rng.integers(1, 60, 40)
    classes, params = rng.integers(0, 32, sizes.sum()), hmm.first_params(np.ones(32), 3)
    got = hmm.likelihood(classes, sizes, params)
    assert sum(held) == sizes.sum() and max(held) < 50 + 16
    assert np.allclose(got, slow_counts(classes, sizes, params)[3])
