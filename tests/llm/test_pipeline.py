"""Each stage against what it should do to its own input, computed plainly."""

from collections import Counter

import pytest

import corpus_pipeline
from rateweave.llm import mixing, secrets, toxicity
from rateweave.llm.tables import keep
from tests.llm.test_secrets import strong
from tests.llm.test_simhash import plain_components, plain_print


@pytest.fixture(scope="module")
def stages(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(keep(stage(spark, out[-1], small_dir), f"test-{name}"))
    return out


def test_columns_stay(stages):
    for frame in stages[1:5]:
        assert frame.columns == stages[0].columns


def test_toxic_documents_go(spark, small_dir, stages):
    labels = spark.read.parquet(f"{small_dir}/labels.parquet")
    verdicts = toxicity.classify(stages[0], toxicity.train(stages[0], labels))
    clean = sorted(r.doc_id for r in verdicts.where("NOT toxic").collect())
    assert sorted(r.doc_id for r in stages[1].collect()) == clean


def test_one_of_each_group_stays(stages):
    rows = sorted(stages[1].select("doc_id", "text").collect())
    roots = plain_components([plain_print(r.text) for r in rows])
    want = sorted({rows[i] for i in roots})
    assert sorted(stages[2].select("doc_id", "text").collect()) == want


def test_secrets_are_hidden(stages):
    before = {r.doc_id: r.text for r in stages[2].collect()}
    after = {r.doc_id: r for r in stages[3].collect()}
    assert before.keys() == after.keys()
    for doc_id, text in before.items():
        own = after[doc_id]
        assert own.text == text or secrets.HIDDEN in own.text
        assert not strong(own.text) and own.n_chars == len(own.text)
        if not strong(text) and not secrets.weak_spans(text, []):
            assert own.text == text


def test_documents_are_taken_as_the_mix_has_it(stages):
    want = {r.doc_id: r.copies for r in mixing.mix(stages[3]).collect() if r.copies}
    assert dict(Counter(r.doc_id for r in stages[4].select("doc_id").collect())) == want
    texts = {r.doc_id: r.text for r in stages[3].collect()}
    assert all(texts[r.doc_id] == r.text for r in stages[4].collect())


def test_every_copy_is_packed(stages):
    copies = Counter(r.doc_id for r in stages[4].select("doc_id").collect())
    packed = stages[5].toPandas()
    assert dict(packed[packed.piece == 0].doc_id.value_counts()) == dict(copies)
    for _, own in packed.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own.offset.tolist() == [0, *own.length.cumsum().tolist()[:-1]] and own.length.sum() <= 2048
