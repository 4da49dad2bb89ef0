import re

import pytest

import corpus_pipeline as cp
from racestream.llm import toxicity

from .fixtures import messy
from .test_decontaminate import brute as contaminated
from .test_jaccard import brute as classes
from .test_packing import check
from .test_pii import brute as spans

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's input and output rows."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in cp.STAGES:
        after = cp.materialise(stage(spark, docs, SF), f"test-{name}")
        out.append((docs.collect(), after.collect(), docs.columns, after.columns))
        docs = after
    return out


def test_columns(stages):
    for before, after, names, names_after in stages[:-1]:
        assert names == names_after and len(after) <= len(before) and after


def test_toxicity_follows_the_score(spark, stages):
    before, after, *_ = stages[0]
    lexicon = toxicity.learn_lexicon(spark.read.parquet(f"{SF}/documents.parquet"), toxicity.training_labels(spark, SF))
    want = {r.doc_id for r in before if lexicon.score(toxicity.folded((r.text or "").encode())) < toxicity.THRESHOLD}
    assert {r.doc_id for r in after} == want


def test_one_of_each_class(stages):
    before, after, *_ = stages[1]
    want = {c for _, _, c in classes([(r.doc_id, r.text) for r in before], 5, 80, 100)}
    assert sorted(r.doc_id for r in after) == sorted(want)


def test_no_benchmark_window_is_left(spark, stages):
    before, after, *_ = stages[2]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    want = {d for d, _, hit, _ in contaminated([(r.doc_id, r.text) for r in before], items) if not hit}
    assert {r.doc_id for r in after} == want


def test_personal_data_is_replaced(stages):
    before, after, *_ = stages[3]
    new = {r.doc_id: r for r in after}
    assert len(before) == len(after)
    for r in before:
        found = spans(r.text or "")
        if not found:
            assert new[r.doc_id].text == r.text
        else:
            assert re.search(r"\[(EMAIL|IP|CARD|PHONE)\]", new[r.doc_id].text)
            assert all(r.text[s:e] not in new[r.doc_id].text for _, s, e in found)
        assert new[r.doc_id].n_chars == len(new[r.doc_id].text)


def test_everything_left_is_packed(stages):
    before, after, *_ = stages[4]
    n = check(after, [r.text for r in before], 4096)
    assert n == -(-sum(r.length for r in after) // 4096)


def test_messy_rows_pass_every_stage(spark):
    docs = messy(spark)
    for name, stage in cp.STAGES:
        docs = cp.materialise(stage(spark, docs, SF), f"test-{name}")
    assert {r.doc_id for r in docs.collect()} == {1, 2, 3, 4, 5, 7, 8, 9, 10, None}
    empty = messy(spark).limit(0)
    for _, stage in cp.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0
