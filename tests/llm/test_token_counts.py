from collections import Counter

from racestream.llm import token_counts as tc
from racestream.llm.tokens import WordIds, vocabulary_path

from .fixtures import messy, messy_rows, with_clashes


def test_histogram_against_brute_force(spark):
    ids = WordIds(vocabulary_path())
    lengths = [len(ids.tokenizer.encode(r[1] or "", add_special_tokens=False).ids) for r in messy_rows()]
    hist = tc.histogram(tc.token_lengths(with_clashes(messy(spark)), ["doc_id"]).select("length")).cache()
    rows = {r.length: r for r in hist.collect()}
    assert {k: r.n_docs for k, r in rows.items()} == Counter(lengths)
    for k, r in rows.items():
        above = [x for x in lengths if x >= k]
        assert (r.n_tokens, r.docs_at_least, r.tokens_at_least, r.truncated_tokens) == (
            k * lengths.count(k), len(above), sum(above), sum(min(x, k) for x in lengths))
    for r in tc.limit_totals(hist, [0, 1, 100, 4096, 10**9]).collect():
        assert (r.n_docs, r.n_tokens, r.docs_over, r.tokens_truncated) == (
            len(lengths), sum(lengths), sum(x > r.context_limit for x in lengths),
            sum(min(x, r.context_limit) for x in lengths))
    order = sorted(lengths)
    for r in tc.quantile(hist, [0.01, 0.5, 1.0]).collect():
        assert r.length == order[max(0, -(-int(r.share * 1000) * len(order) // 1000) - 1)]


def test_empty(spark):
    hist = tc.histogram(tc.token_lengths(messy(spark).limit(0), ["doc_id"]).select("length"))
    assert hist.count() == 0
