import random

import pytest

from racestream.llm import toxicity as tox

from .fixtures import DOCS, messy, with_clashes, words


def test_folding():
    assert tox.folded("ІD1ОТ!  l0ser_x".encode()) == " idiot loser x "
    assert tox.folded("ид​іот".encode()) == tox.folded("идіот".encode())
    assert tox.folded(None) == tox.folded(b"") == tox.folded(b" .,; ") == ""


def test_exceptions_cover_hits():
    lexicon = tox.Lexicon({" idiot": 5.0, " bad ": 2.0}, [" no idiot "], [-3.0, 2.0, 0.0])
    assert [h[:2] for h in lexicon.hits(" he is an idiots bad ")] == [(9, 15), (16, 21)]
    assert lexicon.hits(" there is no idiot here ") == []
    assert lexicon.hits(" badly ") == []
    assert lexicon.score(" an idiot ") > 0.5 > lexicon.score("")


def test_nested_entries_leave_one():
    counts = {" lowe": (100, 0), " lowei": (99, 0), " loweis": (40, 0), " trash": (80, 0), " tras": (80, 90)}
    assert set(tox.choose_entries(counts, 300, 3000)) == {" lowei", " trash"}


def corpus(n=300, rate=4):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        w, bad = words(rng, 40), i % rate == 0
        if bad:
            for at in rng.sample(range(40), 3):
                w[at] = rng.choice(["idiot", "1diot", "іdiоt", "m0ron"])
            w[rng.randrange(40)] = "scum"
        elif i % 40 == 1:
            w[7:9] = ["no", "scum"]
        rows.append((i, " ".join(w), "en", "s", 1))
        labels.append((i, int(bad)))
    return rows, labels


def test_learns_and_holds_out(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, DOCS)
    table = spark.createDataFrame([x for x in labels if x[0] < 200] + [(0, 1), (None, 1), (3, None)], "doc_id long, toxic int")
    lexicon = tox.learn_lexicon(docs, table)
    assert any("idio" in t for t in lexicon.weights) and " no scum " in lexicon.exceptions
    out = {r.doc_id: r.score for r in tox.score_toxicity(docs, lexicon, ["doc_id"]).select("row.doc_id", "score").collect()}
    truth = dict(labels)
    assert sum((out[i] >= tox.THRESHOLD) == bool(truth[i]) for i in range(200, 300)) >= 98
    again = tox.learn_lexicon(docs, table)
    assert (again.weights, again.exceptions) == (lexicon.weights, lexicon.exceptions)


@pytest.mark.parametrize("labels", [[], [(5, 1)], [(5, 0)]])
def test_without_both_labels(spark, labels):
    docs = messy(spark)
    lexicon = tox.learn_lexicon(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    scores = {r.score for r in tox.score_toxicity(docs, lexicon, ["doc_id"]).collect()}
    assert len(scores) == 1 and (scores == {1.0} if labels == [(5, 1)] else scores.pop() < 1e-6)


def test_messy_rows_and_clashing_names(spark):
    rows, labels = corpus(120)
    lexicon = tox.learn_lexicon(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int"))
    docs = with_clashes(messy(spark))
    out = tox.score_toxicity(docs, lexicon, docs.columns)
    assert out.count() == 13 and all(0 <= r.score < 0.7 for r in out.select("score").collect())
    assert out.select("row.*").columns == docs.columns
    assert tox.score_toxicity(docs.limit(0), lexicon, ["doc_id"]).count() == 0


def test_held_out_accuracy_on_the_given_tables(spark):
    rows = tox.q_op3_toxicity(spark, "/root/testdata/sf0.01").collect()
    truth = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert sum(p == t for p, t in held) / len(held) > 0.9
