import random
import re
import zlib
from collections import Counter

from racestream.llm import spelling
from racestream.llm.spelling import (
    indexed_keys, near_words, pivot_keys, pivots, prefix, q_op12_spelling, variant_groups, word_counts,
)

from .fixtures import DOCS, doc, messy, with_clashes


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def vocabulary(rng, alphabet, n):
    out = set()
    for _ in range(n):
        w = "".join(rng.choice(alphabet) for _ in range(rng.randint(5, 12)))
        out.add(w)
        for _ in range(3):
            i, c = rng.randrange(len(w)), rng.choice(alphabet)
            out |= {w[:i] + c + w[i:], w[:i] + c + w[i + 1:], *([w[:i] + w[i + 1:]] if len(w) > 5 else [])}
    return sorted(out)


def test_keys_miss_no_near_word():
    rng = random.Random(1)
    for alphabet in ("a", "ab", "abc", "abcdefgh") * 15:
        words = vocabulary(rng, alphabet, 15)
        count = Counter(w[i:i + 2] for w in words for i in range(len(w) - 1))
        index: dict = {}
        for w in words:
            indexed = prefix(w, count)[1]
            assert len(indexed) <= 7
            for k in indexed_keys(w, [g[2] for g in indexed]):
                index.setdefault(k, set()).add(w)
        found = set()
        for w in words:
            head = prefix(w, count)[0]
            chosen = pivots([g[2] for g in head], [g[0] for g in head])
            assert chosen[1] - chosen[0] >= 2
            for k in pivot_keys(w, *chosen):
                found |= {frozenset((w, x)) for x in index.get(k, ()) if one_edit(w, x)}
        assert found == {frozenset((a, b)) for a in words for b in words if a < b and one_edit(a, b)}


def test_pivots_are_the_lightest_disjoint_ones():
    assert pivots([4, 0, 1], [5, 9, 2]) == (1, 4)
    assert pivots([0, 1, 2], [1, 1, 9]) == (0, 2)
    assert pivots([3, 4, 6, 8], [1, 1, 1, 1], 3) == (3, 6, 8)


def groups(words, ratio=2):
    near = {w: [x for x in words if one_edit(w, x) and x != w] for w in words}
    form = {}
    for w in words:
        top = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = top if top and words[top] >= ratio * words[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return sorted((w, form[w] or "", root(w), words[w], len(near[w]), words[form[w]] if form[w] else 0) for w in words)


def rows_of(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in df.collect())


def test_groups_with_ties_and_a_chain(spark):
    rng = random.Random(5)
    words = {w: rng.choice([3, 3, 6, 12, 40]) for w in vocabulary(rng, "abcdé", 40)}
    words |= {"zzzzz" + "y" * k + "x" * (9 - k): 3 << k for k in range(10)}  # each the form of the one before
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = rows_of(variant_groups(df))
    assert got == groups(words)
    assert ("zzzzz" + "x" * 9, "zzzzzy" + "x" * 8, "zzzzz" + "y" * 9, 3, 1, 6) in got


def test_hot_half(spark):
    letters = str.maketrans("0123456789", "abcdefghij")
    words = {"shared" + f"{i:04d}".translate(letters): 3 for i in range(2000)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    want = {(w, x) for w in words for i in range(6, 10) for c in "abcdefghij"
            if (x := w[:i] + c + w[i + 1:]) != w and x in words}
    assert {(r.word, r.near) for r in near_words(df).collect()} == want


def counted(rows):
    total: Counter = Counter()
    for r in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or "")
        for w in re.findall("[A-Za-zÀ-ÿ]+", text):
            h = zlib.crc32(f"{'' if r[0] is None else r[0]}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 5:
                total[w] += 1
    return {w: n for w, n in total.items() if n >= 3}


def test_counts(spark):
    rng = random.Random(8)
    rows = [doc(i, " ".join(rng.choice(["naïveté", "École", "PLAIN", "spelling", "spe1ling", "x×y÷z", "abc"])
                            for _ in range(rng.randint(0, 80)))) for i in range(400)]
    got = {r.word: r.n for r in word_counts(spark.createDataFrame(rows, DOCS).repartition(3)).collect()}
    assert got == counted(rows) and len(got) > 5
    assert any(len(w) == 7 for w in got)  # a slip


def test_messy_rows(spark):
    rows = [tuple(r) for r in messy(spark).collect()]
    got = {r.word: r.n for r in word_counts(messy(spark)).collect()}
    assert got == counted(rows)
    words = word_counts(with_clashes(messy(spark)))
    assert rows_of(variant_groups(words)) == groups(got)
    empty = word_counts(messy(spark).limit(0))
    assert variant_groups(empty).collect() == []


def test_very_long_words(spark):
    words = {"a" * 30_000: 9, "a" * 29_999: 3, "ab" * 10_000: 3}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert [(r[1] != "", r[4]) for r in rows_of(variant_groups(df))] == [(True, 1), (False, 1), (False, 0)]


def test_no_join_is_broadcast(spark, monkeypatch):
    """Whatever size Spark takes a table for: a small file of words has many times as many keys."""
    words = {"zzzzz" + "y" * k + "x" * (9 - k): 3 << k for k in range(10)}
    seen, write = [], spelling.materialise

    def shown(df, name):
        seen.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return write(df, name)

    monkeypatch.setattr(spelling, "materialise", shown)
    df = write(spark.createDataFrame(list(words.items()), "word string, n long"), "words")  # of known size, and small
    got = variant_groups(df)
    seen += [("near", near_words(df)._jdf.queryExecution().executedPlan().toString())]
    assert rows_of(got) == groups(words)
    seen += [("result", got._jdf.queryExecution().executedPlan().toString())]  # as it ran
    assert {name for name, _ in seen} == {"forms", "roots", "near", "result"}
    for name, plan in seen:
        assert "SortMergeJoin" in plan and "Broadcast" not in plan, (name, plan)


def test_query_shape(spark):
    assert q_op12_spelling(spark, "/root/testdata/sf0.001").columns == ["word", "form", "root", "n", "n_near", "form_n"]
