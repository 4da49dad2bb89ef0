import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from racestream.llm import suffix_tree_lm as lm

from .fixtures import DOCS, messy, messy_rows, with_clashes, words


def tree_of(texts, depth=3, gain=0.5):
    """The tree from plain Python counts."""
    lists = [lm.words_of(t) for t in texts]
    packed, _ = lm.grams(lm.stream(lists, depth), depth)
    tree = lm.SuffixTree(depth)
    root = np.bincount((packed & np.uint64(255)).astype(int), minlength=256)
    tree.root = (root + 1) / (root.sum() + 256)
    for d in range(1, depth + 1):
        keys, counts = np.unique(packed & np.uint64((1 << 8 * (d + 1)) - 1), return_counts=True)
        n, t = Counter(), Counter()
        for k, c in zip(keys.tolist(), counts.tolist()):
            n[k >> 8] += c
            t[k >> 8] += 1
        tree.add_level(keys, counts.astype(float), np.array([n[k >> 8] for k in keys.tolist()]),
                       np.array([t[k >> 8] for k in keys.tolist()]), gain)
    return tree


TEXTS = [b"the cat sat on the mat", b"the dog sat", b"", b"the the the cat", "é ß été".encode()]


def test_every_distribution_sums_to_one():
    tree = tree_of(TEXTS)
    assert sum(len(level[0]) for level in tree.levels) > 0
    for context in (b"   ", b"the", b"he ", b"zzz", b" th"):
        last = np.arange(256, dtype=np.uint64)
        base = np.uint64(int.from_bytes(context, "big") << 8)
        assert tree.lookup(base | last).sum() == pytest.approx(1)


def test_score_is_the_product_along_the_longest_retained_suffixes():
    tree = tree_of(TEXTS)
    for text in [b"the cat", b"", b"A dog  sat\n", b"unseen words"]:
        lists = [lm.words_of(text)]
        data = b" " * 3 + b" ".join(lists[0]) + b"\n"
        total = 0.0
        for i in range(3, len(data)):
            p = tree.root[data[i]]
            for d in range(1, 4):
                contexts, escape, keys, values = tree.levels[d - 1]
                context = int.from_bytes(data[i - d:i], "big")
                if context in contexts.tolist():
                    key = context << 8 | data[i]
                    known = dict(zip(keys.tolist(), values.tolist()))
                    p = known.get(key, p * escape[contexts.tolist().index(context)])
            total += math.log10(p)
        assert tree.score(lists)[0] == pytest.approx(total)


def test_grams_never_cross_texts():
    lists = [[b"ab"], [], [b"c", b"d"]]
    packed, at = lm.grams(lm.stream(lists, 2), 2)
    got = [int(x).to_bytes(3, "big") for x in packed]
    assert got == [b"  a", b" ab", b"ab\n", b"  \n", b"  c", b" c ", b"c d", b" d\n"]


def spark_scores(docs, training):
    out = lm.score_texts(docs, ["doc_id"], training, depth=3, min_context=1)
    return out.select("row.doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()


def expected_base(rows, training):
    counts = Counter()
    for i, text in rows:
        if training(i):
            counts.update([*lm.words_of((text or "").encode()), b"\n"])
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, text in rows:
        tokens = [*lm.words_of((text or "").encode()), b"\n"]
        out.append((i, len(tokens), sum(t in counts for t in tokens), n,
                    sum(math.log10((counts[t] + 1) / (n + 1 * (v + 1))) for t in tokens)))
    return out


@pytest.mark.parametrize("common", [1 << 18, 5])
def test_base_against_brute_force_on_messy_rows(spark, monkeypatch, common):
    monkeypatch.setattr(lm, "COMMON", common)
    rows = [(r[0], r[1]) for r in messy_rows()]
    training = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2
    got = spark_scores(with_clashes(messy(spark)), lm.fold("doc_id", 7) != 2)
    key = lambda r: (str(r[0]), r[1], round(r[4], 4))
    for a, b in zip(sorted([tuple(r) for r in got], key=key), sorted(expected_base(rows, training), key=key), strict=True):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4]) and a[5] < 0


def test_spark_tree_equals_the_plain_one(spark):
    rows = [(i, t.decode(), None, None, None) for i, t in enumerate(TEXTS)]
    got = {r.doc_id: r.score for r in spark_scores(spark.createDataFrame(rows, DOCS), F.lit(True))}
    tree = tree_of(TEXTS, gain=lm.GAIN_BITS)
    want = tree.score([lm.words_of(t) for t in TEXTS])
    assert [got[i] for i in range(len(TEXTS))] == pytest.approx(want.tolist())


@pytest.mark.parametrize("cached", [1 << 21, 20, 0])
def test_support_does_not_grow_with_the_corpus(spark, monkeypatch, cached):
    """Contexts with 40 occurrences count, whatever their share, and also where their grams are not cached."""
    monkeypatch.setattr(lm, "CACHED", cached, raising=False)
    rows = [(i, t.decode(), None, None, None) for i, t in enumerate(TEXTS * 40 + [b"the unseen cat"])]
    docs = spark.createDataFrame(rows, DOCS)
    out = lm.score_texts(docs, ["doc_id"], F.col("doc_id") < 40 * len(TEXTS), depth=3)
    got = {r.doc_id: r.score for r in out.select("row.doc_id", "score").collect()}
    tree = tree_of(TEXTS * 40, gain=lm.GAIN_BITS)
    assert sum(len(level[0]) for level in tree.levels) > 0
    want = tree.score([lm.words_of(r[1].encode()) for r in rows])
    assert [got[r[0]] for r in rows] == pytest.approx(want.tolist())


def test_registered_depth_sees_six_bytes_back(spark):
    rows = [(i, t, None, None, None) for i, t in enumerate(["pabcdep", "qabcdeq"] * 60 + ["pabcdeq"])]
    docs = spark.createDataFrame(rows, DOCS)
    out = lm.score_texts(docs, ["doc_id"], F.col("doc_id") < 120)
    got = {r.doc_id: r.score for r in out.select("row.doc_id", "score").collect()}
    assert got[0] > got[120] + 1


def test_no_rows_and_no_training(spark):
    docs = messy(spark)
    assert spark_scores(docs.limit(0), F.lit(True)) == []
    out = spark_scores(docs, F.lit(False))
    assert len(out) == 13 and {r.train_tokens for r in out} == {0} and {r.n_known for r in out} == {0}


def test_learned_text_scores_better_than_noise():
    import random

    rng = random.Random(1)
    tree = tree_of([" ".join(words(rng, 200)).encode() for _ in range(20)], depth=4)
    fluent, noise = " ".join(words(rng, 50)).encode(), bytes(rng.choice(b"qxzjkvw ") for _ in range(300))
    a, b = tree.score([lm.words_of(fluent), lm.words_of(noise)])
    assert a / len(fluent) > b / len(noise)


def test_cache_finds_every_gram_and_no_other():
    rng = np.random.default_rng(2)
    for n in (0, 1, 5, 3000):
        known = np.unique(rng.integers(0, 1 << 56, n, dtype=np.uint64))
        if n == 5:
            known = np.unique(np.r_[known, np.uint64(0)])
        logs = -rng.random(len(known))
        packed = rng.permutation(np.r_[known, known, rng.integers(0, 1 << 56, 500, dtype=np.uint64), np.zeros(3, np.uint64)])
        order = rng.permutation(len(known)) if n else None
        got, other, distinct, which = lm._Cache(known, logs, order).find(packed)
        lookup = dict(zip(known.tolist(), logs.tolist()))
        assert got.tolist() == [lookup.get(x, 0.0) for x in packed.tolist()]
        assert sorted(other.tolist()) == [i for i, x in enumerate(packed.tolist()) if x not in lookup]
        assert distinct[which].tolist() == packed[other].tolist()


def test_slices_are_bounded_by_bytes(spark):
    """Long texts pass a few at a time, short ones by rows; every row once, in order."""
    import pyarrow as pa

    from racestream.llm import common

    texts = [b"x" * n for n in [3, 5_000_000, 0, 3_000_000, 3_000_000, 9_000_000]] + [None] + [b"yy"] * 600
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["t"])
    parts = [p.column(0).to_pylist() for p in common.slices(batch, batch.column(0))]
    assert sum(parts, []) == texts and max(map(len, parts)) <= common.SLICE_ROWS
    assert all(len(p) == 1 or sum(len(t or b"") for t in p) <= common.SLICE_BYTES for p in parts) and len(parts) < 12


def test_invalid_bytes(spark):
    docs = spark.createDataFrame([(1, bytearray(b"\xff a \xc3")), (2, bytearray(b"a"))], "doc_id long, text binary")
    out = lm.score_texts(docs, ["doc_id"], F.col("doc_id") == 1)
    got = {r.doc_id: (r.n_tokens, r.n_known) for r in out.select("row.doc_id", "n_tokens", "n_known").collect()}
    assert got[1][0] == 4 and got[2] == (2, 2)


@pytest.mark.parametrize("held", [1 << 20, 40])
def test_packed_counts_sum_to_plain_counts(monkeypatch, held):
    """However often counts are handed on, and in whichever order rows of a bucket arrive."""
    import random

    import pyarrow as pa

    monkeypatch.setattr(lm, "_HELD_GRAMS", held)
    monkeypatch.setattr(lm, "_HELD_WORDS", held)
    monkeypatch.setattr(lm, "_BUCKETS", 7)
    rng = random.Random(held)
    rows = [(" ".join(words(rng, rng.randint(0, 30))).encode(), rng.random() < 0.7) for _ in range(600)]
    rows += [(b"many times " * 200, True), (None, True), (b"", False), (b"\xff\xfe x", True), (b"\xff\xff x", True)]
    batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.binary()), pa.array([r[1] for r in part])], ["t", "y"])
               for part in (rows[:300], rows[300:])]
    packed = [r for b in batches for out in lm._counted(3)([b]) for r in out.to_pylist()]
    rng.shuffle(packed)
    packed.sort(key=lambda r: r["bucket"])
    schema = pa.schema([("bucket", pa.int32())] + [(c, pa.binary()) for c in ("words", "grams", "n", "seen")])
    parts = [pa.RecordBatch.from_pylist(packed[i:i + 5], schema) for i in range(0, len(packed), 5)]
    got = [r for out in lm._summed(parts) for r in out.to_pylist()]

    seen, n, known = Counter(), Counter(), Counter()
    for text, training in rows:
        own = Counter(lm.grams(lm.stream([lm.words_of(text)], 3), 3)[0].view(np.int64).tolist())
        seen.update(own)
        if training:
            n.update(own)
            known.update([*(w.decode("utf-8", "replace") for w in lm.words_of(text)), lm.END])
    assert {r["gram"]: (r["n"], r["seen"]) for r in got if r["word"] is None} == {k: (n[k], c) for k, c in seen.items()}
    assert {r["word"]: r["n"] for r in got if r["gram"] is None} == known
    assert len(got) == len(seen) + len(known)


def test_tables_are_built_once_in_a_worker_process():
    import numpy as np
    import pyarrow as pa

    from racestream.llm.suffix_tree_lm import _built

    class Shared:
        def __init__(self, word):
            self.value = (np.array([5], np.uint64), np.array([-1.0]), np.array([0], np.int32),
                          pa.array([word], pa.binary()), np.array([-2.0]))

    one, two = Shared(b"a"), Shared(b"b")
    assert _built(one) is _built(one) and _built(one)[0] == {b"a": 0}
    assert _built(two)[0] == {b"b": 0} and _built(one)[0] == {b"a": 0}


def test_base_scores_of_a_slice():
    import numpy as np

    from racestream.llm.suffix_tree_lm import _base_scores

    lists = [[b"a", b"x", b"b", b"x", b"\n"], [b"\n"], [b"\xff", b"y"]]
    lengths, known, logs, rare = _base_scores(lists, {b"a": 0, b"b": 1, b"\n": 2}, np.array([-1.0, -2.0, -4.0]))
    assert (lengths, known, logs) == ([5, 1, 2], [3, 1, 0], [-7.0, -4.0, 0.0])
    assert rare.to_pylist() == [[{"word": "x", "f": 2}], [], [{"word": "�", "f": 1}, {"word": "y", "f": 1}]]
