import random
import re

import pytest

from racestream.llm import jaccard_join as jj
from racestream.llm.components import components

from .fixtures import DOCS, doc, messy, messy_rows, with_clashes, words


def brute(rows, width, num, den):
    """[(doc_id, n, component)] by all pairs; rows with one id are one node, rows without id are none."""
    sets = []
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or ""))
        sets.append({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set()))
    parent = {r[0]: r[0] for r in rows if r[0] is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        for j in range(i):
            t = sets[j]
            both = len(s & t)
            if both and rows[i][0] is not None and rows[j][0] is not None and den * both >= num * len(s | t):
                a, b = sorted((find(rows[i][0]), find(rows[j][0])))
                parent[b] = a
    out = []
    for r, s in zip(rows, sets):
        if r[0] is not None:
            out.append((r[0], len(s), find(r[0])))
        else:
            same = [find(q[0]) for q, t in zip(rows, sets) if t == s and s and q[0] is not None]
            out.append((None, len(s), min(same) if same else None))
    return sorted(out, key=str)


def classes(spark, rows, **kind):
    out = jj.shingle_classes(spark.createDataFrame(rows, DOCS), **kind).collect()
    return sorted([tuple(r) for r in out], key=str)


def copies(seed, groups, sizes, rate):
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = words(rng, rng.choice(sizes))
        for _ in range(rng.randint(1, 6)):
            w = [x if rng.random() > rate else rng.choice(words(rng, 1)) for x in base]
            rows.append(doc(len(rows) * 7 % 1009, " ".join(w)))
    return rows


@pytest.mark.parametrize("seed,sizes,kind", [
    (1, [4, 5, 8, 12, 15, 18, 25, 60, 200], dict(width=4, num=85, den=100)),
    (3, [5, 9, 14, 22, 40, 90], dict(width=5, num=80, den=100)),
])
def test_against_all_pairs(spark, seed, sizes, kind):
    rows = copies(seed, 25, sizes, 0.02)
    want = brute(rows, **kind)
    assert len({c for _, _, c in want}) < len(rows)
    assert classes(spark, rows, **kind) == want


@pytest.mark.parametrize("boundary", [0, 11])
def test_any_boundary_finds_the_same(spark, monkeypatch, boundary):
    monkeypatch.setattr(jj, "choose_boundary", lambda *a: boundary)
    rows = copies(5, 20, [4, 6, 9, 13, 16, 30], 0.03)
    kind = dict(width=4, num=85, den=100)
    assert classes(spark, rows, **kind) == brute(rows, **kind)


def test_star_of_copies_that_only_link_to_their_base(spark):
    rng = random.Random(9)
    base = words(rng, 120)
    rows = [doc(500, " ".join(base))]
    for i in range(60):
        w = list(base)
        for _ in range(3):
            w[rng.randrange(120)] = f"x{i}{rng.random()}"
        rows.append(doc(i, " ".join(w)))
    kind = dict(width=4, num=85, den=100)
    assert classes(spark, rows, **kind) == brute(rows, **kind)


def test_messy_rows(spark):
    kind = dict(width=4, num=85, den=100)
    rows = messy_rows() + [doc(20, "one"), doc(21, "one two"), doc(22, "ONE two"), doc(21, "other words of that id here")]
    assert classes(spark, rows, **kind) == brute(rows, **kind)
    clash = jj.shingle_classes(with_clashes(messy(spark)), **kind)
    assert clash.columns == ["doc_id", "n_shingles", "component_id"] and clash.count() == 13
    assert classes(spark, [], **kind) == []


def test_one_of_each_class_stays(spark):
    docs = messy(spark)
    kept = jj.one_per_class(docs).select(docs.columns).collect()
    # the row without an id whose text others have goes, the one without a text stays
    assert sorted([r.doc_id for r in kept], key=str) == sorted([1, 2, 3, 4, 5, 7, 8, 9, 10, None], key=str)


def test_rows_that_share_an_id_or_have_none(spark):
    rng = random.Random(40)
    a, b, c = (" ".join(words(rng, 50)) for _ in range(3))
    rows = [doc(1, a), doc(1, b), doc(None, c), doc(None, c + " "), doc(2, a), doc(None, a), doc(None, None), doc(None, None)]
    kept = jj.one_per_class(spark.createDataFrame(rows, DOCS).repartition(4)).collect()
    assert sorted(((r.doc_id, (r.text or "").strip()) for r in kept), key=repr) == sorted(
        [(1, a), (1, b), (None, c), (None, ""), (None, "")], key=repr)
    assert kept[0].asDict().keys() == {"doc_id", "text", "lang", "source", "n_chars"}


def test_texts_go_to_python_in_small_batches(spark, monkeypatch):
    def bounded(make):
        def made(*args):
            run = make(*args)

            def checked(batches):
                def seen():
                    for b in batches:
                        assert b.num_rows <= 256
                        yield b
                return run(seen())
            return checked
        return made

    monkeypatch.setattr(jj, "_summaries", bounded(jj._summaries))
    monkeypatch.setattr(jj, "_signatures", bounded(jj._signatures))
    rng = random.Random(41)
    rows = [doc(i, " ".join(words(rng, 6))) for i in range(700)]
    docs = spark.createDataFrame(rows, DOCS).coalesce(1)
    assert jj.shingle_classes(docs, width=4, num=85, den=100).count() == 700


def test_workers_drop_what_packing_kept():
    import pyarrow as pa

    from racestream.llm import common
    from racestream.llm.tokens import vocabulary_path, word_ids

    ids = word_ids(vocabulary_path())
    assert word_ids(vocabulary_path()) is ids and ids in common._KEPT.values()
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([b"a b c d e"])], ["id", "text"])
    assert [len(list(r)) for r in jj._batches([batch])] == [2]
    assert not common._KEPT
    # of two things one stays
    common.kept_in_worker("a", list)
    assert common.kept_in_worker("b", dict) == {} and list(common._KEPT) == ["b"]
    common.release_kept()


def test_thresholds_are_exact():
    at = jj.Threshold(85, 100)
    for s in range(1, 60):
        for t in range(s, 90):
            possible = 100 * s >= 85 * t
            assert possible == (t <= at.largest(s)) == (s >= at.smallest(t))
            if possible:
                need = next(i for i in range(s + 1) if 100 * i >= 85 * (s + t - i))
                assert at.common(s, t) == need


def test_boundary_follows_cost():
    at = jj.Threshold(85, 100)
    sizes = dict.fromkeys(range(1, 25), 100)
    assert jj.choose_boundary(sizes, 0.0, at) <= jj.choose_boundary(sizes, 50.0, at)
    assert jj.choose_boundary({}, 3.0, at) == 0


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(200)] + [(900, 901), (5, 5)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {**dict.fromkeys(range(201), 0), 900: 900, 901: 900}
    assert components(links.limit(0)).count() == 0
