import random
import re

import pytest

from racestream.llm import decontaminate as dc

from .fixtures import DOCS, doc, messy_rows, with_clashes, words


def brute(docs, items, window=10):
    split = lambda t: re.findall(dc.WORD, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    patterns = {}
    for i, t in items:
        w = split(t)
        for a in range(max(1, len(w) - window + 1) if w else 0):
            patterns.setdefault(tuple(w[a:a + window]), set()).add(i)
    out = []
    for d in docs:
        w, hit, found = split(d[1]), set(), set()
        for n in {len(p) for p in patterns}:
            for a in range(len(w) - n + 1):
                if (ids := patterns.get(tuple(w[a:a + n]))) is not None:
                    hit |= set(range(a, a + n))
                    found |= ids
        out.append((d[0], len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return sorted(out, key=str)


def data():
    rng = random.Random(4)
    items = [(i, " ".join(words(rng, n))) for i, n in enumerate([40, 12, 10, 9, 3, 1, 25])]
    items += [(0, items[0][1]), (30, items[1][1]), (None, "only null id here"), (31, None), (32, " .. "), (33, "")]
    docs = list(messy_rows())
    for i in range(40):
        w = words(rng, 80)
        for _ in range(rng.randint(0, 3)):
            source = rng.choice(items)[1] or ""
            part = source.split()
            cut = rng.randint(0, 6)
            at = rng.randrange(60)
            w[at:at] = part[cut:cut + rng.choice([9, 10, 11, 40])]
        docs.append(doc(100 + i, ", ".join(w).upper() if i % 3 else " ".join(w)))
    docs.append(doc(200, " ".join(["on"] * 300)))
    items.append((40, " ".join(["on"] * 11)))
    return docs, items


@pytest.mark.parametrize("pass_rows", [500_000, 25])
def test_against_brute_force(spark, pass_rows):
    docs, items = data()
    table = spark.createDataFrame(items, "item_id long, text string")
    out = dc.find_contamination(with_clashes(spark.createDataFrame(docs, DOCS)), table, ["doc_id", "hits", "items"],
                                pass_rows=pass_rows)
    got = out.select("row.doc_id", "n_words", dc.n_hit_words().alias("n"), "items", "row.hits").collect()
    assert sorted([tuple(r)[:4] for r in got], key=str) == brute(docs, items)
    assert {r[4] for r in got} == {"x"}


def test_empty_tables(spark):
    docs, items = data()
    items, docs = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, DOCS)
    assert dc.find_contamination(docs.limit(0), items, ["doc_id"]).count() == 0
    clean = dc.find_contamination(docs, items.limit(0), ["doc_id"]).where("size(hits) > 0 or size(items) > 0")
    assert clean.count() == 0


def test_shifts_skip_words():
    rng = random.Random(1)
    searcher = dc.WuManber({tuple(w.encode() for w in words(rng, 10)): ["1"]})

    class Counting(list):
        looked = 0

        def __getitem__(self, i):
            Counting.looked += 1
            return super().__getitem__(i)

    assert list(searcher.search(Counting([b"zz"] * 1000))) == []
    assert Counting.looked <= 101
