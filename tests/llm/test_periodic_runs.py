import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from racestream.llm.periodic_runs import SampledLce, find_runs, garbled, runs_of, strongest

from .fixtures import DOCS, doc, messy, with_clashes


def brute(words, least=24, power=3):
    found = {}
    for q in range(1, len(words) // power + 1):
        i = 0
        while i + q < len(words):
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i - s + q >= max(least, power * q) and i > s:
                found.setdefault((s, i - s + q), q)
            i = max(i, s + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def planted(rng, n, letters):
    w = [rng.randrange(letters) for _ in range(n)]
    if n > 50:
        a, p = rng.randrange(n // 2), rng.randint(1, n // 5)
        for i in range(a + p, min(n, a + p * rng.randint(2, 9))):
            w[i] = w[i - p]
    return w


@pytest.mark.parametrize("least,power", [(24, 3), (1, 2), (5, 4)])
def test_runs_against_brute_force(least, power):
    rng = random.Random(least)
    for _ in range(60):
        docs = [planted(rng, rng.choice([0, 1, 23, 24, 90, 300]), rng.choice([1, 2, 3, 40])) for _ in range(4)]
        got = runs_of([np.array(d, dtype=np.int64) for d in docs], least, power)
        assert [[tuple(r) for r in g.tolist()] for g in got] == [brute(d, least, power) for d in docs]


def test_extensions():
    rng = random.Random(2)
    codes = np.array([rng.randint(1, 2) for _ in range(400)] * 2 + [9])
    lce = SampledLce(codes)
    i, j = np.array([(a, b) for a in range(0, 800, 7) for b in range(1, 800, 11) if a != b]).T
    want = [next(k for k in range(900) if codes[a + k] != codes[b + k]) if max(a, b) < 800 else 0 for a, b in zip(i, j)]
    assert lce.query(i, j).tolist() == want


def expected(doc_id, text):
    words = garbled((text or "").encode().split(), zlib.crc32(b"" if doc_id is None else str(doc_id).encode()))
    runs = brute(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    return (len(words), runs, best, hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


def check(df, rows):
    seed = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    got = find_runs(df, df.columns, garble=seed).select("row.doc_id", "row.text", "n_words", "runs", strongest().alias("best"),
                                                        "runs_sha256", "collapsed_sha256").collect()
    assert len(got) == rows
    for r in got:
        best = r.best and tuple(r.best)
        assert (r.n_words, [tuple(x) for x in r.runs], best, r.runs_sha256, r.collapsed_sha256) == expected(r.doc_id, r.text)
    return got


def test_documents(spark):
    rng = random.Random(4)
    rows = [doc(i, " ".join(f"w{x}" for k in range(2) for x in planted(rng, rng.choice([30, 200, 400]), rng.choice([1, 3, 60]))))
            for i in range(60)]
    got = check(spark.createDataFrame(rows, DOCS).repartition(3), 60)
    assert any(len(r.runs) > 1 for r in got)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(60))


def test_messy_rows_and_clashes(spark):
    check(messy(spark).where("doc_id is null or doc_id <> 7"), 12)
    assert find_runs(with_clashes(messy(spark)), ["doc_id", "row", "n"]).count() == 13
    assert find_runs(messy(spark).limit(0), ["doc_id"]).collect() == []


def test_long_text_and_bytes_that_are_no_text(spark):
    text = " ".join(["a", "b"] * 150_000)
    broken = spark.createDataFrame([(1, text.encode()), (2, b"\xff\xfe " * 30)], "doc_id long, text binary")
    runs = {r.row.doc_id: [tuple(x) for x in r.runs] for r in find_runs(broken, ["doc_id"]).collect()}
    assert runs == {1: [(0, 300_000, 2)], 2: [(0, 30, 1)]}


def test_equal_exponents(spark):
    run = "struct<start:long,length:long,period:long>"
    rows = [([(5, 30, 10), (0, 30, 10), (0, 300, 100)],), ([(0, 31, 10), (3, 30, 9)],), ([],)]
    got = [r.b and tuple(r.b) for r in spark.createDataFrame(rows, f"runs array<{run}>").select(strongest().alias("b")).collect()]
    assert got == [(0, 30, 10), (3, 30, 9), None]
