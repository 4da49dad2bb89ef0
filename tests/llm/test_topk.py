import math
import random

import pytest
from pyspark.sql import functions as F

from racestream.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, uid string"


def brute(rows, every, k=5):
    good = [(i, [math.floor(256 * float(x)) for x in v]) for i, v, *_ in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, v) in enumerate(good):
        if i % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(v, w)), j) for b, (j, w) in enumerate(good) if b != a)
            out += [(i, r, j, -s) for r, (s, j) in enumerate(scores[:k], 1)]
    return sorted(out)


def search(spark, rows, every):
    vectors = topk.integer_vectors(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding")
    out = topk.top_k(vectors, F.col("id") % every == 0)
    return sorted(tuple(r)[:4] for r in out.collect())


def f32(x):
    import numpy as np

    return float(np.float32(x))


def test_against_brute_force_over_shards_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_VECTORS", 150)
    monkeypatch.setattr(topk, "CHUNK_QUERIES", 20)
    monkeypatch.setattr(topk, "BLOCK_VECTORS", 16)
    rng = random.Random(3)
    rows = [(i, [f32(rng.gauss(0, 0.2)) for _ in range(8)], 0, "u") for i in range(500)]
    rows += [(1000 + i, rows[7][1], 0, "u") for i in range(60)]  # one very common vector
    assert search(spark, rows, 10) == brute(rows, 10)


def test_messy_vectors(spark):
    rows = [(0, [1.0, 2.0], 0, "u"), (1, None, 0, None), (2, [float("nan"), 1.0], 0, "u"), (3, [None, 1.0], 0, "u"),
            (4, [float("inf"), 1.0], 0, "u"), (None, [9.0, 9.0], 0, "u"), (5, [], 0, "u"), (6, [1.0, 2.0, 4.0], 1, "u"),
            (7, [f32(-0.001), 2.0], None, "u"), (0, [1.0, 2.0], 0, "u"), (10, [0.5, 0.5], 0, "u")]
    got = search(spark, rows, 5)
    assert len(got) == len(brute(rows, 5)) and got == brute(rows, 5)
    assert search(spark, [], 5) == [] and search(spark, rows[:1], 5) == []


def test_large_components_are_exact(spark):
    rows = [(i, [f32(1e6 + i / 16), f32(-1e5)], 0, "u") for i in range(4)]
    assert search(spark, rows, 2) == brute(rows, 2) and brute(rows, 2)[0][3] > 2 ** 53
    # beyond a long, scores tie at its limit
    huge = [(i, [f32(3e12 + i * 1e9)], 0, "u") for i in range(8)]
    assert [r[2:] for r in search(spark, huge, 8)] == [(i, (1 << 63) - 1) for i in range(1, 6)]


def test_bounds_hold_and_blocks_are_skipped():
    import numpy as np

    rng = np.random.default_rng(1)
    centres = rng.integers(-400, 400, (40, 16))
    rows = np.repeat(centres, 50, axis=0) + rng.integers(-8, 8, (2000, 16))
    index = topk.BlockIndex(np.arange(2000), np.arange(2000), rows, 50)
    query = rows[3]
    bounds = index.bounds(query[None, :])[0]
    for b, (s, e) in enumerate(index.spans):
        assert (index.rows[s:e] @ query).max() <= bounds[b]
    best, scored = index.top(query.astype(float), 3, bounds, index.rows.astype(float), 5)
    scores = rows @ query
    assert [x[0] for x in best] == sorted((int(s) for i, s in enumerate(scores) if i != 3), reverse=True)[:5]
    assert scored < len(index.spans)


@pytest.mark.parametrize("n", [3, 6])
def test_fewer_than_k(spark, n):
    rows = [(i, [float(i)], 0, "u") for i in range(n)]
    assert search(spark, rows, 1) == brute(rows, 1)
