"""Exact top-k inner-product search with block-at-a-time pruning.

Vectors (their components as integers) are dealt by hash into shards of bounded
size, queries into chunks of bounded size; a (shard, chunk) pair is one Spark
group. In a shard the vectors, ordered by their strongest component, form
blocks with a forward index (the block's matrix) and, per component, the
largest and smallest value. For a query the summed component maxima

    sum over q_d > 0 of q_d * max_d  +  sum over q_d < 0 of q_d * min_d

bound every score of the block. Blocks are scored in descending order of that
bound until it falls below the query's k-th score; a block whose bound equals it
is still scored, because ties go to the smaller id. The shards' answers are
merged by a window.

Defined results: vectors that are null or hold a null or non-finite component
take no part, nor do rows without an id; an empty vector scores 0; components
are limited to +-2^62 and scores to the range of a long; missing components of
shorter vectors count as 0. Repeated ids are rows of their own (a query skips
only its own row).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, table

SHARD_VECTORS, CHUNK_QUERIES, BLOCK_VECTORS = 4096, 1024, 128
_LIMIT = float(1 << 62)
_LONG = (-(1 << 63), (1 << 63) - 1)


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, scale: float = 256.0) -> DataFrame:
    """``uid, id, v``: component x becomes floor(scale * x), x as double."""
    doubles = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    bad = F.exists(doubles, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(doubles, lambda x: F.greatest(F.least(F.floor(x * scale).cast("double"), F.lit(_LIMIT)),
                                                      F.lit(-_LIMIT)).cast("long"))
    kept = F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & ~F.coalesce(bad, F.lit(False))
    return df.where(kept).select(F.monotonically_increasing_id().alias("uid"),
                                 F.col(id_col).cast("long").alias("id"), whole.alias("v"))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    if all(len(v) == width for v in vectors):
        return np.stack(vectors.to_numpy()).reshape(len(vectors), width).astype(np.int64)
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _exact(a: np.ndarray, b: np.ndarray):
    """Both in a number type in which a @ b.T is exact."""
    top = float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(b.astype(float)).max(initial=0)) * max(1, a.shape[1])
    kind = np.float64 if top < 2.0 ** 53 else object
    return a.astype(kind), b.astype(kind)


class BlockIndex:
    """Blocks of one shard: component bounds and forward index."""

    def __init__(self, ids: np.ndarray, uids: np.ndarray, matrix: np.ndarray, block: int = BLOCK_VECTORS):
        n, width = matrix.shape
        if width:
            strongest = np.abs(matrix).argmax(1)
            signed = strongest * 2 + (matrix[np.arange(n), strongest] < 0)
            order = np.lexsort((-np.abs(matrix).max(1), signed))
        else:
            order = np.arange(n)
        self.ids, self.uids, self.rows = ids[order], uids[order], matrix[order]
        starts = np.arange(0, n, block)
        self.spans = [(s, min(n, s + block)) for s in starts]
        self.high = np.maximum.reduceat(self.rows, starts, axis=0)
        self.low = np.minimum.reduceat(self.rows, starts, axis=0)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        up, high = _exact(np.maximum(queries, 0), self.high)
        down, low = _exact(np.minimum(queries, 0), self.low)
        return up @ high.T + down @ low.T

    def top(self, query: np.ndarray, uid: int, bounds: np.ndarray, rows: np.ndarray, k: int):
        """Up to k (score, id, uid), and the number of blocks scored."""
        best: list[tuple] = []
        scored = 0
        for b in np.argsort(-bounds, kind="stable"):
            if len(best) == k and bounds[b] < best[-1][0]:
                break
            scored += 1
            s, e = self.spans[b]
            scores = rows[s:e] @ query
            if len(best) == k:
                near = np.flatnonzero(scores >= best[-1][0])
            elif len(scores) > k + 1 and scores.dtype != object:
                near = np.flatnonzero(scores >= np.partition(scores, -(k + 1))[-(k + 1)])
            else:
                near = np.arange(len(scores))
            best += [(min(max(int(scores[i]), _LONG[0]), _LONG[1]), int(self.ids[s + i]), int(self.uids[s + i])) for i in near if self.uids[s + i] != uid]
            best = sorted(best, key=lambda x: (-x[0], x[1], x[2]))[:k]
        return best, scored


def _search(k: int):
    def search(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(vectors) and len(queries):
            width = max(int(vectors.v.map(len).max()), int(queries.q.map(len).max()))
            vectors, queries = vectors.sort_values("uid"), queries.sort_values("query_uid")
            index = BlockIndex(vectors.id.to_numpy(), vectors.uid.to_numpy(), _matrix(vectors.v, width))
            q = _matrix(queries.q, width)
            rows, exact_q = _exact(index.rows, q)
            for uid, qid, query, bounds in zip(queries.query_uid, queries.query_id, exact_q, index.bounds(q)):
                best, scored = index.top(query, uid, bounds, rows, k)
                out += [(uid, qid, u, i, s, scored, len(index.spans)) for s, i, u in best]
        return pd.DataFrame(out, columns=["query_uid", "query_id", "uid", "vec_id", "score", "scored", "blocks"])
    return search


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score, scored, blocks`` for the rows of ``uid, id, v`` that are queries."""
    vectors = materialise(vectors, "vectors")
    queries = vectors.where(is_query)
    shards = max(1, -(-vectors.count() // SHARD_VECTORS))
    chunks = max(1, -(-queries.count() // CHUNK_QUERIES))

    def dealt(df, uid, own, n, other, m):
        return (df.withColumn(own, F.pmod(F.xxhash64(uid, F.lit(own)), F.lit(n)))
                .withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long")))))

    # every chunk of the query set meets every shard, block by block
    a = dealt(vectors, "uid", "shard", shards, "chunk", chunks).groupBy("shard", "chunk")
    b = dealt(queries.toDF("query_uid", "query_id", "q"), "query_uid", "chunk", chunks, "shard", shards).groupBy("shard", "chunk")
    found = a.cogroup(b).applyInPandas(
        _search(k), "query_uid long, query_id long, uid long, vec_id long, score long, scored int, blocks int")
    order = Window.partitionBy("query_uid").orderBy(F.desc("score"), "vec_id", "uid")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score", "scored", "blocks"))


def q_op9_topk(spark, sf_dir: str) -> DataFrame:
    vectors = integer_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return top_k(vectors, F.col("id") % 50 == 0).select("query_id", "rank", "vec_id", "score")


OP9_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.e, v.e)::BIGINT AS score
  FROM v AS q JOIN v ON q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
