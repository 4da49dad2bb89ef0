"""Size-aware n-gram Jaccard self-join (heavy-light), with components.

A document's set is that of its distinct word shingles. Two sets s, t link when
``den * |s and t| >= num * |s or t|``; then they share at least
``c(s, t) = ceil(num * (|s| + |t|) / (num + den))`` shingles, and neither is
smaller than num/den of the other.

* *Light*: a pair whose smaller set has at most B shingles is found by
  enumerating fixed-size subsets. For every size c that a partner may require,
  a set emits each of its subsets of that size as a key; sets that link share one.
* *Heavy*: pairs of larger sets are found by scanning inverted lists. Sets are
  ordered by one total order of shingles, rare ones first; sets that link share
  a key among the first ``|s| - ceil(num/den * |s|) + 1``.
* The *boundary* B minimises the summed cost over the size histogram: subsets
  to emit against list entries to scan (prefix length times the mean list length).

Lists are never expanded into all pairs. First each member is compared with its
list's pivot, the member with the fewest shingles of its own; verified links
give components. Then only members of one list that are still in *different*
components are compared with each other, so a large group of copies costs
about its size, and no link between texts that are not already connected is
lost. Sizes, and how many keys before a common one no other set lists, prune
candidates in the lists, whole prefixes the pairs; what is left is verified on
the whole texts. Exact copies are one set from the start.

The order uses the counts of shingles that repeat within parts of the input
(the ``FREQUENT`` most common, broadcast). It decides which keys are scanned, not
what is found: any order gives the same links.

Shingles are 64-bit hashes of word sequences, sets 128-bit hashes.

Defined results: null or wordless text has the empty set and links with nothing;
with fewer words than a shingle the whole sequence is one shingle. Rows with
the same id are one node; a row without an id is not a node itself but gets
the class of its set if a row with an id has it. Repeated rows each get a result row.
"""

from __future__ import annotations

from itertools import chain, combinations
from math import comb

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scoped_conf
from .common import TEXT_BATCHES, materialise, release_kept, slices, table
from .components import components
from .url_filter import build_filter, might_contain

FREQUENT = 65_536
MAX_BOUNDARY = 24
_CHUNK = 1 << 21
_MUL, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_digest = xxhash.xxh3_64_intdigest


def words_of(text: bytes | None) -> list[bytes]:
    """Runs of bytes other than space and \\t \\n \\v \\f \\r, A-Z lower-cased."""
    return text.lower().split() if text else []


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def _sequence_hash(columns: list[np.ndarray]) -> np.ndarray:
    h = np.full(len(columns[0]), len(columns), dtype=np.uint64)
    for c in columns:
        h = _mixed(h * _MUL + c)
    return h


def shingle_sets(texts: list[bytes | None], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of whole texts."""
    lists = [words_of(t) for t in texts]
    total = sum(map(len, lists))
    flat = np.fromiter(map(_digest, chain.from_iterable(lists)), np.uint64, total)
    rolled = _sequence_hash([flat[i:total - width + 1 + i] for i in range(width)]) if total >= width else flat
    out, at = [], 0
    for n in map(len, lists):
        if n >= width:
            out.append(np.unique(rolled[at:at + n - width + 1]))
        else:
            out.append(_sequence_hash([flat[at + i:at + i + 1] for i in range(n)]) if n else np.empty(0, np.uint64))
        at += n
    return out


class Threshold:
    """Exact integer arithmetic for ``den * |and| >= num * |or|``."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def common(self, s: int, t: int) -> int:
        return -(-self.num * (s + t) // (self.num + self.den))

    def largest(self, s: int) -> int:
        return self.den * s // self.num

    def smallest(self, s: int) -> int:
        return -(-self.num * s // self.den)

    def prefix(self, s: int) -> int:
        return s - self.smallest(s) + 1

    def subset_sizes(self, s: int, boundary: int) -> list[int]:
        """Sizes c(s, t) over partners t such that the smaller of both is light."""
        return sorted({self.common(s, t) for t in range(self.smallest(s), self.largest(s) + 1)
                       if min(s, t) <= boundary})

    def subset_cost(self, s: int, boundary: int) -> int:
        return sum(comb(s, c) for c in self.subset_sizes(s, boundary))


def choose_boundary(sizes: dict[int, int], list_length: float, at: Threshold) -> int:
    """The B of least cost: subsets emitted for light sets, list entries scanned for heavy ones."""
    small = [s for s in sizes if s <= at.largest(MAX_BOUNDARY)]

    def cost(boundary):
        light = sum(sizes[s] * at.subset_cost(s, boundary) for s in small if at.smallest(s) <= boundary)
        return light + sum(sizes[s] * at.prefix(s) * (1 + list_length) for s in small if s > boundary)
    return min(range(MAX_BOUNDARY + 1), key=cost)


# ---- passes over the texts ----------------------------------------------------------------------

def _batches(batches):
    """(ids, texts) of Arrow batches with the columns id, text, in bounded slices."""
    release_kept()
    for batch in batches:
        for part in slices(batch, batch.column(1)):
            yield part.column(0).to_pylist(), part.column(1).to_pylist()


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _summaries(width: int):
    """Rows of kind 0: id, set size, digest. Kind 1: shingle and its count in a part
    of the input, where it repeats. Kind 2: sums of squared counts and of counts."""
    import pyarrow as pa

    names = ["kind", "doc_id", "n", "d0", "d1"]

    def counted(parts):
        s, c = np.unique(np.concatenate(parts), return_counts=True)
        often = c >= 3
        k = int(often.sum())
        long = lambda x: pa.array(x, pa.int64())
        return pa.RecordBatch.from_arrays([
            pa.array([1] * k + [2], pa.int32()), pa.nulls(k + 1, pa.int64()),
            long(c[often].tolist() + [int((c * c).sum())]),
            long(s[often].view(np.int64).tolist() + [int(c.sum())]), long([0] * (k + 1))], names)

    def run(batches):
        parts, held = [], 0
        for ids, texts in _batches(batches):
            n, d0, d1 = [], [], []
            for s in shingle_sets(texts, width):
                d = xxhash.xxh3_128_intdigest(s.tobytes())
                n.append(len(s))
                d0.append(_signed(d >> 64))
                d1.append(_signed(d & (1 << 64) - 1))
                if len(s):
                    parts.append(s)
                    held += len(s)
                    if held >= _CHUNK:
                        yield counted(parts)
                        parts, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array([0] * len(ids), pa.int32()), pa.array(ids, pa.int64()),
                                              *(pa.array(x, pa.int64()) for x in (n, d0, d1))], names)
        if parts:
            yield counted(parts)
    return run


def _weights(s: np.ndarray, shared) -> np.ndarray:
    """Place of shingles in the order, before their hash: 0, or 1 + rank for frequent ones."""
    frequent, rank = shared
    if not len(frequent):
        return np.zeros(len(s), np.int64)
    found = np.searchsorted(frequent, s)
    found[found == len(frequent)] = 0
    return np.where(frequent[found] == s, rank[found] + 1, 0)


def prefix_of(s: np.ndarray, at: Threshold, shared) -> np.ndarray:
    """The first shingles of a set in the order, as many as may have to be scanned."""
    return s[np.lexsort((s, _weights(s, shared)))][:at.prefix(len(s))]


def subset_keys(s: np.ndarray, boundary: int, at: Threshold) -> list[int]:
    """One key for every subset of every size that a light pair may have to share."""
    return list({_signed(_digest(np.array([c, *subset], np.uint64).tobytes()))
                 for c in at.subset_sizes(len(s), boundary) for subset in combinations(s.tolist(), c)})


def most_common(p: np.ndarray, s: int, q: np.ndarray, t: int, shared) -> int:
    """An upper bound of the shingles that two sets share, from their prefixes and sizes.

    Up to the smaller of both last places the prefixes are complete, so there
    the number of common shingles is known.
    """
    wp, wq = _weights(p, shared), _weights(q, shared)
    cut_w, cut_h = min((wp[-1], p[-1]), (wq[-1], q[-1]))
    p = p[(wp < cut_w) | ((wp == cut_w) & (p <= cut_h))]
    q = q[(wq < cut_w) | ((wq == cut_w) & (q <= cut_h))]
    return len(np.intersect1d(p, q, assume_unique=True)) + min(s - len(p), t - len(q))


def _signatures(width: int, boundary: int, at: Threshold, shared):
    """Rows node, n, prefix (of sets above the boundary), subsets (keys for light pairs)."""
    import pyarrow as pa

    def lists(parts):
        ends = np.cumsum([0, *map(len, parts)])
        values = np.concatenate([*parts, np.empty(0, np.int64)]) if parts else np.empty(0, np.int64)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.astype(np.int64)))

    def run(batches):
        none = np.empty(0, np.int64)
        for ids, texts in _batches(batches):
            node, n, prefix, subsets = [], [], [], []
            for i, s in zip(ids, shingle_sets(texts, width)):
                if i is None or not len(s):
                    continue
                node.append(i)
                n.append(len(s))
                prefix.append(prefix_of(s, at, shared.value).view(np.int64) if len(s) > boundary else none)
                light = at.smallest(len(s)) <= boundary
                subsets.append(np.array(subset_keys(s, boundary, at), np.int64) if light else none)
            yield pa.RecordBatch.from_arrays(
                [pa.array(node, pa.int64()), pa.array(n, pa.int64()), lists(prefix), lists(subsets)],
                ["node", "n", "prefix", "subsets"])
    return run


def _plausible(at: Threshold, shared):
    """From (a, b, n_a, prefix_a, n_b, prefix_b) the pairs that the prefixes do not rule out."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            out = []
            ids = batch.select([0, 1, 2, 4]).to_pydict()
            pa_list, pb_list = batch.column(3), batch.column(5)
            for k, (a, b, s, t) in enumerate(zip(*ids.values())):
                p = pa_list[k].values.to_numpy().view(np.uint64)
                q = pb_list[k].values.to_numpy().view(np.uint64)
                if not len(p) or not len(q) or most_common(p, s, q, t, shared.value) >= at.common(s, t):
                    out.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], ["a", "b"])
    return run


def _verified(width: int, at: Threshold):
    """From (a, b, text_a, text_b) the pairs that link."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            # the texts of a pair that may link are of like length
            for part in slices(batch, batch.column(3)):
                a, b, left, right = (c.to_pylist() for c in part.columns)
                known = list(dict.fromkeys(left))  # the pairs of one a come together
                sets = dict(zip(known, shingle_sets(known, width)))
                out = []
                for i, j, x, t in zip(a, b, left, shingle_sets(right, width)):
                    s = sets[x]
                    both = len(np.intersect1d(s, t, assume_unique=True))
                    if both and at.den * both >= at.num * (len(s) + len(t) - both):
                        out.append((i, j))
                yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], ["a", "b"])
    return run


# ---- the join -----------------------------------------------------------------------------------

def _may_link(at: Threshold):
    """Size and place tests on two members of a list, (n, at, before) and (n2, at2, before2).

    Sets that share c shingles share one among the first n - c + 1 of both, so
    only such common keys make a pair.

    ``before`` counts the keys of a set before this place that any other set
    lists as well. A key before this place that none lists is not in the other
    set at all, or it would be listed there too. So the sets share at most the
    smaller ``before``, this key, and what comes after it in both.
    """
    s, t, i, j = F.col("n"), F.col("n2"), F.col("at"), F.col("at2")
    sizes = (at.den * F.least(s, t)) >= (at.num * F.greatest(s, t))
    common = F.ceil(at.num * (s + t) / (at.num + at.den))
    most = F.least("before", "before2") + 1 + F.least(s - 1 - i, t - 1 - j)
    early = (i <= s - common) & (j <= t - common)
    return sizes & ((i < 0) | (j < 0) | (early & (most >= common)))


def _links(pairs: DataFrame, sets: DataFrame, source: DataFrame, width: int, at: Threshold, shared) -> DataFrame:
    """The pairs (a, b) that link. The prefixes rule most others out; the rest is verified on whole texts."""
    of = lambda c: sets.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("prefix").alias(f"prefix_{c}"))
    likely = materialise(
        pairs.join(of("b"), "b").join(of("a"), "a").select("a", "b", "n_a", "prefix_a", "n_b", "prefix_b")
        .mapInArrow(_plausible(at, shared), "a long, b long").distinct(), "likely")
    nodes = likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct()
    # a Bloom filter of fixed size keeps most other texts out of the shuffle; the join is exact
    bloom = build_filter(nodes.select(F.col("node").cast("string").alias("key")))
    texts = (might_contain(source.select(F.col("doc_id").alias("node"), "text", F.col("doc_id").cast("string").alias("key"))
                           .where("node is not null"), bloom)
             .select("node", "text").join(nodes, "node", "left_semi"))
    texts = materialise(texts, "texts")
    right = likely.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    both = right.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_verified(width, at), "a long, b long").distinct()


def shingle_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    num: int = 80, den: int = 100) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``."""
    spark, at = docs.sparkSession, Threshold(num, den)
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                         F.col(f"`{text_col}`").cast("binary").alias("text"))

    with scoped_conf(spark, TEXT_BATCHES):
        found = materialise(source.mapInArrow(_summaries(width), "kind int, doc_id long, n long, d0 long, d1 long"), "sets")
    sets = found.where("kind = 0 and n > 0")
    reps = sets.groupBy("d0", "d1").agg(F.min("doc_id").alias("rep"))

    # order and boundary: FREQUENT shingles, MAX_BOUNDARY size counts and one mean
    top = (found.where("kind = 1").groupBy(F.col("d0").alias("shingle")).agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "shingle").limit(FREQUENT).collect())
    top.sort(key=lambda r: (r["n"], r["shingle"]))
    shingles = np.array([r["shingle"] for r in top], np.int64).view(np.uint64)
    order = np.argsort(shingles)
    shared = spark.sparkContext.broadcast((shingles[order], order))
    squares, total = found.where("kind = 2").agg(F.sum("n"), F.sum("d0")).first()
    sizes = {r["n"]: r["count"] for r in
             sets.where(F.col("n") <= at.largest(MAX_BOUNDARY)).groupBy("n").count().collect()}
    boundary = choose_boundary(sizes, float(squares) / total if total else 0.0, at)

    # one row per distinct set: that of its smallest id
    with scoped_conf(spark, TEXT_BATCHES):
        members = materialise(
            source.mapInArrow(_signatures(width, boundary, at, shared), "node long, n long, prefix array<long>, subsets array<long>")
            .join(reps.select(F.col("rep").alias("node")).distinct(), "node", "left_semi"), "members")
    postings = (members.select(F.posexplode("prefix").alias("at", "key"), "node", "n").select("key", "node", "n", "at")
                .union(members.select(F.explode("subsets").alias("key"), "node", "n", F.lit(-1).alias("at"))))
    shared_keys = postings.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key")
    # a set's own keys, at most its prefix: how many come before, and how many no other set lists
    own = Window.partitionBy("node")
    alone = F.max("at").over(own) + 1 - F.count(F.lit(1)).over(own)
    live = materialise(
        postings.join(shared_keys, "key", "left_semi")
        .withColumn("before", F.row_number().over(own.orderBy("at", "key")) - 1)
        .withColumn("alone", F.when(F.col("at") < 0, 0).otherwise(F.floor(1000 * alone / F.col("n")))), "live")
    # the pivot of a list: the member with the least of its own, which near copies are nearest to
    pivots = (live.groupBy("key").agg(F.min(F.struct("alone", "node", "n", "at", "before")).alias("p"))
              .select("key", F.col("p.node").alias("pivot"), F.col("p.n").alias("n2"), F.col("p.at").alias("at2"),
                      F.col("p.before").alias("before2")))
    first = materialise(live.join(pivots, "key").where((F.col("node") != F.col("pivot")) & _may_link(at))
                        .select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct(), "pairs")
    # rows that share an id but not their set tie the classes of both sets together
    several = (sets.where("doc_id is not null").groupBy("doc_id")
               .agg(F.min(F.struct("d0", "d1")).alias("x"), F.max(F.struct("d0", "d1")).alias("y"))
               .where("x <> y").select("doc_id"))
    same_id = sets.join(several, "doc_id").join(reps, ["d0", "d1"]).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    with scoped_conf(spark, TEXT_BATCHES):
        links = materialise(_links(first, members, source, width, at, shared).union(same_id), "links")
    labels = components(links)

    # members of one list that are still apart
    state = (live.join(labels, "node", "left")
             .select("key", "node", "n", "at", "before", F.coalesce("component", "node").alias("label")))
    state = materialise(state, "state")
    apart = state.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select("key")
    open_lists = materialise(state.join(apart, "key", "left_semi"), "open")
    other = open_lists.toDF("key", "b", "n2", "at2", "before2", "label2")
    second = (open_lists.withColumnRenamed("node", "a").join(other, "key")
              .where((F.col("a") < F.col("b")) & (F.col("label") != F.col("label2")) & _may_link(at))
              .select("a", "b").distinct().join(first, ["a", "b"], "left_anti"))
    second = materialise(second, "pairs")
    with scoped_conf(spark, TEXT_BATCHES):
        links = materialise(links.union(_links(second, members, source, width, at, shared)), "links")
    labels = components(links)

    # written, so that Spark can split the rows of a set with very many copies in the last join
    classes = materialise(reps.join(labels.toDF("rep", "component"), "rep", "left")
                          .select("d0", "d1", F.coalesce("component", "rep").alias("component")), "classes")
    return (found.where("kind = 0").join(classes, ["d0", "d1"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id")))


def one_per_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kind) -> DataFrame:
    """One row of ``docs`` of each class of linked texts: that of the smallest id.

    Classes are those of rows, whatever their ids: rows that share an id but not their text
    are texts of their own, and rows without an id go if another row of their class stays (among
    themselves, and where ids are equal too, the smallest hash of the text stays). Rows without words
    link with nothing and stay.
    """
    numbered = materialise(docs.withColumn("_near_row", F.monotonically_increasing_id()), "numbered")
    classes = shingle_classes(numbered, "_near_row", text_col, **kind).select(
        F.col("doc_id").alias("_near_row"), F.col("component_id").alias("_near_class"))
    rank = F.struct(F.col(f"`{id_col}`").isNull(), F.col(f"`{id_col}`"), F.xxhash64(F.col(f"`{text_col}`")), "_near_row")
    best = (numbered.select("_near_row", rank.alias("_near_rank")).join(classes, "_near_row")
            .groupBy("_near_class").agg(F.min_by("_near_row", "_near_rank").alias("_near_row")))
    return numbered.join(best.select("_near_row"), "_near_row", "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def q_op5_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return shingle_classes(table(spark, sf_dir, "documents"), width=4, num=85, den=100)


OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) = 0 THEN []
           WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
           ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END)) AS sh
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n
  HAVING 100 * count(*) >= 85 * (na.n + nb.n - count(*))),
reach(x, y) AS (
  SELECT x, y FROM links
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
c AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(c.y, w.doc_id)) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.x = w.doc_id
"""
