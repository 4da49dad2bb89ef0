"""Language-model scoring with a probabilistic suffix tree over bytes.

A text is its lower-cased words with one space between them and an end sign.
The tree predicts the next byte from the longest *retained* suffix of the up to
``DEPTH`` bytes before it:

* counts: every (DEPTH + 1)-gram of the training texts, counted by part of the input, packed
  into buckets by a hash, shuffled and summed by bucket; shorter contexts are sums over their extensions;
* a context is a candidate if it occurs ``MIN_CONTEXT`` times, at every size of
  the corpus;
* *divergence test*: a candidate is retained if its own next-byte distribution
  saves at least ``GAIN_BITS`` bits per distinct successor on the training
  positions against the distribution of the suffix it extends;
* *smoothing*: a retained context s gives
  P(c|s) = (n(sc) + t(s) P(c|suffix)) / (n(s) + t(s)), with t(s) the number of
  distinct successors. The root is add-one over 256 bytes. Each distribution
  sums to one.

A text's score is the log10 probability of its bytes, end sign included. Every
training position is counted, and contexts and grams stay in Spark tables that
grow with the corpus: level by level, each distinct gram of the texts gets its
probability by a join with the level of its suffix. Texts find the ``CACHED``
most frequent grams in a broadcast table; all their other grams are joined.

The word counts behind the unigram base score are exact and grow with the
corpus: the ``COMMON`` most frequent words are looked up in a broadcast table, all
others are joined.

Defined results: null, empty and wordless texts are the end token alone;
repeated rows are scored (and trained on) each; with no training text every
count is 0; a very long text is scored whole, in a slice of its own; invalid UTF-8 is
scored byte by byte, and its words are counted with replacement characters. Input
columns travel in the struct ``row``, so their names never clash.
"""

from __future__ import annotations

from collections import Counter
from itertools import chain, repeat
from math import fsum
from zlib import crc32

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fold, map_text, materialise, slices, table

DEPTH = 6
MIN_CONTEXT = 32
GAIN_BITS = 4.0
COMMON = 1 << 17
CACHED = 1 << 21
END = "\n"
_HELD_GRAMS, _HELD_WORDS = 1 << 22, 1 << 18
#: counts are shuffled and summed by bucket; Python holds the distinct grams of one of them
_BUCKETS = 1 << 12
_BYTE = np.uint64(8)


def words_of(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


def stream(word_lists: list[list[bytes]], depth: int) -> np.ndarray:
    """The byte streams of texts, each behind ``depth`` spaces that stand for its start."""
    pad = b" " * depth
    return np.frombuffer(b"".join([pad + b" ".join(w) + b"\n" for w in word_lists]), dtype=np.uint8)


def grams(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """All (depth + 1)-grams that predict a byte of a text, and where they end."""
    n = len(data) - depth
    # eight bytes from every place on, first byte highest
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    packed = np.ndarray((n,), ">u8", padded, strides=(1,)).astype(np.uint64) >> np.uint64(8 * (7 - depth))
    # words hold neither space nor newline, so a newline is a text's end: the next `depth` bytes are padding
    ends = np.flatnonzero(data == 10)
    real = np.ones(len(data), bool)
    for j in range(1, depth + 1):
        real[np.minimum(ends + j, len(data) - 1)[ends + j < len(data)]] = False
    real[:depth] = False
    return packed[real[depth:]], np.flatnonzero(real)


def _merged(parts):
    """Sums of parts (grams, n, seen): each gram once, sorted."""
    k = np.concatenate([p[0] for p in parts])
    order = np.argsort(k)
    k = k[order]
    first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
    return k[first], *[np.add.reduceat(np.concatenate([p[i] for p in parts])[order], first, dtype=np.int64) for i in (1, 2)]


_PACKED = "bucket int, words binary, grams binary, n binary, seen binary"


def _counted(depth: int):
    """Counts of one part of the input, packed: one row per bucket of words, or of grams, with
    arrays of eight-byte grams and of counts, in one byte each where all of a row's are below 256, else eight.
    n counts training texts (second column true), seen all texts; words are those of training texts, a
    line each, and the end sign is the empty one."""
    import pyarrow as pa

    names = ["bucket", "words", "grams", "n", "seen"]

    def word_rows(words):
        lines = [w if w.isascii() else w.decode("utf-8", "replace").encode() for w in words]
        bucket = np.fromiter(map(crc32, lines), np.uint32, len(lines)).astype(np.uint16) % np.uint16(_BUCKETS)
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        ends = np.r_[first, len(bucket)]
        sorted_lines = [lines[i] for i in order.tolist()]
        joined = [b"\n".join(sorted_lines[i:j]) for i, j in zip(ends.tolist(), ends[1:].tolist())]
        n = np.fromiter(words.values(), np.int64, len(lines))[order]
        counts = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer((ends * 8).astype(np.int32)), pa.py_buffer(n)])
        none = pa.nulls(len(first), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket[first].astype(np.int32)), pa.array(joined, pa.binary()), none, counts, none], names)

    def gram_rows(*arrays):
        few = arrays[2] < 256
        for some, kind in ((few, np.uint8), (~few, np.int64)):
            k, n, seen = (x[some] for x in arrays)
            for at in range(0, len(k), _HELD_GRAMS):
                yield bucket_rows(*(x[at:at + _HELD_GRAMS] for x in (k, n.astype(kind), seen.astype(kind))))

    def bucket_rows(keys, n, seen):
        bucket = (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.uint16) % np.uint16(_BUCKETS)
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        ends = np.r_[first, len(bucket)]
        packed = [pa.Array.from_buffers(pa.binary(), len(first), [
            None, pa.py_buffer((ends * x.itemsize).astype(np.int32)), pa.py_buffer(x[order])]) for x in (keys, n, seen)]
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket[first].astype(np.int32)), pa.nulls(len(first), pa.binary()), *packed], names)

    def run(batches):
        words: Counter = Counter()
        # grams as they come, of other and of training texts, and their sums so far
        raw, fresh, parts = ([], []), 0, []

        def sums():
            for training, some in enumerate(raw):
                if some:
                    k, c = np.unique(np.concatenate(some), return_counts=True)
                    some.clear()
                    parts.append((k, c * training, c))
            return _merged(parts)

        for batch in batches:
            for part in slices(batch, batch.column(0)):
                split = [], []
                for t, training in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    split[training].append(words_of(t))
                for w in split[True]:
                    words.update(w)
                if split[True]:
                    words[b""] += len(split[True])
                for training, lists in enumerate(split):
                    if lists:
                        k = grams(stream(lists, depth), depth)[0]
                        raw[training].append(k)
                        fresh += len(k)
                if fresh > _HELD_GRAMS:
                    parts, fresh = [sums()], 0
                    k, n, seen = parts[0]
                    if len(k) > _HELD_GRAMS // 2:
                        # the frequent ones stay, to be summed further
                        out = np.ones(len(k), bool)
                        out[np.argpartition(seen, -(_HELD_GRAMS // 4))[-(_HELD_GRAMS // 4):]] = False
                        yield from gram_rows(k[out], n[out], seen[out])
                        parts = [(k[~out], n[~out], seen[~out])]
                if len(words) > _HELD_WORDS:
                    yield word_rows(words)
                    words = Counter()
        if words:
            yield word_rows(words)
        if parts or any(raw):
            yield from gram_rows(*sums())
    return run


def _summed(batches):
    """Rows word, gram, n, seen (word or gram null) from packed counts whose buckets come together.
    Python holds the distinct words and grams of one bucket."""
    import pyarrow as pa

    names = ["word", "gram", "n", "seen"]

    def rows(words, parts):
        if words:
            n = pa.array(list(words.values()), pa.int64())
            yield pa.RecordBatch.from_arrays([
                pa.array([w.decode() or END for w in words], pa.string()), pa.nulls(len(words), pa.int64()), n, n], names)
        if parts:
            keys, n, seen = _merged(parts)
            yield pa.RecordBatch.from_arrays([
                pa.nulls(len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n), pa.array(seen)], names)

    bucket, words, parts, held = None, {}, [], 0
    for batch in batches:
        for b, lines, *packed in zip(*(c.to_pylist() for c in batch.columns)):
            if b != bucket:
                yield from rows(words, parts)
                bucket, words, parts, held = b, {}, [], 0
            if lines is not None:
                for w, c in zip(lines.split(b"\n"), np.frombuffer(packed[1], np.int64).tolist()):
                    words[w] = words.get(w, 0) + c
                continue
            keys, kind = np.frombuffer(packed[0], np.uint64), np.uint8 if len(packed[1]) < len(packed[0]) else np.int64
            parts.append((keys, *(np.frombuffer(x, kind) for x in packed[1:])))
            held += len(parts[-1][0])
            if held > _HELD_GRAMS:
                parts = [_merged(parts)]
                held = 0
    yield from rows(words, parts)


class SuffixTree:
    """Next-byte probabilities by the longest retained suffix: the tree of small counts, in memory."""

    def __init__(self, depth: int):
        self.depth = depth
        self.root = np.full(256, 1 / 256)
        #: per depth from 1: sorted retained contexts, their escape factor; sorted grams, their probability
        self.levels: list[tuple] = []

    def lookup(self, packed: np.ndarray, levels: int | None = None) -> np.ndarray:
        """Probability of the last byte of each gram."""
        p = self.root[(packed & np.uint64(255)).astype(np.int64)]
        for d, (contexts, escape, keys, values) in enumerate(self.levels[:levels], 1):
            if not len(contexts):
                continue
            key = packed & np.uint64((1 << 8 * (d + 1)) - 1) if d < 7 else packed
            context = key >> _BYTE
            i = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
            inside = np.flatnonzero(contexts[i] == context)
            q = p[inside] * escape[i[inside]]
            if len(keys):
                j = np.minimum(np.searchsorted(keys, key[inside]), len(keys) - 1)
                own = keys[j] == key[inside]
                q[own] = values[j[own]]
            p[inside] = q
        return p

    def add_level(self, keys, counts, context_counts, successors, gain_bits: float) -> None:
        """Test and smooth the candidates of the next depth, given sorted kept grams."""
        contexts, inverse = np.unique(keys >> _BYTE, return_inverse=True)
        parent = self.lookup(keys)
        if not len(keys):
            self.levels.append((contexts, np.empty(0), keys, np.empty(0)))
            return
        first = np.r_[True, inverse[1:] != inverse[:-1]]
        n, t = context_counts[first].astype(float), successors[first].astype(float)
        kept = np.bincount(inverse, weights=counts)
        escape = (n + t - kept) / (n + t)
        # what the kept successors have of the parent's distribution stays with them
        value = counts / (n + t)[inverse] + escape[inverse] * parent
        gain = np.bincount(inverse, weights=counts * np.log2(value / parent))
        retained = gain >= gain_bits * t
        mine = retained[inverse]
        self.levels.append((contexts[retained], escape[retained], keys[mine], value[mine]))

    def score(self, lists: list[list[bytes]]) -> np.ndarray:
        """log10 probability of each word list, its end sign included."""
        if not lists:
            return np.empty(0)
        data = stream(lists, self.depth)
        packed, at = grams(data, self.depth)
        distinct, inverse = np.unique(packed, return_inverse=True)
        logs = np.log10(self.lookup(distinct))[inverse]
        ends = np.flatnonzero(data == 10)
        starts = np.searchsorted(at, np.r_[0, ends[:-1] + 1])
        return np.add.reduceat(logs, starts)


def gram_scores(counts: DataFrame, depth: int = DEPTH, min_context: int = MIN_CONTEXT,
                gain_bits: float = GAIN_BITS) -> DataFrame:
    """``gram, seen, p``: the probability of the last byte of every gram of ``counts`` (``gram, n, seen``).

    The tree is never in one place: the rows of level d are the distinct (d + 1)-grams, joined to the
    rows of their suffixes in level d - 1. A context has at most 256 successors and a suffix at most 256
    extensions, so no group or key is large.
    """
    def suffix(d):
        return F.col("gram").bitwiseAND(F.lit((1 << 8 * (d + 1)) - 1))

    levels = {depth: counts}
    for d in range(depth - 1, -1, -1):
        levels[d] = materialise(levels[d + 1].groupBy(suffix(d).alias("gram")).agg(F.sum("n").alias("n")), "grams")
    total = levels[0].agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    scored = levels[0].select(F.col("gram").alias("suffix"), ((F.col("n") + 1) / F.lit(float(total + 256))).alias("parent"))
    for d in range(1, depth + 1):
        context = Window.partitionBy("context")
        rows = (levels[d].withColumn("suffix", suffix(d - 1)).join(scored, "suffix")
                .withColumn("context", F.shiftrightunsigned("gram", 8))
                .withColumn("context_n", F.sum("n").over(context))
                .withColumn("successors", F.sum(F.signum("n")).over(context)))
        own = ((F.col("n") + F.col("successors") * F.col("parent"))
               / F.greatest(F.col("context_n") + F.col("successors"), F.lit(1.0)))
        gain = F.when(F.col("n") > 0, F.col("n") * F.log2(F.col("own") / F.col("parent"))).otherwise(0.0)
        rows = rows.withColumn("own", own).withColumn("gain", F.sum(gain).over(context))
        retained = ((F.col("context_n") > 0) & (F.col("context_n") >= min_context)
                    & (F.col("gain") >= gain_bits * F.col("successors")))
        p = F.when(retained, F.col("own")).otherwise(F.col("parent"))
        if d < depth:
            scored = rows.select(F.col("gram").alias("suffix"), p.alias("parent"))
    return rows.select("gram", "seen", p.alias("p"))


class _Cache:
    """log10 probabilities of the cached grams: two tables that multiplications address directly hold one gram
    of each place, the sorted array behind them all. order: the grams from rare to frequent, as the last one
    of a place stays."""

    def __init__(self, grams: np.ndarray, logs: np.ndarray, order: np.ndarray | None = None):
        self.grams, self.logs, self.tables = grams, logs, []
        left = np.arange(len(grams)) if order is None else order
        for factor in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
            factor, shift = np.uint64(factor), np.uint64(64 - max(4, len(left).bit_length()))
            places = 1 << 64 - int(shift)
            # a free place holds a gram that belongs elsewhere, so that nothing equals it there
            table, values = np.full(places, 1 << 63, np.uint64), np.zeros(places)
            table[(table[:1] * factor) >> shift] = 0
            at = (grams[left] * factor) >> shift
            table[at], values[at] = grams[left], logs[left]
            self.tables.append((factor, shift, table, values))
            left = left[table[at] != grams[left]]

    def find(self, packed: np.ndarray):
        """The logs (0 where unknown), then the unknown ones: their places, distinct grams, and which."""
        factor, shift, table, values = self.tables[0]
        at = (packed * factor) >> shift
        known = table[at] == packed
        logs = np.where(known, values[at], 0.0)
        left = np.flatnonzero(~known)
        factor, shift, table, values = self.tables[1]
        at = (packed[left] * factor) >> shift
        known = table[at] == packed[left]
        logs[left[known]] = values[at[known]]
        left = left[~known]
        distinct, inverse = np.unique(packed[left], return_inverse=True)
        i = np.searchsorted(self.grams, distinct)
        inside = np.flatnonzero(i < len(self.grams))
        inside = inside[self.grams[i[inside]] == distinct[inside]]
        own, found = np.zeros(len(distinct)), np.zeros(len(distinct), bool)
        own[inside], found[inside] = self.logs[i[inside]], True
        logs[left] = own[inverse]
        unknown = ~found[inverse]
        return logs, left[unknown], distinct, inverse[unknown]


def _cached_scores(lists, depth: int, cache: _Cache):
    """Sum of the cached grams' log10 probabilities of each word list, and its other grams as lists of gram, f."""
    import pyarrow as pa

    data = stream(lists, depth)
    packed, at = grams(data, depth)
    text = np.repeat(np.arange(len(lists)), np.diff(np.searchsorted(at, np.flatnonzero(data == 10), side="right"), prepend=0))
    logs, other, distinct, which = cache.find(packed)
    scores = np.bincount(text, weights=logs, minlength=len(lists))
    pairs, f = np.unique(text[other].astype(np.int64) * len(distinct) + which, return_counts=True)
    owner, gram = np.divmod(pairs, max(len(distinct), 1))
    offsets = np.r_[0, np.cumsum(np.bincount(owner, minlength=len(lists)))].astype(np.int32)
    structs = pa.StructArray.from_arrays(
        [pa.array(distinct[gram].view(np.int64)), pa.array(f.astype(np.int32))], ["gram", "f"])
    return scores.tolist(), pa.ListArray.from_arrays(pa.array(offsets), structs)


#: in a worker process: the broadcast value that came last and what was built of it
_BUILT: dict = {}


def _built(shared):
    """Places of the common words, their log10 probabilities, and the cached grams: built once in a worker process."""
    value = shared.value
    if _BUILT.get("of") is not value:
        _BUILT.clear()
        cached_grams, cached_logs, by_use, known_words, known_logs = value
        places = {w: i for i, w in enumerate(known_words.to_pylist())}
        _BUILT.update(of=value, tables=(places, known_logs, _Cache(cached_grams, cached_logs, by_use)))
    return _BUILT["tables"]


def _base_scores(lists, places: dict, known_logs: np.ndarray):
    """Of each token list: its length, its common words, the sum of their log10 probabilities, and its other words
    as lists of word, f."""
    import pyarrow as pa

    lengths = list(map(len, lists))
    flat = list(chain.from_iterable(lists))
    at = np.fromiter(map(places.get, flat, repeat(-1)), np.int32, len(flat))
    common = at >= 0
    before = np.r_[0, np.cumsum(common)][np.r_[0, np.cumsum(lengths, dtype=np.int64)]]
    found = known_logs[at[common]].tolist()
    bounds = before.tolist()
    logs = [fsum(found[i:j]) for i, j in zip(bounds, bounds[1:])]
    rare = [flat[i] for i in np.flatnonzero(~common).tolist()]
    words, f, offsets, start = [], [], [0], 0
    for n, known in zip(lengths, np.diff(before).tolist()):
        if known < n:
            own = Counter(rare[start:start + n - known])
            words += own
            f += own.values()
            start += n - known
        offsets.append(len(words))
    text = pa.array([w.decode("utf-8", "replace") for w in words], pa.string())
    structs = pa.StructArray.from_arrays([text, pa.array(f, pa.int32())], ["word", "f"])
    return lengths, np.diff(before).tolist(), logs, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs)


def score_texts(docs: DataFrame, keep: list[str], training: Column, text: str = "text",
                depth: int = DEPTH, min_context: int = MIN_CONTEXT) -> DataFrame:
    """``row, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    training: which rows the model learns from.
    """
    spark = docs.sparkSession
    counts = (docs.select(F.col(f"`{text}`").cast("binary"), F.coalesce(training, F.lit(False)).alias("training"))
              .mapInArrow(_counted(depth), _PACKED)
              .repartition("bucket").sortWithinPartitions("bucket")
              .mapInArrow(_summed, "word string, gram long, n long, seen long"))
    counts = materialise(counts, "counts")
    words = counts.where("word is not null").select("word", "n")
    every_gram = counts.where("gram is not null").select("gram", "n", "seen")
    # sixteen steps of frequency to a doubling: the cached grams are those from some step on
    every_gram = materialise(gram_scores(every_gram, depth, min_context).select(
        "gram", "p", F.floor(F.log2("seen") * 16).cast("int").alias("step")), "scores")
    room, least_step = CACHED, 1 << 30
    for r in every_gram.groupBy("step").count().orderBy(F.desc("step")).collect():
        room -= r["count"]
        if room < 0:
            break
        least_step = r["step"]
    cached = every_gram.where(F.col("step") >= least_step).select("gram", F.log10("p").alias("log"), "step").toArrow()
    cached_grams = cached["gram"].to_numpy().view(np.uint64)
    order = np.argsort(cached_grams)
    cached_grams, cached_logs = cached_grams[order], cached["log"].to_numpy()[order]
    by_use = np.argsort(cached["step"].to_numpy()[order], kind="stable").astype(np.int32)

    total, vocabulary = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    common = words.orderBy(F.desc("n"), "word").limit(COMMON).select(F.col("word").cast("binary"), "n").toArrow()
    least = common["n"][-1].as_py() if len(common) else 0
    floor = total + 1 * (vocabulary + 1)
    logs_of_common = np.log10((common["n"].to_numpy() + 1) / floor)
    shared = spark.sparkContext.broadcast((cached_grams, cached_logs, by_use, common["word"].combine_chunks(), logs_of_common))
    end = END.encode()

    def make():
        places, known_logs, cache = _built(shared)

        def run(texts):
            lists = [words_of(t) for t in texts]
            return (*_base_scores([[*words, end] for words in lists], places, known_logs),
                    *_cached_scores(lists, depth, cache))
        return run

    scored = map_text(docs, text, keep, make,
                      "n_tokens long, known long, logs double, rare array<struct<word:string,f:int>>, "
                      "score double, rare_grams array<struct<gram:bigint,f:int>>")
    scored = materialise(scored.withColumn("uid", F.monotonically_increasing_id()), "scored")
    # words beyond the common ones: each has at most 1/COMMON of the training tokens; so with grams and CACHED
    rest = scored.select("uid", F.inline("rare"))
    others = words.where(F.col("n") <= least)
    more_words = rest.join(others, "word", "left").select(
        "uid", F.when(F.col("n").isNotNull(), F.col("f")).otherwise(0).alias("more"),
        (F.col("f") * F.log10((F.coalesce("n", F.lit(0)) + 1) / F.lit(float(floor)))).alias("more_logs"),
        F.lit(0.0).alias("more_score"))
    more_grams = (scored.select("uid", F.inline("rare_grams"))
                  .join(every_gram.where(F.col("step") < least_step), "gram")
                  .select("uid", F.lit(0), F.lit(0.0), F.col("f") * F.log10("p")))
    by_row = more_words.union(more_grams).groupBy("uid").agg(
        *[F.sum(c).alias(c) for c in ("more", "more_logs", "more_score")])
    return scored.join(by_row, "uid", "left").select(
        "row", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more_logs", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"))


def q_op2_lm_scoring(spark, sf_dir: str) -> DataFrame:
    held_out = fold("doc_id", 7) == 2
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_texts(docs, ["doc_id"], ~held_out)
    return scored.select("row.doc_id", (fold(F.col("row.doc_id"), 7) == 2).alias("held_out"),
                         "n_tokens", "n_known", "train_tokens", "base_score", "score")
