"""Runs (maximal periodic stretches) of words by difference-cover LCE queries.

A run is a stretch of consecutive words with smallest period ``q`` that no
neighbouring word extends. Per slice of whole documents, in numpy:

* words become codes; every document is fenced by a separator of its own, so
  nothing ever matches across a fence;
* ``SampledLce`` sorts only the suffixes that start at a place of the
  difference cover modulo 13 (4 of 13 places) and keeps the longest common
  prefixes of sorted neighbours in a sparse table. For any two places at most
  12 words are compared one by one until both are cover places; a range minimum
  gives the rest. A second table over the reversed words extends to the left;
* a run with period ``q`` has at least ``m = max(least - q, (power - 1) * q)``
  places that equal the word ``q`` later, so one of the grid places ``0, m,
  2m, ...`` lies in it: a harmonic number of queries over all periods. A stretch
  found for several periods (multiples of the smallest) keeps the smallest.

A task holds one slice: whole documents of at most ``SLICE_BYTES`` together, or
one longer document (memory in proportion to that document). Grid places are
made in chunks.

Defined results: a null, empty or white-space text has no words and no run; a
null id counts as the empty string in the garbling hash; repeated rows are rows
of their own; very long texts are taken whole; bytes that are not UTF-8 stay as
they are. Ties of the greatest exponent: smallest start, then period. Input
columns are kept in ``row``, so their names clash with nothing. An empty table
gives an empty table.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import table

#: every difference modulo 13 is a difference of two of these
COVER_SIZE = 13
COVER = (0, 1, 3, 9)
SLICE_BYTES = 2 << 20
GRID_CHUNK = 1 << 20
LEAST_LENGTH = 24
LEAST_POWER = 3

_IN_COVER = np.isin(np.arange(COVER_SIZE), COVER)
#: [i % 13, j % 13] -> words to pass until both places are in the cover
_SHIFT = np.array([[next(d for d in range(COVER_SIZE) if _IN_COVER[(i + d) % COVER_SIZE] and _IN_COVER[(j + d) % COVER_SIZE])
                    for j in range(COVER_SIZE)] for i in range(COVER_SIZE)], dtype=np.int64)


class SampledLce:
    """Longest common extensions to the right between places of ``codes``.

    ``codes`` are positive and end in a code that occurs nowhere else, which
    every suffix reaches, so no two suffixes are equal.
    """

    def __init__(self, codes: np.ndarray):
        v = COVER_SIZE
        self.codes = np.concatenate([codes.astype(np.uint32), np.zeros(v, np.uint32)])
        n = len(codes)
        places = np.flatnonzero(_IN_COVER[np.arange(n) % v])
        m = len(places)
        self.index = np.full(n + v, m, dtype=np.int64)  # place -> number of its sampled suffix; m: none
        self.index[places] = np.arange(m)
        blocks = np.lib.stride_tricks.sliding_window_view(self.codes, v)[places].astype(">u4")
        rank = np.unique(np.ascontiguousarray(blocks).view(f"S{4 * v}").ravel(), return_inverse=True)[1].astype(np.int64)
        levels = []  # ranks by the first 13, 26, 52, ... words, while some are equal
        width = v
        while m and rank.max() < m - 1:
            levels.append((width, np.append(rank, -1)))
            ahead = self.index[np.minimum(places + width, n + v - 1)]
            rank = np.unique(rank * (m + 1) + levels[-1][1][ahead] + 1, return_inverse=True)[1].astype(np.int64)
            width *= 2
        self.rank = np.append(rank, -1)
        order = np.empty(m, dtype=np.int64)
        order[rank] = places
        self.table = [self._neighbours(order, levels)]
        step = 1
        while 2 * step <= len(self.table[0]):
            last = self.table[-1]
            self.table.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def _neighbours(self, order: np.ndarray, levels: list) -> np.ndarray:
        """Common prefixes of the sampled suffixes that are next to each other in order."""
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(len(a), dtype=np.int32)
        for width, rank in reversed(levels):
            same = rank[self.index[a]] == rank[self.index[b]]
            for x in (a, b, common):
                x[same] += width
        active = np.arange(len(a))
        for _ in range(COVER_SIZE - 1):
            active = active[self.codes[a[active]] == self.codes[b[active]]]
            for x in (a, b, common):
                x[active] += 1
        return common

    def query(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words equal from ``i`` and ``j`` on (``i <> j``)."""
        shift = _SHIFT[i % COVER_SIZE, j % COVER_SIZE]
        out = np.zeros(len(i), dtype=np.int64)
        active = np.arange(len(i))
        for t in range(COVER_SIZE):
            arrived = active[shift[active] == t]
            out[arrived] = t + self._sampled(i[arrived] + t, j[arrived] + t)
            active = active[shift[active] > t]
            same = self.codes[i[active] + t] == self.codes[j[active] + t]
            out[active[~same]] = t
            active = active[same]
        return out

    def _sampled(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = self.rank[self.index[i]], self.rank[self.index[j]]
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(i), dtype=np.int64)
        for k in np.unique(level):
            at = level == k
            row = self.table[k]
            out[at] = np.minimum(row[low[at]], row[high[at] - (1 << int(k))])
        return out


def _grid(lengths: np.ndarray, starts: np.ndarray, least: int, power: int):
    """(document, place, period) of every grid place, in chunks of bounded size."""
    periods = np.where(lengths >= least, lengths // power, 0)
    pairs = int(periods.sum())
    ends = np.cumsum(periods)
    for lo in range(0, pairs, GRID_CHUNK):  # first over (document, period)
        k = np.arange(lo, min(pairs, lo + GRID_CHUNK))
        doc = np.searchsorted(ends, k, side="right")
        q = k - (ends[doc] - periods[doc]) + 1
        m = np.maximum(least - q, (power - 1) * q)
        count = (lengths[doc] - q - 1) // m + 1
        upto = np.cumsum(count)
        first = 0
        while first < len(k):  # then over their grid places
            base = upto[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(upto, base + GRID_CHUNK, side="right")))
            part = np.arange(first, last)
            pair = np.repeat(part, count[part])
            within = np.arange(len(pair)) - np.repeat(upto[part] - count[part] - base, count[part])
            yield doc[pair], starts[doc[pair]] + within * m[pair], q[pair], m[pair]
            first = last


def runs_of(documents: list[np.ndarray], least: int = LEAST_LENGTH, power: int = LEAST_POWER) -> list[np.ndarray]:
    """The runs ``(start, length, period)``, by start and period, of each sequence of codes (from 0)."""
    lengths = np.array([len(d) for d in documents], dtype=np.int64)
    starts = np.cumsum(lengths + 1) - lengths  # a fence before each document and at the end
    total = int((lengths + 1).sum()) + 1
    codes = np.zeros(total, dtype=np.int64)
    for s, d in zip(starts, documents):
        codes[s:s + len(d)] = d + 1
    fences = np.append(starts - 1, total - 1)
    codes[fences] = codes.max() + 1 + np.arange(len(fences))
    right = left = None
    found = []
    for doc, i, q, m in _grid(lengths, starts, least, power):
        same = np.flatnonzero(codes[i] == codes[i + q])
        if not len(same):
            continue
        if right is None:
            right, left = SampledLce(codes), SampledLce(codes[::-1])
        doc, i, q, m = doc[same], i[same], q[same], m[same]
        ahead = right.query(i, i + q)
        back = left.query(total - i, total - i - q)
        ok = ahead + back >= m
        begin = i[ok] - back[ok]
        found.append(np.stack([doc[ok], begin - starts[doc[ok]], ahead[ok] + back[ok] + q[ok], q[ok]]))
    if not found:
        return [np.empty((0, 3), np.int64) for _ in documents]
    doc, start, length, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, length, start, doc))
    rows = np.stack([doc, start, length, period], axis=1)[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)  # one stretch, the smallest period
    rows = rows[new]
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    bounds = np.searchsorted(rows[:, 0], np.arange(len(documents) + 1))
    return [rows[bounds[k]:bounds[k + 1], 1:] for k in range(len(documents))]


def garbled(words: list, h: int) -> list:
    """The planted case: from word ``a`` on, words repeat with period ``p`` where 10 divides ``h``."""
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    cycle = words[a:a + p]
    return words[:a] + (cycle * -(-(n - a) // p))[:n - a]


def _coded(documents: list[list[bytes]]) -> list[np.ndarray]:
    number: dict[bytes, int] = {}
    put = number.setdefault
    return [np.array([put(w, len(number)) for w in words], dtype=np.int64) for words in documents]


FIELDS = ("n_words long, runs array<struct<start:long,length:long,period:long>>, "
          "runs_sha256 string, collapsed_sha256 string")


def _finished(words: list[bytes], runs: np.ndarray) -> tuple:
    rows = runs.tolist()
    kept = words
    if rows:
        edge = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
        np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
        kept = [words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in rows)
    return (len(words), [{"start": s, "length": n, "period": p} for s, n, p in rows],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest())


def _slices(sizes: list[int]):
    """Ranges of consecutive rows with at most ``SLICE_BYTES`` together, or one row."""
    lo = held = 0
    for k, size in enumerate(sizes):
        if k > lo and held + size > SLICE_BYTES:
            yield lo, k
            lo, held = k, 0
        held += size
    if lo < len(sizes):
        yield lo, len(sizes)


def find_runs(docs: DataFrame, keep: list[str], text: str = "text", garble: Column | None = None,
              least: int = LEAST_LENGTH, power: int = LEAST_POWER) -> DataFrame:
    """``row`` (kept columns), ``n_words``, ``runs`` and the hashes of the runs and of the text without repeats.

    Runs have at least ``least`` words and ``power`` periods. ``garble``: a
    hash per row that decides about the planted repetition (``garbled``).
    """
    import pyarrow as pa
    import pyarrow.compute as pc
    from pyspark.sql.pandas.types import to_arrow_type

    if power < 2:
        raise ValueError("a run has two periods at least")
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
                         F.col(f"`{text}`").cast("binary").alias("_text"),
                         (garble if garble is not None else F.lit(None)).cast("long").alias("_hash"))
    added = StructType.fromDDL(FIELDS)
    schema = StructType([source.schema["row"], *added.fields])
    types = [to_arrow_type(f.dataType) for f in added.fields]
    names = schema.names

    def run(batches):
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            for lo, hi in _slices(sizes):
                part = batch.slice(lo, hi - lo)
                texts = [(t or b"").split() for t in part.column(1).to_pylist()]
                texts = [w if h is None else garbled(w, h) for w, h in zip(texts, part.column(2).to_pylist())]
                rows = [_finished(w, r) for w, r in zip(texts, runs_of(_coded(texts), least, power))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows), types))], names)

    return source.mapInArrow(run, schema)


def strongest(runs: Column | str = "runs") -> Column:
    """The run of greatest exact length/period (ties: smallest start, then period); null where there is none."""
    col = F.col(runs) if isinstance(runs, str) else runs

    def better(a, r):
        left, right = r["length"] * a["period"], a["length"] * r["period"]
        return (left > right) | ((left == right) & (F.struct(r["start"], r["period"]) < F.struct(a["start"], a["period"])))

    return F.aggregate(F.slice(col, 2, F.greatest(F.size(col), F.lit(1))), F.get(col, 0),
                       lambda a, r: F.when(better(a, r), r).otherwise(a))


def q_op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    seed = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    found = find_runs(table(spark, sf_dir, "documents"), ["doc_id"], garble=seed)
    best = found.select("row.doc_id", F.size("runs").cast("long").alias("n_runs"), strongest().alias("best"),
                        "runs_sha256", "collapsed_sha256")
    return best.select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                       F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
                       "runs_sha256", "collapsed_sha256")


CRC_SQL = """
crc_step(i, k, c) AS (
  SELECT i, 0, i FROM range(256) t(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc_step WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM crc_step WHERE k = 8)
"""


def crc_of(text: str) -> str:
    """SQL for the unsigned crc32 of an ASCII or UTF-8 text, with ``crc_table`` joined as ``t``."""
    # hex digits of the bytes, two by two
    digits = f"hex(encode({text}))"
    byte = f"CAST(('0x' || substr({digits}, 2 * CAST(k AS INTEGER) + 1, 2)) AS BIGINT)"
    return (f"xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform("
            f"range(length({digits}) // 2), lambda k: {byte})), "
            f"lambda a, b: xor(a >> 8, t[CAST(xor(a, b) & 255 AS INTEGER) + 1])))")


OP11_SQL = f"""
WITH RECURSIVE {CRC_SQL},
plain AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws,
         {crc_of("coalesce(CAST(doc_id AS VARCHAR), '')")} AS h
  FROM documents, crc_table),
planted AS (
  SELECT doc_id, ws, len(ws) AS n, h % 10 = 0 AND len(ws) > 0 AS yes, (h // 10) % greatest(len(ws), 1) AS a,
         1 + (len(ws) - (h // 10) % greatest(len(ws), 1)) // (3 + (h // 10) % 8) AS p
  FROM plain),
doc AS (
  SELECT row_number() OVER () AS d, doc_id, n,
         CASE WHEN yes THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN ws[i + 1] ELSE ws[a + (i - a) % p + 1] END)
              ELSE ws END AS ws
  FROM planted),
word AS (SELECT d, n, unnest(range(n)) AS i, unnest(ws) AS w FROM doc),
pair AS (
  SELECT x.d, y.i - x.i AS q, x.i
  FROM word x JOIN word y ON y.d = x.d AND y.w = x.w AND y.i > x.i AND 3 * (y.i - x.i) <= x.n),
island AS (
  SELECT d, q, min(i) AS s, count(*) + q AS len
  FROM (SELECT d, q, i, i - row_number() OVER (PARTITION BY d, q ORDER BY i) AS g FROM pair)
  GROUP BY d, q, g HAVING count(*) + q >= greatest(24, 3 * q)),
run AS (SELECT d, s, len, min(q) AS q FROM island GROUP BY d, s, len),
best AS (
  SELECT d, s, len, q, row_number() OVER (PARTITION BY d ORDER BY CAST(len AS DOUBLE) / q DESC, s, q) AS k FROM run),
listed AS (
  SELECT d, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS lines
  FROM run GROUP BY d),
dropped AS (SELECT DISTINCT d, unnest(range(s + q, s + len)) AS i FROM run),
kept AS (
  SELECT d, string_agg(w, ' ' ORDER BY i) AS words FROM (
    SELECT word.d, word.i, word.w FROM word ANTI JOIN dropped ON dropped.d = word.d AND dropped.i = word.i) GROUP BY d)
SELECT doc.doc_id, coalesce(l.n_runs, 0) AS n_runs, b.s AS start, b.len AS length, b.q AS period,
       1000 * b.len // b.q AS exponent_milli, sha256(coalesce(l.lines, '')) AS runs_sha256,
       sha256(coalesce(k.words, '')) AS collapsed_sha256
FROM doc LEFT JOIN listed l ON l.d = doc.d LEFT JOIN kept k ON k.d = doc.d
LEFT JOIN best b ON b.d = doc.d AND b.k = 1
"""
