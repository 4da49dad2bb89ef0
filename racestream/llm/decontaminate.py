"""Benchmark decontamination by Wu-Manber search over words.

Every run of ten consecutive words of a benchmark item (the whole item, if it
has fewer) is a pattern. Patterns of one length share a Wu-Manber table:

* the *shift table* holds, for a block of two adjacent words, how far a window
  ending there can be moved without missing an occurrence; a block that no
  pattern has skips nearly a whole window, a word that no pattern has skips all;
* where the shift is zero, the *bucket* of that last block lists the patterns
  to test, and a direct comparison of the words confirms an occurrence.

So most words of a document are never looked up. The patterns are broadcast in
passes of at most ``PASS_ROWS`` (pattern, item) rows; a larger benchmark takes
more passes over the documents, whose findings are united.

Defined results: a null, empty or wordless text has no words and is clean; a
null or wordless item has no pattern; an item with a null id marks words but is
not listed; repeated items count once. Input columns are kept in ``row``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_text, table

WINDOW = 10
PASS_ROWS = 500_000
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: bytes to bytes: A-Z lower-cased; what cannot be in a word becomes a space
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


class WuManber:
    """Search for word sequences that all have the same length."""

    def __init__(self, patterns: dict[tuple, list]):
        self.m = m = len(next(iter(patterns)))
        self.vocabulary = {w for p in patterns for w in p}
        self.shift: dict[tuple, int] = {}
        self.bucket: dict[tuple, list] = {}
        for words, items in patterns.items():
            for end in range(1, m):
                block = words[end - 1:end + 1]
                self.shift[block] = min(m - 1 - end, self.shift.get(block, m - 1))
            self.bucket.setdefault(words[-2:], []).append((list(words), items))

    def search(self, words: list[bytes]):
        """(start, items) of every occurrence."""
        m, shift, bucket, vocabulary = self.m, self.shift, self.bucket, self.vocabulary
        if m == 1:
            for i, w in enumerate(words):
                if w in vocabulary:
                    yield i, bucket[(w,)][0][1]
            return
        i, n = m - 1, len(words)
        while i < n:
            last = words[i]
            if last not in vocabulary:
                i += m
                continue
            block = (words[i - 1], last)
            step = shift.get(block, m - 1)
            if step:
                i += step
                continue
            start = i - m + 1
            found = words[start:i + 1]
            for pattern, items in bucket.get(block, ()):
                if pattern == found:
                    yield start, items
            i += 1


def _searchers(patterns: dict[tuple, list]):
    """Searchers by pattern length, from {words: item ids}."""
    by_length: dict[int, dict] = {}
    for words, items in patterns.items():
        by_length.setdefault(len(words), {})[words] = items
    return [WuManber(p) for p in by_length.values()]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(x) for x in out]


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``words, item_id`` for every distinct window of every item."""
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.col("words")
    windows = F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - window + 1, F.lit(1))),
                          lambda i: F.slice(words, i, window))
    return (items.select("item_id", F.regexp_extract_all(lower, F.lit(f"({WORD})"), 1).alias("words"))
            .where(F.size("words") > 0)
            .select(F.explode(windows).alias("words"), "item_id").distinct())


def find_contamination(docs: DataFrame, items: DataFrame, keep: list[str], text: str = "text",
                       window: int = WINDOW, pass_rows: int = PASS_ROWS) -> DataFrame:
    """``row`` (kept columns), ``n_words``, ``hits`` (merged word ranges) and ``items`` (sorted ids as text)."""
    spark = docs.sparkSession
    windows = item_windows(items, window).persist()
    passes = max(1, -(-windows.count() // pass_rows))
    chunk = F.pmod(F.xxhash64("words", "item_id"), F.lit(passes))
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"), F.col(f"`{text}`").alias("text"))
    carried: list[str] = []
    for k in range(passes):
        patterns: dict[tuple, list] = {}
        for r in windows.where(chunk == k).collect():  # about pass_rows rows
            patterns.setdefault(tuple(w.encode() for w in r["words"]), []).append(
                None if r["item_id"] is None else str(r["item_id"]))
        shared = spark.sparkContext.broadcast(patterns)
        more = ["text"] if k < passes - 1 else []
        found = map_text(base, "text", ["kept", *more, *carried], lambda b=shared: _scan(b.value),
                         "n_words long, hits array<struct<start:int,end:int>>, items array<string>")
        carried.append(f"found{k}")
        base = found.select("row.*", "n_words", F.struct("hits", "items").alias(carried[-1])) if more else found
        if more:
            base = base.drop("n_words")
    windows.unpersist()
    earlier = [F.col("row")[c] for c in carried[:-1]]
    return base.select(
        F.col("row.kept").alias("row"), "n_words",
        F.array_sort(F.concat("hits", *[e["hits"] for e in earlier])).alias("hits"),
        F.array_sort(F.array_distinct(F.concat("items", *[e["items"] for e in earlier]))).alias("items"))


def _scan(patterns: dict[tuple, list]):
    searchers = _searchers(patterns)

    def scan(texts):
        counts, hits, found = [], [], []
        for t in texts:
            words = words_of(t)
            spans, ids = [], set()
            for s in searchers:
                for start, items in s.search(words):
                    spans.append((start, start + s.m))
                    ids.update(items)
            counts.append(len(words))
            hits.append([{"start": a, "end": b} for a, b in _merged(spans)])
            found.append(sorted(ids - {None}))
        return counts, hits, found
    return scan


def n_hit_words():
    """Words covered by the sorted ranges of the column ``hits``."""
    return F.aggregate(
        "hits", F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, h: F.struct(F.greatest(a["end"], h["end"]).alias("end"),
                              (a["n"] + F.greatest(F.lit(0), h["end"] - F.greatest(a["end"], h["start"]))).alias("n")),
        lambda a: a["n"])


def q_op7_decontaminate(spark, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select(
        "row.doc_id", "n_words", n_hit_words().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))


_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          "'abcdefghijklmnopqrstuvwxyz'), '" + WORD + "')")
OP7_SQL = f"""
WITH item AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
pattern AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS m,
         unnest(list_transform(range(1, greatest(len(ws) - 9, 1) + 1),
                               lambda i: array_to_string(ws[i:i + 9], ' '))) AS w
  FROM item WHERE len(ws) > 0),
doc AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
place AS (
  SELECT doc_id, m, unnest(range(1, len(ws) - m + 2)) AS i, ws
  FROM doc, (SELECT DISTINCT m FROM pattern) WHERE len(ws) >= m),
hit AS (
  SELECT doc_id, i, place.m, item_id
  FROM place JOIN pattern p ON p.m = place.m AND p.w = array_to_string(ws[i:i + place.m - 1], ' ')),
covered AS (
  SELECT doc_id, count(DISTINCT pos) AS n
  FROM (SELECT DISTINCT doc_id, unnest(range(i, i + m)) AS pos FROM hit) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(DISTINCT item_id) AS n,
         string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM hit GROUP BY doc_id)
SELECT doc.doc_id, len(ws) AS n_words, coalesce(c.n, 0) AS n_hit, coalesce(f.n, 0) AS n_items,
       sha256(coalesce(f.ids, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered c ON c.doc_id = doc.doc_id LEFT JOIN found f ON f.doc_id = doc.doc_id
"""
