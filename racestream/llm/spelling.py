"""Grouping of spelling variants: words one edit apart, found by pivotal grams.

The vocabulary (words with enough occurrences) is counted over whole texts.
Bigrams are ordered by their number of words, rarest first. Of a word,

* the *prefix* is its first three bigrams in that order (one edit destroys two
  at most, so a near word keeps one);
* the *pivots* are two disjoint bigrams of the prefix with the fewest words,
  chosen by dynamic programming. One edit destroys one of them at most.

Of two near words, the one whose prefix ends first in the order has a pivot that
survives, and it is in the other's prefix, moved by one place at most. The
edit lies right of the first pivot or left of the second, so all letters on the
pivot's far side are the same too; and of the letters on the edit's side, the
nearer or the farther half is the same. So pivots are joined with prefixes on
(length, place, unchanged letters), as one hash. What the join finds is
verified (edit distance exactly one).

The order has ties where a bigram occurs more than once in a word: the pivot is
then among the first three of its kind, and an edit shifts that by two at most,
so five of the last bigram's kind go into the indexed prefix: a word has seven
indexed bigrams at most, however long it is.

Hot bigrams are harmless, as the key holds half the word or more. All joins
are sort-merge joins by hint (adaptive skew join): Spark sizes what is read
again by its compressed files, and the keys by the file of the words (25 million
keys by 8 MB), and would broadcast them. The only thing collected is the number
of words per bigram: an alphabet of 90 letters has 8,100 at most.

Each word's ``form`` is its most frequent near word, if that is frequent enough
beside it; ``root`` follows the forms by pointer jumping, a few rounds, as counts
grow along a chain.

Defined results: a null or empty text has no words; a null id counts as the
empty string in the slip hash; repeated rows count again; ties between near
words go to the smallest in code-point order; very long words are words (of
any length; seven indexed bigrams); an empty table gives an empty one. Only the
id and text columns are read, so names of others clash with nothing.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, table
from .periodic_runs import CRC_SQL, crc_of

WORD = re.compile("[a-zÀ-ÿ]+")  # after A-Z are lower-cased
GRAM = 2
EDITS = 1
PREFIX = GRAM * EDITS + 1
TIED = PREFIX + GRAM * EDITS
SLIP = 97
MIN_LENGTH = 5
MIN_COUNT = 3
RATIO = 2
HELD_WORDS = 300_000


def word_counts(docs: DataFrame, id_col: str = "doc_id", text: str = "text", slip: int | None = SLIP,
                min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n`` of all words with at least ``min_length`` letters and ``min_count`` occurrences.

    ``slip``: in a document where it divides the hash of a word, the word loses
    one letter (planted misspellings); None: no slips.
    """
    import pyarrow as pa

    source = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary").alias("id"),
                         F.col(f"`{text}`").cast("binary").alias("text")).where("text is not null")

    def flush(counts):
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
                                          ["word", "n"])

    def run(batches):
        counts: Counter = Counter()
        find, crc = WORD.findall, zlib.crc32
        for batch in batches:
            for k in range(batch.num_rows):
                text = batch.column(1)[k].as_py().lower().decode("utf-8", "replace")  # bytes: only A-Z change
                base = crc(batch.column(0)[k].as_py() + b":")
                for word, n in Counter(find(text)).items():
                    if len(word) < min_length:
                        continue
                    if slip:
                        h = crc(word.encode(), base)
                        if not h % slip:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                            if len(word) < min_length:
                                continue
                    counts[word] += n
                if len(counts) >= HELD_WORDS:
                    yield flush(counts)
                    counts = Counter()
        yield flush(counts)

    return (source.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= min_count))


def gram_counts(words: DataFrame) -> dict[str, int]:
    """Number of bigram places by bigram (bounded by the square of the alphabet)."""
    places = F.sequence(F.lit(1), F.length("word") - GRAM + 1)
    grams = words.where(F.length("word") >= GRAM).select(F.explode(F.transform(places, lambda i: F.substring("word", i, GRAM)))
                                                         .alias("gram"))
    return {r.gram: r.n for r in grams.groupBy("gram").agg(F.count("*").alias("n")).collect()}


def pivots(places: list[int], weights: list[int], count: int = EDITS + 1) -> tuple[int, ...]:
    """``count`` disjoint places of least total weight, by dynamic programming over the places in order."""
    order = sorted(range(len(places)), key=places.__getitem__)
    best: list[list] = []  # best[k][m]: (weight, places) of m disjoint ones among the first k
    for k, x in enumerate(order):
        before = best[k - 1] if k else [(0, ())] + [None] * count
        free = k - 1
        while free >= 0 and places[order[free]] > places[x] - GRAM:
            free -= 1
        apart = best[free] if free >= 0 else [(0, ())] + [None] * count
        row = [(0, ())]
        for m in range(1, count + 1):
            taken = apart[m - 1] and (apart[m - 1][0] + weights[x], (*apart[m - 1][1], places[x]))
            row.append(min((c for c in (before[m], taken) if c), default=None))
        best.append(row)
    return best[-1][count][1]


def prefix(word: str, frequency: dict[str, int]) -> tuple[list[tuple], list[tuple]]:
    """The first three bigrams ``(words, bigram, place)`` in order, and those that are indexed."""
    grams = sorted([(frequency[word[i:i + GRAM]], word[i:i + GRAM], i) for i in range(len(word) - GRAM + 1)])
    head, last = grams[:PREFIX], grams[PREFIX - 1][1]
    before = [g for g in head if g[1] != last]
    tied = [g for g in grams[len(before):len(before) + TIED] if g[1] == last]
    return head, before + tied


def pivot_keys(word: str, first: int, second: int) -> list[str]:
    """What stays the same of a word after one edit: one of these four.

    Letter: which part; then the word's length, the pivot's place, the letters.
    """
    n, after = len(word), first + GRAM
    half = (n - after) // 2
    left = second // 2
    return [f"a{n},{first},{word[:after + half]}", f"b{n},{first},{word[:after]} {word[after + half:]}",
            f"c{n},{second},{word[:left]} {word[second:]}", f"d{n},{second},{word[left:]}"]


def indexed_keys(word: str, places: list[int]) -> list[str]:
    """The keys under which near words with a pivot at one of these bigrams look for this word."""
    own, out = len(word), []
    for i in places:
        for n in (own - 1, own, own + 1):  # length of the near word
            after = i + GRAM
            if after <= n:  # edit to the right: the pivot has the same place
                half = (n - after) // 2
                rest = n - after - half
                if after + half <= own:
                    out.append(f"a{n},{i},{word[:after + half]}")
                if after + rest <= own:
                    out.append(f"b{n},{i},{word[:after]} {word[own - rest:]}")
            second = n - (own - i)  # edit to the left: the same distance from the end
            if second >= GRAM:
                left = second // 2
                if left <= i:
                    out.append(f"c{n},{second},{word[:left]} {word[i:]}")
                if n - left <= own:
                    out.append(f"d{n},{second},{word[own - (n - left):]}")
    return out


def near_words(words: DataFrame) -> DataFrame:
    """``word, n, near, near_n`` for every ordered pair of words of ``words`` that are one edit apart.

    ``words`` has ``word`` (distinct, four letters or more), ``n``. Pairs may repeat.
    """
    frequency = words.sparkSession.sparkContext.broadcast(gram_counts(words))

    def keyed(side: str):
        import numpy as np
        import pyarrow as pa
        from xxhash import xxh3_64_intdigest

        def run(batches):
            known = frequency.value
            for batch in batches:
                for lo in range(0, batch.num_rows, 2000):
                    part = batch.slice(lo, 2000)
                    keys, rows = [], []
                    for k, word in enumerate(part.column(0).to_pylist()):
                        head, indexed = prefix(word, known)
                        if side == "pivot":
                            own = pivot_keys(word, *pivots([g[2] for g in head], [g[0] for g in head]))
                        else:
                            own = indexed_keys(word, [g[2] for g in indexed])
                        keys += [xxh3_64_intdigest(x.encode()) for x in own]
                        rows += [k] * len(own)
                    at = pa.array(rows, pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.array(keys, np.uint64).view(np.int64)), part.column(0).take(at),
                         part.column(1).take(at)], ["key", "word", "n"])
        return run

    rows = words.select("word", "n")
    a = rows.mapInArrow(keyed("pivot"), "key long, word string, n long").toDF("key", "a", "a_n").alias("a")
    b = rows.mapInArrow(keyed("index"), "key long, word string, n long").toDF("key", "b", "b_n").alias("b")
    pair = a.join(b.hint("merge"), "key").where(F.levenshtein("a", "b", EDITS) == EDITS)
    both = F.array(F.struct(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
                   F.struct(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))
    return pair.select(F.inline(both))


def variant_groups(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of ``words`` (``word, n``)."""
    # one shuffle: rows of a word are together, so its distinct pairs are too
    pairs = near_words(words).repartition("word").groupBy("word", "n", "near", "near_n").agg(F.lit(1).alias("_one"))
    best = F.min_by(F.struct("near", "near_n"), F.struct(-F.col("near_n"), "near"))
    near = pairs.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    formed = words.join(near.hint("merge"), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(F.col("best.near_n") >= ratio * F.col("n"), F.col("best")).alias("best"))
    formed = materialise(formed.select("word", "n", "n_near", F.col("best.near").alias("form"),
                                       F.col("best.near_n").alias("form_n")), "forms")
    up = formed.select("word", F.coalesce("form", "word").alias("root"))
    moved = up.where("root <> word")
    while True:  # each round doubles the steps taken; counts grow by ``ratio`` a step
        jump = moved.toDF("root", "next")
        longer = materialise(moved.join(jump.hint("merge"), "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("more")), "roots")
        moved = longer.select("word", "root")
        if longer.where("more").isEmpty():
            break
    return formed.join(moved.hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def q_op12_spelling(spark, sf_dir: str) -> DataFrame:
    return variant_groups(materialise(word_counts(table(spark, sf_dir, "documents")), "words"))


OP12_SQL = f"""
WITH RECURSIVE {CRC_SQL},
found AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS w
  FROM documents),
counted AS (SELECT doc_id, w, count(*) AS n FROM found WHERE length(w) >= 5 GROUP BY doc_id, w),
hashed AS (
  SELECT w, n, {crc_of("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w")} AS h FROM counted, crc_table),
slipped AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, CAST(h % length(w) AS INTEGER)) || substr(w, CAST(h % length(w) AS INTEGER) + 2)
              ELSE w END AS word, n
  FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slipped WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS (
  SELECT word, i, substr(word, 1, CAST(i AS INTEGER)) || substr(word, CAST(i AS INTEGER) + 2) AS rest
  FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT x.word AS a, y.word AS b FROM cut x JOIN cut y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
  UNION SELECT cut.word, words.word FROM cut JOIN words ON words.word = cut.rest
  UNION SELECT words.word, cut.word FROM cut JOIN words ON words.word = cut.rest),
ranked AS (
  SELECT a, b, y.n AS bn, count(*) OVER (PARTITION BY a) AS n_near,
         row_number() OVER (PARTITION BY a ORDER BY y.n DESC, b) AS k
  FROM near JOIN words y ON y.word = near.b),
formed AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.bn >= 2 * w.n THEN r.b END AS form,
         CASE WHEN r.bn >= 2 * w.n THEN r.bn END AS form_n
  FROM words w LEFT JOIN ranked r ON r.a = w.word AND r.k = 1),
climb AS (
  SELECT word, word AS root FROM formed WHERE form IS NULL
  UNION ALL
  SELECT f.word, c.root FROM climb c JOIN formed f ON f.form = c.word)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM formed f JOIN climb c ON c.word = f.word
"""
