"""Exact histogram of encoded lengths, with suffix sums.

Documents are encoded whole and aggregated by their number of tokens. For every
length that occurs, the histogram holds how many documents have it, how many
have at least it (a suffix sum), and the tokens that remain if every document is
truncated to it. From those rows alone follow the totals, the quantiles and the
truncated total of *any* context limit (``limit_totals``, ``quantile``).

Suffix sums run in two levels (ranges of ``RANGE`` lengths, then lengths in a
range), so no task sorts the whole histogram.

Defined results: a null or empty text has 0 tokens and is counted; repeated
rows count each; an empty table gives an empty histogram.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_text, materialise, table
from .tokens import vocabulary_path, word_ids

RANGE = 256


def token_lengths(docs: DataFrame, keep: list[str], path: str | None = None, text: str = "text") -> DataFrame:
    """``row`` and ``length`` in tokens of every document."""
    path = path or vocabulary_path()

    def make():
        ids_of = word_ids(path).text_ids
        return lambda texts: ([len(ids_of(t)) // 4 for t in texts],)
    return map_text(docs, text, keep, make, "length long")


def histogram(lengths: DataFrame) -> DataFrame:
    """One row per occurring ``length``: ``n_docs, n_tokens, docs_at_least, tokens_at_least, truncated_tokens``."""
    counts = lengths.groupBy("length").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("length").alias("n_tokens"))
    counts = materialise(counts, "lengths")  # read twice below: every text is encoded once
    counts = counts.withColumn("range", F.floor(F.col("length") / RANGE))
    # level 1: one row per range (the longest document over RANGE of them at most)
    ranges = counts.groupBy("range").agg(F.sum("n_docs").alias("d"), F.sum("n_tokens").alias("t"))
    above = Window.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    below = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("range", F.coalesce(F.sum("d").over(above), F.lit(0)).alias("docs_above"),
                           F.coalesce(F.sum("t").over(above), F.lit(0)).alias("tokens_above"),
                           F.coalesce(F.sum("t").over(below), F.lit(0)).alias("tokens_below"))
    # level 2: the lengths of one range
    inner = Window.partitionBy("range").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    under = Window.partitionBy("range").orderBy("length").rowsBetween(Window.unboundedPreceding, -1)
    at_least = F.col("docs_above") + F.sum("n_docs").over(inner)
    return counts.join(ranges, "range").select(
        "length", "n_docs", "n_tokens", at_least.alias("docs_at_least"),
        (F.col("tokens_above") + F.sum("n_tokens").over(inner)).alias("tokens_at_least"),
        (F.col("tokens_below") + F.coalesce(F.sum("n_tokens").over(under), F.lit(0))
         + at_least * F.col("length")).alias("truncated_tokens"))


def limit_totals(hist: DataFrame, limits: list[int]) -> DataFrame:
    """``context_limit, n_docs, n_tokens, docs_over, tokens_truncated`` for any limits."""
    limit = F.explode(F.array(*[F.lit(x).cast("long") for x in limits])).alias("context_limit")
    over = F.col("length") > F.col("context_limit")
    return hist.select("*", limit).groupBy("context_limit").agg(
        F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.when(over, F.col("n_docs")).otherwise(0)).alias("docs_over"),
        F.sum(F.col("n_docs") * F.least("length", "context_limit")).alias("tokens_truncated"))


def quantile(hist: DataFrame, shares: list[float]) -> DataFrame:
    """``share, length``: the smallest length with at least that share of the documents at or below it."""
    total = hist.agg(F.sum("n_docs").alias("total"))
    share = F.explode(F.array(*[F.lit(float(x)) for x in shares])).alias("share")
    wanted = total.select("total", share)
    up_to = F.col("total") - F.col("docs_at_least") + F.col("n_docs")
    return (hist.join(F.broadcast(wanted), up_to >= F.ceil(F.col("share") * F.col("total")))  # a row per share
            .groupBy("share").agg(F.min("length").alias("length")))


def q_op6_token_counts(spark, sf_dir: str) -> DataFrame:
    return histogram(token_lengths(table(spark, sf_dir, "documents"), ["doc_id"]).select("length"))
