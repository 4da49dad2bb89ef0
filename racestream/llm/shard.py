"""Uniform shuffle into shards of exact size (hypergeometric communication matrix).

A uniformly random permutation of N rows, cut into shards whose sizes differ by
at most one, sends from every source block a *multivariate hypergeometric*
number of rows to every shard. So:

1. rows are dealt into source blocks and get a random 64-bit key;
2. the driver draws the matrix block x shard exactly, from the block counts and
   the shard sizes alone (a bounded number of integers, whatever the data);
3. each block is permuted locally (rank by the key) and cut along its matrix row;
4. rows are exchanged to their shard and permuted again by a second key, which
   gives the slot in the shard.

Rows only pass through DataFrame expressions. A rank within a block or shard
is computed in cells (leading bits of the random key, of bounded size) plus the
cells' prefix sums, so no task holds a whole shard.

Defined results: nulls in any column, empty and repeated rows are rows like
any other (a row's key comes from its place in the input, not from its
values); an empty table gives no rows; with fewer rows than shards some shards
are empty. Input columns are carried in the struct ``row``, so no name clashes.
"""

from __future__ import annotations

import json
import math
import random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, next_power_of_two

#: source blocks of the communication matrix
N_BLOCKS = 128
#: rows that one task ranks at a time, about
CELL_ROWS = 50_000


def _log_choose(n: int, k: int) -> float:
    return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)


def hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """Good items among ``draws`` taken without replacement from ``good + bad``.

    Inversion that starts at the mode and walks outward on both sides, so the
    expected work is the standard deviation, for any population size.
    """
    low, high = max(0, draws - bad), min(draws, good)
    if low == high:
        return low
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))
    p_mode = math.exp(_log_choose(good, mode) + _log_choose(bad, draws - mode) - _log_choose(good + bad, draws))
    left = rng.random() - p_mode
    if left <= 0:
        return mode
    down, p_down, up, p_up = mode, p_mode, mode, p_mode
    while down > low or up < high:
        if up < high:
            p_up *= (good - up) * (draws - up) / ((up + 1) * (bad - draws + up + 1))
            up += 1
            left -= p_up
            if left <= 0:
                return up
        if down > low:
            p_down *= down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1))
            down -= 1
            left -= p_down
            if left <= 0:
                return down
    return mode  # what rounding has left over


def shard_sizes(n_rows: int, n_shards: int) -> list[int]:
    return [n_rows // n_shards + (s < n_rows % n_shards) for s in range(n_shards)]


def communication_matrix(block_counts: list[int], sizes: list[int], seed: int) -> list[list[int]]:
    """One exact draw of block x shard counts with both margins given."""
    rng, free, matrix = random.Random(seed), list(sizes), []
    for count in block_counts:
        row, left, pool = [], count, sum(free)
        for s, size in enumerate(free):
            pool -= size
            got = hypergeometric(rng, size, pool, left)
            row.append(got)
            left -= got
        free = [f - g for f, g in zip(free, row)]
        matrix.append(row)
    return matrix


def _rank(df: DataFrame, group: str, key: str, cells: int) -> DataFrame:
    """Adds ``rank``: 0-based place by ``key`` within ``group``, gapless.

    The leading bits of the key give the cell; places are the cells' prefix
    sums plus the place in the cell.
    """
    bits = cells.bit_length() - 1
    cell = F.shiftrightunsigned(key, 64 - bits) if bits else F.lit(0).cast("long")
    df = df.withColumn("_cell", cell)
    before = Window.partitionBy(group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (df.groupBy(group, "_cell").agg(F.count(F.lit(1)).alias("_n"))
               .select(group, "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")))
    inside = Window.partitionBy(group, "_cell").orderBy(key, "_uid")
    return (df.withColumn("_place", F.row_number().over(inside) - 1)
            .join(offsets, [group, "_cell"])
            .withColumn("rank", F.col("_offset") + F.col("_place"))
            .drop("_cell", "_offset", "_place"))


def shard_rows(df: DataFrame, n_shards: int = 40, seed: int = 11, n_blocks: int = N_BLOCKS) -> DataFrame:
    """``row`` (struct of the input's columns), ``shard`` and ``slot`` of every row."""
    spark = df.sparkSession
    keyed = (df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
             .withColumn("_uid", F.monotonically_increasing_id())
             .withColumn("_block", F.pmod(F.xxhash64(F.lit(seed), "_uid"), F.lit(n_blocks)).cast("int"))
             .withColumn("_key1", F.xxhash64(F.lit(seed + 1), "_uid"))
             .withColumn("_key2", F.xxhash64(F.lit(seed + 2), "_uid")))
    # the row's place in the input is read once; later passes see the written value
    keyed = materialise(keyed, "shard")
    counts = {r["_block"]: r["n"] for r in keyed.groupBy("_block").agg(F.count(F.lit(1)).alias("n")).collect()}
    blocks = sorted(counts)
    total = sum(counts.values())
    matrix = communication_matrix([counts[b] for b in blocks], shard_sizes(total, n_shards), seed)
    ends = {b: [sum(row[:s + 1]) for s in range(n_shards)] for b, row in zip(blocks, matrix)}

    if not total:
        return keyed.select("row", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    text = json.dumps([{"_block": b, "_ends": e} for b, e in ends.items()])
    cuts = spark.range(1).select(F.inline(F.from_json(F.lit(text), "array<struct<_block:int,_ends:array<long>>>")))
    block_cells = next_power_of_two(total / (n_blocks * CELL_ROWS))
    shard_cells = next_power_of_two(total / (n_shards * CELL_ROWS))
    placed = (_rank(keyed, "_block", "_key1", block_cells)
              .join(F.broadcast(cuts), "_block")  # n_blocks rows of n_shards numbers
              .withColumn("shard", F.size(F.filter("_ends", lambda e: e <= F.col("rank"))))
              .select("row", "_uid", "_key2", "shard"))
    return (_rank(placed, "shard", "_key2", shard_cells)
            .select("row", "shard", F.col("rank").alias("slot")))


def q_op10_sharding(spark, sf_dir: str) -> DataFrame:
    from .common import table

    text = F.coalesce("text", F.lit("")).cast("binary")
    slim = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return shard_rows(slim, 40).select(
        "row.doc_id", "row.size", "row.text_crc32", F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
