"""Rows in a total order, cut into slices: what lets one key be many tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from racestream.session import checkpoint_root

BROADCAST_SLICES = 20_000  # tables of one row (half a kilobyte) per slice: ten megabytes
BLOCK_ROWS = 1 << 16


def ordered_slices(rows: DataFrame, slices: int, order: list[str]) -> DataFrame:
    """``rows`` sorted by ``order`` over ``slices`` partitions, with ``slice`` and ``place`` (increasing in it).

    Checkpointed to the shared folder: the bounds are sampled once, and every later pass reads the same slices.
    """
    checkpoint_root(rows.sparkSession)
    return (rows.repartitionByRange(slices, *order).sortWithinPartitions(*order)
            .withColumn("slice", F.spark_partition_id())
            .withColumn("place", F.monotonically_increasing_id())
            .checkpoint(eager=True))


def place_in_slice() -> Column:
    """Rows before this one in its slice (the low 33 bits count within a partition)."""
    return F.col("place").bitwiseAND((1 << 33) - 1)


def with_previous(rows: DataFrame, keys: list[str], order: list[str], count: int, slices: int | None = None,
                  block_rows: int = BLOCK_ROWS, broadcast_slices: int = BROADCAST_SLICES) -> DataFrame:
    """``rows`` with ``previous``: up to ``count`` rows of the same key just before each, oldest first.

    ``order`` within the key is total. No key is one task: rows are numbered over all keys (their number in the
    slice, after the rows of the slices before), cut into blocks of ``block_rows``, and the last ``count`` rows of
    each block are copied to the next one. A block holds the rows of any keys; the key is compared row by row.
    Names starting with ``_prev`` are used inside.
    """
    if not 1 <= count <= block_rows:
        raise ValueError("count must be from 1 to the rows of a block")
    names = rows.columns
    n = slices or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = rows.select(*[F.col(f"`{c}`").alias(f"_prev_o{i}") for i, c in enumerate([*keys, *order])],
                         F.struct(*[F.col(f"`{c}`") for c in names]).alias("_prev_row"))
    ordered = ordered_slices(packed, n, [f"_prev_o{i}" for i in range(len(keys) + len(order))])
    sizes = ordered.groupBy("slice").agg(F.count("*").alias("_prev_n"))
    # one row per slice
    starts = sizes.select(F.col("slice").alias("_prev_slice"), (F.sum("_prev_n").over(
        Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))).alias("_prev_start"))
    start = F.broadcast(starts) if n <= broadcast_slices else starts
    place = F.coalesce("_prev_start", F.lit(0)) + place_in_slice()
    numbered = (ordered.join(start, F.col("slice") == F.col("_prev_slice"))
                .select("_prev_row", *[f"_prev_o{i}" for i in range(len(keys))], place.alias("_prev_at")))
    block = F.expr(f"_prev_at div {block_rows}")
    copied = F.col("_prev_at") % block_rows >= block_rows - count
    blocks = F.array_compact(F.array(F.struct(block.alias("b"), F.lit(True).alias("own")),
                                     F.when(copied, F.struct((block + 1).alias("b"), F.lit(False).alias("own")))))
    spread = numbered.withColumn("_prev_block", F.explode(blocks))
    within = Window.partitionBy("_prev_block.b").orderBy("_prev_at")
    key = F.struct(*[F.col(f"_prev_o{i}") for i in range(len(keys))])
    earlier = [F.when(F.lag(key, k).over(within).eqNullSafe(key), F.lag("_prev_row", k).over(within)) for k in range(count, 0, -1)]
    # a lag that does not exist is null, as is the key of a null row: compare with the row itself
    found = spread.withColumn("previous", F.array_compact(F.array(*earlier))).where("_prev_block.own")
    return found.select("_prev_row.*", "previous")
