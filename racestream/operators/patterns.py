"""Patterns over adjacent rows of one key.

A ``Pattern`` is a sequence of named steps that match rows next to each other
(strict contiguity); matches may overlap, as with no skip strategy. The
condition of a step sees the current row and every row matched by the earlier
steps, each with all its columns.

The partial matches of a key are fixed by its last rows, so these are the state:
in batch ``slices.with_previous`` puts them beside each row (a key may be many
tasks), in streams the neighbour state carries them (``track_neighbours_stream(
..., history=...)``). The conditions are Columns on either.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from racestream.operators.neighbours import ORDER
from racestream.operators.slices import with_previous

# The text of the follower-change message.
PATTERN_PREFIX = "Pattern Detected:"
PASSED_BY = "was passed by "


def follower_changed() -> Column:
    """The follower of this row differs from the previous row's (the intent)."""
    return F.col("prev_follower_id").isNotNull() & (F.col("prev_follower_id") != F.col("follower_driver_id"))


def every_pair() -> Column:
    """Every adjacent pair matches (the pattern as written: both conditions are
    always true)."""
    return F.col("prev_follower_id").isNotNull()


def adjacent_pairs(neighbours: DataFrame, predicate: Column | None = None) -> DataFrame:
    """Adjacent output rows of one key that satisfy ``predicate``, with the message.

    The previous row's follower id is carried by the neighbour operator itself
    (``prev_follower_id``), so no second shuffle or window sort is needed. Pairs
    overlap: row n matches with n-1 and n+1, as with no skip strategy.
    """
    pred = follower_changed() if predicate is None else predicate
    msg = F.concat(F.lit(PATTERN_PREFIX), F.col("prev_follower_id"), F.lit(PASSED_BY),
                   F.col("follower_driver_id"))
    return neighbours.filter(pred).select(
        "session_id", "target_id", "seq", "event_time",
        F.col("prev_follower_id").alias("previous_follower_id"),
        F.col("follower_driver_id").alias("follower_id"),
        msg.alias("message"))


def follower_changes(neighbours: DataFrame) -> DataFrame:
    """"Who passed whom": rows where the follower changed since the previous row."""
    return adjacent_pairs(neighbours, follower_changed())


# -- patterns of named steps -----------------------------------------------------------

Condition = Callable[[Column, Mapping[str, Column]], Column]


@dataclass(frozen=True)
class Step:
    """``where(row, earlier)``: a condition on the row (a struct) and the rows of the earlier steps by name."""

    name: str
    where: Condition | None = None


@dataclass(frozen=True)
class Pattern:
    """Steps in order; the first of ``Pattern.begin``, the others of ``next`` (immediately after).

    ``within``: the longest time from the first row to the last, as an interval text.
    """

    steps: tuple[Step, ...]
    within: str | None = None

    def __post_init__(self):
        if not self.steps or len({s.name for s in self.steps}) < len(self.steps):
            raise ValueError("a pattern needs steps with different names")

    @classmethod
    def begin(cls, name: str, where: Condition | None = None) -> "Pattern":
        return cls((Step(name, where),))

    def next(self, name: str, where: Condition | None = None) -> "Pattern":
        return Pattern((*self.steps, Step(name, where)), self.within)

    def in_time(self, within: str) -> "Pattern":
        return Pattern(self.steps, within)

    @property
    def history(self) -> int:
        """Rows before the current one that a match needs."""
        return len(self.steps) - 1


def match_previous(rows: DataFrame, pattern: Pattern, keys: list[str], time: str = "event_time") -> DataFrame:
    """Matches that end in each row of ``rows``, which has the rows before it in ``previous`` (oldest first).

    The result has the keys and one struct per step, named as the step. A condition that is null does not match.
    """
    n = len(pattern.steps)
    own = F.struct(*[F.col(f"`{c}`") for c in rows.columns if c != "previous"])
    # a first pass names the rows, so that conditions refer to columns and not to copies of expressions
    missing = F.size("previous") - pattern.history
    named = rows.where(F.size("previous") >= pattern.history) if n > 1 else rows
    named = named.select(*[F.col(f"`{k}`") for k in keys],
                         *[F.get("previous", missing + k).alias(s.name) for k, s in enumerate(pattern.steps[:-1])],
                         own.alias(pattern.steps[-1].name))
    met = F.lit(True)
    for k, s in enumerate(pattern.steps):
        if s.where is not None:
            earlier = {e.name: F.col(f"`{e.name}`") for e in pattern.steps[:k]}
            met = met & s.where(F.col(f"`{s.name}`"), earlier)
    if pattern.within:
        first, last = pattern.steps[0].name, pattern.steps[-1].name
        met = met & (F.col(f"`{last}`.{time}") <= F.col(f"`{first}`.{time}") + F.expr(f"INTERVAL {pattern.within}"))
    return named.where(met)


def match_pattern(rows: DataFrame, pattern: Pattern, keys: list[str], order: list[str], slices: int | None = None,
                  time: str = "event_time", **blocks) -> DataFrame:
    """All matches of a pattern in static rows; ``order`` is total within the key (see ``match_previous``)."""
    if pattern.history:
        rows = with_previous(rows, keys, order, pattern.history, slices, **blocks)
    return match_previous(rows, pattern, keys, time)


KEYS = ["session_id", "target_id"]


def match_neighbours(neighbours: DataFrame, pattern: Pattern, slices: int | None = None) -> DataFrame:
    """Matches over neighbour rows: static ones, or a stream that carries its history in ``previous``."""
    if "previous" in neighbours.columns:
        return match_previous(neighbours, pattern, KEYS)
    if neighbours.isStreaming:
        raise ValueError("a stream carries its history itself: track_neighbours_stream(..., history=pattern.history)")
    return match_pattern(neighbours, pattern, KEYS, ORDER, slices)


#: who passed whom, with both rows
PASSED = Pattern.begin("first").next(
    "next", lambda row, earlier: row["follower_driver_id"] != earlier["first"]["follower_driver_id"])

#: a follower that loses the place and has it back in the next row
REPASSED = PASSED.next(
    "back", lambda row, earlier: (row["follower_driver_id"] == earlier["first"]["follower_driver_id"])
    & (earlier["next"]["follower_car_position"] != row["follower_car_position"]))


def passing_message(matches: DataFrame) -> DataFrame:
    """Matches of ``PASSED`` with the message of the original job."""
    return matches.withColumn("message", F.concat(
        F.lit(PATTERN_PREFIX), F.col("first.follower_driver_id"), F.lit(PASSED_BY), F.col("next.follower_driver_id")))
