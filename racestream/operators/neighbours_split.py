"""Neighbour tracking in batch: every key is split across slices (exact).

One race may hold any share of all rows, so a ``(session_id, target_id)`` key is
never one task: it is cut into balanced slices, and the rows still are exactly
those of the sequential state machine:

1. ``repartitionByRange`` on (key, event_time, partition, seq) cuts the global order into
   slices of similar size (Spark samples the bounds), so a hot key spans many
   slices; the sorted slices are checkpointed to the shared checkpoint folder,
   which cuts the lineage (a lost executor re-reads them, nothing is resampled).
2. The first pass summarises every slice in one row (``transfer.Segment``): what
   its first run of a key does to any entry state, and the state its last run
   ends in. Runs that begin and end in the slice are not simulated.
3. The summaries are combined on the executors, in slice order, ``FANOUT`` at a
   time: up the tree by composing them (associative), down again by handing each
   group its entry state. Nothing is collected; the work and the data moved grow
   with the number of slices, not with the rows.
4. Each slice's first row gets the slice's entry state by a join (a broadcast
   where the number of slices bounds it, ``BROADCAST_SLICES``; else by slice).
5. The second pass runs the ordinary state machine from there, in parallel, and
   emits the rows.

So the rows pass through Python twice. With ``states`` (``advance_neighbours``) the
keys start in given states, which travel as rows ahead of the key's first event,
and the states at the end come out beside the rows: one micro-batch of a stream.
"""

from __future__ import annotations

import json
from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from racestream.operators.neighbours import (
    ORDER, BatchColumns, NeighbourState, _emit_batch, _input_projection, attach_targets, fold_id, key_runs,
)
from racestream.operators.slices import BROADCAST_SLICES, ordered_slices, place_in_slice
from racestream.operators.transfer import Segment, Transfer, fresh, state_list, state_of
from racestream.schemas import neighbour_schema
from racestream.session import scratch_path

KEY = ["session_id", "target_id"]
FANOUT = 256
SUMMARY_COLUMNS = ["slice", "session_id", "target_id", "driver_id", "car_position", "current_lap_num",
                   "lap_distance", "speed", "race_number", "g_force_lateral", "g_force_longitudinal", "stored"]
SUMMARY = "slice int, summary string"
ENTRY = "slice int, entry string"


# -- first pass: one summary per slice -----------------------------------------------------


class _SliceSummary:
    """Fed with the runs of one slice in order."""

    def __init__(self, slice_id: int):
        self.slice = slice_id
        self.first = self.key = self.head = self.state = self.target = None

    def start(self, key: tuple) -> None:
        self.key, self.target = key, fold_id(key[1])
        if self.first is None:
            self.first, self.head = key, Transfer()
        else:
            self.state = None  # a run is simulated only if it turns out to be the last one

    def row(self) -> tuple:
        state = None
        if self.key != self.first:
            state = state_list(self.state or NeighbourState())
        return self.slice, Segment(list(self.first), list(self.key), self.head.done(), state).dump()


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per slice. Runs that begin and end inside one batch and are not the slice's first are passed over."""
    current: _SliceSummary | None = None
    rows: list[tuple] = []
    for b in batches:
        if not b.num_rows:
            continue
        slices = b.column("slice").to_numpy()
        lo = 0
        while lo < b.num_rows:
            slice_id = int(slices[lo])
            hi = int(lo + (slices[lo:] == slice_id).sum())
            if current is None or current.slice != slice_id:
                if current is not None:
                    rows.append(current.row())
                current = _SliceSummary(slice_id)
            part = b.slice(lo, hi - lo)
            runs = key_runs(part)
            for n, (a, z, key) in enumerate(runs):
                if key != current.key or current.first is None:
                    current.start(key)
                if n < len(runs) - 1 and current.key != current.first:
                    continue  # ends in this batch: neither first nor last
                _feed(current, BatchColumns(part.slice(a, z - a)), part.column("stored").slice(a, z - a))
            lo = hi
    if current is not None:
        rows.append(current.row())
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows])],
                                         ["slice", "summary"])


def _feed(summary: _SliceSummary, cols: BatchColumns, stored: pa.Array) -> None:
    at = 0
    if stored[0].is_valid:  # the key's state ahead of its first event
        at, given = 1, json.loads(stored[0].as_py())
        if summary.key == summary.first:
            summary.head = Transfer()
            summary.head.known = given
        summary.state = state_of(given)
    target = summary.target
    if summary.key == summary.first and summary.head.known is None:
        feed = summary.head.feed
        for i in range(at, len(cols.drv)):
            feed((cols.drv[i], cols.pos[i], cols.lap[i], cols.dist[i], cols.spd[i], True), cols.key[i] == target,
                 (cols.rno[i], cols.glat[i], cols.glon[i]))
        return
    st = summary.state = summary.state or NeighbourState()
    for i in range(at, len(cols.drv)):
        cols.step(st, target, i)
    if summary.key == summary.first:
        summary.head.known = state_list(st)


# -- entry states, as a tree on the executors ----------------------------------------------


def _composed(pdf):
    import pandas as pd

    out = None
    for text in pdf.sort_values("slice")["summary"]:
        seg = Segment.load(text)
        out = seg if out is None else out.then(seg)
    return pd.DataFrame({"slice": [int(pdf["_group"].iloc[0])], "summary": [out.dump()]})


def _entered(pdf, entry: str | None = None):
    """Entry states (key and state) of the slices of one group, from the group's own."""
    import pandas as pd

    key, state = json.loads(entry) if entry else (None, None)
    rows = []
    for slice_id, text in pdf.sort_values("slice")[["slice", "summary"]].itertuples(index=False):
        if key is not None:
            rows.append((int(slice_id), json.dumps([key, state])))
        key, state = Segment.load(text).leave(key, state)
    return pd.DataFrame(rows, columns=["slice", "entry"])


def entry_states(summaries: DataFrame, slices: int, fanout: int = FANOUT) -> DataFrame:
    """``slice, entry``: last key and its state before each slice that has an earlier one."""
    if slices <= fanout:
        return summaries.withColumn("_group", F.lit(0)).groupBy("_group").applyInPandas(lambda pdf: _entered(pdf), ENTRY)
    path = scratch_path(summaries.sparkSession, "summaries")  # read on the way up and on the way down
    summaries.write.parquet(path)
    grouped = (summaries.sparkSession.read.schema(summaries.schema).parquet(path)
               .withColumn("_group", F.expr(f"slice div {fanout}").cast("int")))
    above = entry_states(grouped.groupBy("_group").applyInPandas(_composed, SUMMARY), -(-slices // fanout), fanout)

    def down(left, right):
        return _entered(left, right["entry"].iloc[0] if len(right) else None)

    return (grouped.groupBy("_group").cogroup(above.withColumnRenamed("slice", "_group").groupBy("_group"))
            .applyInPandas(down, ENTRY))


# -- second pass: the rows -----------------------------------------------------------------


def _rows(batches, names, with_states: bool) -> Iterator[pa.RecordBatch]:
    """The state machine over slices whose first row has the entry; with ``with_states`` also the state at the end of
    each run (``state`` and ``slice``, no event)."""
    key = slice_id = st = target = None
    ended: list[tuple] = []

    def states():
        rows = pa.RecordBatch.from_pylist(
            [{"session_id": k[0], "target_id": k[1], "slice": s, "state": json.dumps(x)} for k, s, x in ended],
            schema=with_states)
        ended.clear()
        return rows

    for b in batches:
        if not b.num_rows:
            continue
        cols = BatchColumns(b)
        slices, entries, stored = b.column("slice").to_numpy(), b.column("entry"), b.column("stored")
        has_stored = stored.null_count < b.num_rows
        idx, rows = [], []
        cuts = [0, *(int(i) + 1 for i in (slices[1:] != slices[:-1]).nonzero()[0]), b.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            for a, z, k in key_runs(b.slice(lo, hi - lo)):
                a, z = a + lo, z + lo
                if k != key or int(slices[a]) != slice_id or st is None:
                    if st is not None and with_states:
                        ended.append((key, slice_id, state_list(st)))
                    entry = json.loads(entries[a].as_py()) if int(slices[a]) != slice_id and entries[a].is_valid else None
                    key, slice_id, target = k, int(slices[a]), fold_id(k[1])
                    st = state_of(entry[1]) if entry and tuple(entry[0]) == k else NeighbourState()
                for i in range(a, z):
                    if has_stored and stored[i].is_valid:
                        st = state_of(json.loads(stored[i].as_py()))
                    elif cols.step(st, target, i):
                        rows.append(st.output())
                        st.last_follower_id = st.follower[0]
                        idx.append(i)
        if idx:
            out = _emit_batch(b, idx, rows, names)
            if with_states:
                out = pa.RecordBatch.from_arrays([*out.columns, pa.nulls(len(idx), pa.int32()), pa.nulls(len(idx), pa.string())],
                                                 schema=with_states)
            yield out
        if len(ended) >= 1000:
            yield states()
    if st is not None and with_states:
        ended.append((key, slice_id, state_list(st)))
    if ended:
        yield states()


# -- the plan ----------------------------------------------------------------------------------


def _advanced(telemetry: DataFrame, targets, num_slices: int | None, stored: DataFrame | None, with_states: bool,
              fanout: int = FANOUT, broadcast_slices: int = BROADCAST_SLICES) -> DataFrame:
    spark = telemetry.sparkSession
    proj = _input_projection(attach_targets(telemetry, targets)).withColumn("stored", F.lit(None).cast("string"))
    if stored is not None:  # no time, partition or offset: ahead of the key's events
        proj = proj.unionByName(stored.select(*KEY, F.col("state").alias("stored")), allowMissingColumns=True)
        proj = proj.withColumn("car_position", F.coalesce("car_position", F.lit(0)))
    n = num_slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = ordered_slices(proj, n, [*KEY, *ORDER])
    out_schema = neighbour_schema(proj.schema["event_time"].dataType)
    if n == 1:
        entered = ordered.withColumn("entry", F.lit(None).cast("string"))
    else:
        entries = entry_states(ordered.select(*SUMMARY_COLUMNS).mapInArrow(_summaries, SUMMARY), n, fanout)
        small = n <= broadcast_slices
        entries = entries.select(F.col("slice").alias("of_slice"), "entry")
        first = place_in_slice() == 0  # only a slice's first row takes the state
        entered = ordered.join(F.broadcast(entries) if small else entries,
                               (F.col("slice") == F.col("of_slice")) & first, "left").drop("of_slice")
        if not small:
            entered = entered.sortWithinPartitions("slice", "place")
    entered = entered.drop("place")
    names = out_schema.fieldNames()
    if not with_states:
        return entered.mapInArrow(lambda it: _rows(it, names, None), out_schema)
    from pyspark.sql.pandas.types import to_arrow_schema

    both = _with_state(out_schema)
    arrow = to_arrow_schema(both)
    return entered.mapInArrow(lambda it: _rows(it, names, arrow), both)


def _with_state(schema):
    from pyspark.sql import types as T

    return T.StructType([*schema.fields, T.StructField("slice", T.IntegerType()), T.StructField("state", T.StringType())])


def track_neighbours_split(telemetry: DataFrame, targets, num_slices: int | None = None, fanout: int = FANOUT,
                           broadcast_slices: int = BROADCAST_SLICES) -> DataFrame:
    """See ``neighbours.track_neighbours``. The sorted slices are checkpointed while the plan is made."""
    return _advanced(telemetry, targets, num_slices, None, False, fanout, broadcast_slices)


def advance_neighbours(telemetry: DataFrame, targets, stored: DataFrame | None = None,
                       num_slices: int | None = None) -> DataFrame:
    """Neighbour rows from given states on, and the states at the end, in one frame.

    ``stored`` has ``session_id, target_id, state`` (one row per key). Rows have a null ``state``; the others have a
    key, its ``state`` and ``slice``, of which the greatest slice counts (``last_states``).
    """
    return _advanced(telemetry, targets, num_slices, stored, True)


def last_states(advanced: DataFrame) -> DataFrame:
    """``session_id, target_id, state`` of every key (also a null one) at the end."""
    return (advanced.where("state is not null").groupBy(*KEY).agg(F.max_by("state", "slice").alias("state")))
