"""Neighbour tracking: the tracked car, the car just behind and the car just ahead.

State per ``(session_id, target_id)``: ``me`` (the tracked car), ``follower``,
``leader`` and a ``tracking`` latch. Events of a key are taken in
``(event_time, partition, seq)`` order. For an event with car position ``p``:

1. the target's own event replaces ``me``;
2. a follower not behind ``me`` any more loses its id (``NOFOLLOWER``) but keeps
   its position, lap, distance and speed;
3. another car behind ``me`` becomes the follower when there is none, or when it
   is at or ahead of the follower's position (and ``p > 0``; this also starts
   tracking);
4. a leader not ahead of ``me`` any more loses its id (``NOLEADER``);
5. another car ahead of ``me`` becomes the leader when there is none (position 0
   accepted), or when ``0 < p`` and it is at or behind the leader's position
   (this starts tracking);
6. once tracking, an event of one of the three cars emits a row.

It is a latch, not a nearest-neighbour query: a follower that falls back keeps
its entry until another car fits or ``me`` drops behind it. Car ids are
compared ignoring case. ``prev_follower_id`` is the follower id of the key's
previous output row, which the follower-change pattern reads.

Events of one time are ordered by their place in the topic (partition, then
``seq``), so the order is total.

Execution: the only operator that leaves Catalyst. Batch input is range-split
into slices, also within a key (``neighbours_split``). Streams use
``applyInPandasWithState`` with the same ``step``; a key's rows of one
micro-batch are sorted in one task, packed into some seventy bytes a row, and its
output leaves in frames of bounded length; the source's rate (``maxOffsetsPerTrigger``,
``maxFilesPerTrigger``) bounds what a task holds.
"""

from __future__ import annotations

import json

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from racestream.schemas import (
    CAR_FIELDS, ME_DETAIL_FIELDS, NEIGHBOUR_STATE_SCHEMA, neighbour_schema,
)

# The placeholder ids of the reference state machine and its
# tracked driver.
NO_FOLLOWER = "NOFOLLOWER"
NO_LEADER = "NOLEADER"
NO_DRIVER = "NULL"
DEFAULT_TARGET = "ANTONIO_GIOVINAZZI"

STATE_OUT_COLUMNS = (
    [f"me_{n}" for n, _ in CAR_FIELDS]
    + [f"me_{n}" for n, _ in ME_DETAIL_FIELDS]
    + [f"follower_{n}" for n, _ in CAR_FIELDS]
    + [f"leader_{n}" for n, _ in CAR_FIELDS]
    + ["tracking", "prev_follower_id"]
)


def fold_ids(ids: list) -> list:
    """Ids in lower case, by the one library (Arrow) that batch and stream use:
    case mappings differ between libraries for some letters."""
    return pc.utf8_lower(pa.array(ids, type=pa.string())).to_pylist()


def fold_id(s):
    return fold_ids([s])[0]


class NeighbourState:
    """Mutable state of one key. Cars are lists:
    ``[driver_id, car_position, lap, lap_position, speed_kph, has_details]``."""

    __slots__ = ("me", "me_details", "follower", "leader", "tracking", "last_follower_id",
                 "me_key", "f_key", "l_key")

    def __init__(self, me=None, me_details=None, follower=None, leader=None,
                 tracking=False, last_follower_id=None):
        self.me = me if me is not None else [NO_DRIVER, 0, None, 0.0, None, False]
        self.me_details = me_details if me_details is not None else [None, None, None]
        self.follower = follower if follower is not None else [NO_FOLLOWER, 0, None, None, None, False]
        self.leader = leader if leader is not None else [NO_LEADER, 0, None, None, None, False]
        self.tracking = tracking
        self.last_follower_id = last_follower_id
        # ids in lower case, for the case-insensitive comparisons
        self.me_key, self.f_key, self.l_key = fold_ids([self.me[0], self.follower[0], self.leader[0]])

    # -- stream state <-> object -------------------------------------------------
    def to_tuple(self) -> tuple:
        return (*self.me, *self.me_details, *self.follower, *self.leader,
                self.tracking, self.last_follower_id)

    @classmethod
    def from_tuple(cls, t) -> "NeighbourState":
        t = list(t)
        n = len(CAR_FIELDS)
        d = len(ME_DETAIL_FIELDS)
        me = t[0:n]
        det = t[n:n + d]
        fol = t[n + d:2 * n + d]
        lea = t[2 * n + d:3 * n + d]
        return cls(me, det, fol, lea, bool(t[3 * n + d]), t[3 * n + d + 1])  # a history may follow

    def output(self) -> tuple:
        """State part of an output row (see ``STATE_OUT_COLUMNS``)."""
        return (*self.me, *self.me_details, *self.follower, *self.leader,
                self.tracking, self.last_follower_id)


_NO_DETAILS = (None, None, None)
_NO_FOLLOWER_KEY = NO_FOLLOWER.lower()
_NO_LEADER_KEY = NO_LEADER.lower()


def step(st: NeighbourState, target_key: str, driver_id: str, pos: int, lap, dist, speed,
         details=(None, None, None), key: str | None = None) -> bool:
    """Apply one event to ``st``; True when the event emits a row.

    ``target_key`` is the tracked id in lower case, ``key`` the event's driver
    id in lower case (computed when not given); ``pos`` is never null.
    The take rules are the two-step rules of the module doc folded into one
    branch each: taking a car with no follower (leader) at hand also satisfies
    the "at or ahead (behind)" rule, so it starts tracking when ``p > 0``.
    """
    if key is None:
        key = fold_id(driver_id)
    is_target = key == target_key
    if is_target:
        st.me = [driver_id, pos, lap, dist, speed, True]
        st.me_details = list(details)
        st.me_key = key
    m = st.me[1]
    other = not is_target and m != 0

    f = st.follower
    if f[1] <= m:
        f[0] = NO_FOLLOWER
        st.f_key = _NO_FOLLOWER_KEY
    if other and pos > m and (f[0] == NO_FOLLOWER or (pos > 0 and pos <= f[1])):
        st.follower = [driver_id, pos, lap, dist, speed, True]
        st.f_key = key
        if pos > 0:
            st.tracking = True

    ld = st.leader
    if ld[1] >= m:
        ld[0] = NO_LEADER
        st.l_key = _NO_LEADER_KEY
    if other and pos < m and (ld[0] == NO_LEADER or (pos > 0 and pos >= ld[1])):
        st.leader = [driver_id, pos, lap, dist, speed, True]
        st.l_key = key
        if pos > 0:
            st.tracking = True

    return st.tracking and (key == st.me_key or key == st.f_key or key == st.l_key)


# ---------------------------------------------------------------------------
# Targets


def attach_targets(telemetry: DataFrame, targets) -> DataFrame:
    """Pair every event with each tracked target of its session.

    ``targets`` is a list of ids (tracked in every session: no join at all) or a
    ``(session_id, target_id)`` table, for whose join Spark picks the strategy.
    """
    if isinstance(targets, str):
        targets = [targets]
    if isinstance(targets, (list, tuple)):
        # a repeated id would feed every event twice into the same key
        ids = F.array(*[F.lit(t) for t in dict.fromkeys(targets)])
        return telemetry.withColumn("target_id", F.explode(ids))
    return telemetry.join(targets.select("session_id", "target_id").distinct(), "session_id")


ORDER = ["event_time", "partition", "seq"]


def _input_projection(df: DataFrame) -> DataFrame:
    """The columns the state machine reads, typed, projected before the shuffle
    (Catalyst cannot see which columns Python uses). NaN counts as missing; a
    source without partitions is one partition."""
    c = F.col
    number = lambda name: F.when(~F.isnan(c(name).cast("float")), c(name).cast("float")).alias(name)
    partition = c("partition").cast("int") if "partition" in df.columns else F.lit(0)
    return df.select(
        c("session_id"), c("target_id"), c("event_time"), partition.alias("partition"), c("seq"), c("driver_id"),
        c("driver_status"),
        F.coalesce(c("car_position").cast("int"), F.lit(0)).alias("car_position"),
        c("current_lap_num").cast("int").alias("current_lap_num"),
        number("lap_distance"),
        c("speed").cast("int").alias("speed"),
        number("fuel_in_tank"),
        c("race_number").cast("int").alias("race_number"),
        number("g_force_lateral"),
        number("g_force_longitudinal"),
    )


# ---------------------------------------------------------------------------
# Arrow output assembly

_ARROW = {
    T.StringType: pa.string(), T.IntegerType: pa.int32(), T.LongType: pa.int64(),
    T.FloatType: pa.float32(), T.BooleanType: pa.bool_(), T.ShortType: pa.int16(),
}


def _state_arrow_types():
    types = []
    for prefix, fields in (("me", CAR_FIELDS), ("me", ME_DETAIL_FIELDS),
                           ("follower", CAR_FIELDS), ("leader", CAR_FIELDS)):
        types += [_ARROW[type(t)] for _, t in fields]
    return types + [pa.bool_(), pa.string()]


_STATE_TYPES = _state_arrow_types()
_EVENT_SOURCES = [  # output column <- input column
    ("event_driver_id", "driver_id", pa.string()),
    ("driver_status", "driver_status", pa.string()),
    ("event_car_position", "car_position", pa.int32()),
    ("event_lap", "current_lap_num", pa.int32()),
    ("event_speed", "speed", pa.int32()),
    ("fuel_in_tank", "fuel_in_tank", pa.float32()),
]


def _emit_batch(batch: pa.RecordBatch, idx: list, rows: list, names: list) -> pa.RecordBatch:
    take = pa.array(idx, type=pa.int64())
    arrays = [batch.column("session_id").take(take), batch.column("target_id").take(take),
              batch.column("partition").take(take), batch.column("seq").take(take), batch.column("event_time").take(take)]
    for _, src, typ in _EVENT_SOURCES:
        arrays.append(batch.column(src).take(take).cast(typ))
    cols = list(zip(*rows)) if rows else [[] for _ in _STATE_TYPES]
    for values, typ in zip(cols, _STATE_TYPES):
        arrays.append(pa.array(list(values), type=typ))
    return pa.RecordBatch.from_arrays(arrays, names=names)


def pylist(a) -> list:
    """Arrow array -> Python list; through numpy when there is no null (much
    faster than ``to_pylist``, which builds one scalar object per value)."""
    if a.null_count == 0:
        return a.to_numpy(zero_copy_only=False).tolist()
    return a.to_pylist()


_NULL_KEY = "\x00"


def key_runs(batch: pa.RecordBatch) -> list:
    """(lo, hi, (session_id, target_id)) of each run of equal keys in a sorted batch."""
    n = batch.num_rows
    sess = pc.fill_null(batch.column("session_id"), _NULL_KEY)
    tgt = pc.fill_null(batch.column("target_id"), _NULL_KEY)
    if n > 1:
        change = pc.or_(pc.not_equal(sess.slice(1), sess.slice(0, n - 1)),
                        pc.not_equal(tgt.slice(1), tgt.slice(0, n - 1)))
        starts = [0] + [i + 1 for i in pc.indices_nonzero(change).to_pylist()]
    else:
        starts = [0]
    s_raw, t_raw = batch.column("session_id"), batch.column("target_id")
    bounds = starts + [n]
    return [(bounds[r], bounds[r + 1], (s_raw[bounds[r]].as_py(), t_raw[bounds[r]].as_py()))
            for r in range(len(starts))]


class BatchColumns:
    """The columns ``step`` reads, as Python lists, read once per batch."""

    __slots__ = ("drv", "key", "pos", "lap", "dist", "spd", "rno", "glat", "glon")

    def __init__(self, b: pa.RecordBatch):
        self.drv = pylist(b.column("driver_id"))
        self.key = pylist(pc.utf8_lower(b.column("driver_id")))
        self.pos = pylist(b.column("car_position"))
        self.lap = pylist(b.column("current_lap_num"))
        self.dist = pylist(b.column("lap_distance"))
        self.spd = pylist(b.column("speed"))
        self.rno = pylist(b.column("race_number"))
        self.glat = pylist(b.column("g_force_lateral"))
        self.glon = pylist(b.column("g_force_longitudinal"))

    def step(self, st: NeighbourState, target_key: str, i: int) -> bool:
        return step(st, target_key, self.drv[i], self.pos[i], self.lap[i], self.dist[i], self.spd[i],
                    (self.rno[i], self.glat[i], self.glon[i]), self.key[i])


def track_neighbours(telemetry: DataFrame, targets=DEFAULT_TARGET, num_partitions: int | None = None) -> DataFrame:
    """Neighbour rows for every tracked target of every session (batch).

    Every key is cut into balanced slices that run in parallel from exactly
    resolved entry states (``neighbours_split``), so one race may hold any share
    of the rows. ``num_partitions``: the slices (default:
    ``spark.sql.shuffle.partitions``).
    """
    from racestream.operators.neighbours_split import track_neighbours_split

    return track_neighbours_split(telemetry, targets, num_slices=num_partitions)


# ---------------------------------------------------------------------------
# Streaming: one group per key, state in Spark's state store


#: output rows of a stream are handed on in frames made of so many input rows
STREAM_ROWS = 1 << 13

_STREAM_FIELDS = pa.schema([
    ("event_time", pa.timestamp("ns")), ("partition", pa.int32()), ("seq", pa.int64()),
    ("driver_id", pa.string()), ("driver_status", pa.string()), ("car_position", pa.int32()),
    ("current_lap_num", pa.int32()), ("lap_distance", pa.float32()), ("speed", pa.int32()), ("fuel_in_tank", pa.float32()),
    ("race_number", pa.int32()), ("g_force_lateral", pa.float32()), ("g_force_longitudinal", pa.float32()),
])
_CODED = pa.dictionary(pa.int32(), pa.string())


def _in_order(frames):
    """The rows of pandas frames in ``ORDER``, as Arrow batches of ``STREAM_ROWS``.

    The sort holds some seventy bytes a row: numbers, and strings as numbers of distinct strings.
    """
    columns: dict[str, list] = {f.name: [] for f in _STREAM_FIELDS}
    for pdf in frames:
        for f in _STREAM_FIELDS:
            a = pa.array(pdf[f.name], type=f.type, from_pandas=True)
            columns[f.name].append(a.dictionary_encode() if f.type == pa.string() else a)
    # one column after the other, so that never more than one is there twice
    for f in _STREAM_FIELDS:
        parts = pa.chunked_array(columns.pop(f.name), type=_CODED if f.type == pa.string() else f.type)
        columns[f.name] = parts.unify_dictionaries().combine_chunks()
        del parts
    rows = pa.RecordBatch.from_arrays([columns[c] for c in _STREAM_FIELDS.names], _STREAM_FIELDS.names)
    order = pc.sort_indices(rows, sort_keys=[(c, "ascending") for c in ORDER])
    for at in range(0, len(order), STREAM_ROWS):
        part = rows.take(order.slice(at, STREAM_ROWS))
        yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(part.columns, _STREAM_FIELDS)], schema=_STREAM_FIELDS)


def stream_handler(key, pdf_iter, state, idle_ms: int | None = None, history: int = 0):
    """``applyInPandasWithState`` function: rows of one key in a micro-batch.

    With ``idle_ms`` the key's state is dropped once the watermark passes its
    latest event time by that much (event-time timeout). With ``history`` the
    state also holds the key's last output rows (JSON), which each row carries.
    """
    if state.hasTimedOut:
        state.remove()
        return
    session_id, target_id = key
    st = NeighbourState.from_tuple(state.get) if state.exists else NeighbourState()
    kept: list = json.loads(state.get[-1]) if history and state.exists else []
    latest_ms = None

    def frames():
        nonlocal latest_ms
        for pdf in pdf_iter:
            if len(pdf):
                if idle_ms is not None:
                    ms = pdf["_event_ms"].max()
                    latest_ms = ms if latest_ms is None or not latest_ms >= ms else latest_ms
                yield pdf

    target_key = fold_id(target_id)
    met = False
    for batch in _in_order(frames()):
        met = True
        out, kept = _advanced(st, key, target_key, batch, kept, history)
        if out is not None:
            yield out
    if not met:
        return
    state.update((*st.to_tuple(), json.dumps(kept)) if history else st.to_tuple())
    if idle_ms is not None:
        state.setTimeoutTimestamp(max(int(latest_ms) + idle_ms, state.getCurrentWatermarkMs() + 1))


def _advanced(st: NeighbourState, key, target_key: str, batch: pa.RecordBatch, kept: list, history: int):
    """Take the events of ``batch``: its output rows as a pandas frame (None: no row), and the last ones as JSON."""
    import pandas as pd

    session_id, target_id = key
    cols = BatchColumns(batch)
    idx, rows = [], []
    for i in range(batch.num_rows):
        if cols.step(st, target_key, i):
            rows.append(st.output())
            st.last_follower_id = st.follower[0]
            idx.append(i)
    if not idx:
        return None, kept
    ev = batch.take(pa.array(idx, type=pa.int64())).to_pandas(types_mapper={pa.int32(): pd.Int32Dtype()}.get)
    out = pd.DataFrame({
        "session_id": session_id, "target_id": target_id, "partition": ev["partition"],
        "seq": ev["seq"], "event_time": ev["event_time"],
        "event_driver_id": ev["driver_id"], "driver_status": ev["driver_status"],
        "event_car_position": ev["car_position"], "event_lap": ev["current_lap_num"],
        "event_speed": ev["speed"], "fuel_in_tank": ev["fuel_in_tank"],
    })
    # nullable types by name: a column may be all null
    state_columns = {name: pd.array(list(values), dtype=_PANDAS[typ])
                     for name, typ, values in zip(STATE_OUT_COLUMNS, _STATE_TYPES, zip(*rows))}
    if history:
        previous: list = []
        events = zip(*(ev[c] for c in ("partition", "seq", "event_time", "driver_status", "fuel_in_tank")))
        for i, row, (partition, seq, time, status, fuel) in zip(idx, rows, events):
            previous.append("[" + ",".join(kept) + "]")
            kept = [*kept, json.dumps({
                "session_id": session_id, "target_id": target_id, "partition": int(partition), "seq": int(seq),
                "event_time": _time_text(time), "event_driver_id": cols.drv[i],
                "driver_status": _value(status), "event_car_position": cols.pos[i], "event_lap": cols.lap[i],
                "event_speed": cols.spd[i], "fuel_in_tank": _value(fuel), **dict(zip(STATE_OUT_COLUMNS, row))})][-history:]
        state_columns["previous"] = previous
    return pd.concat([out, pd.DataFrame(state_columns)], axis=1), kept


def _value(v):
    """A pandas value as JSON takes it; missing ones as None."""
    return None if v is None or v != v else v if isinstance(v, str) else float(v)


def _time_text(v) -> str | None:
    return None if v is None or v != v else v.strftime("%Y-%m-%d %H:%M:%S.%f")


TIME_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


_PANDAS = {pa.string(): "string", pa.int32(): "Int32", pa.float32(): "Float32", pa.bool_(): "boolean"}


def track_neighbours_stream(telemetry: DataFrame, targets=DEFAULT_TARGET,
                            idle_timeout: str | None = None, history: int = 0) -> DataFrame:
    """Neighbour rows of a streaming telemetry frame (append mode).

    Within a micro-batch a key's rows are ordered by ``(event_time, partition, seq)``;
    across micro-batches they are taken in arrival order. ``targets`` is a list
    of ids or a static ``(session_id, target_id)`` table.

    By default a key's state is kept for ever (as the original does), so state
    grows with the number of races seen. ``idle_timeout`` (e.g. ``"2 hours"``)
    bounds it: the event time gets a watermark with that delay and a key whose
    latest event is older than the watermark by ``idle_timeout`` is dropped
    (a later event of it starts afresh).

    ``history``: each row has the key's last output rows before it in ``previous``
    (at most so many, oldest first), for patterns over several rows.
    """
    import functools

    from pyspark.sql.streaming.state import GroupStateTimeout

    from racestream.functions.time import ntz_to_instant

    # ids need no join; a static targets table gives a stream-static join
    projected = _input_projection(attach_targets(telemetry, targets))
    row_schema = out_schema = neighbour_schema(projected.schema["event_time"].dataType)
    state_schema, handler = NEIGHBOUR_STATE_SCHEMA, stream_handler
    if history:
        out_schema = T.StructType([*row_schema.fields, T.StructField("previous", T.StringType())])
        state_schema = T.StructType([*state_schema.fields, T.StructField("history", T.StringType())])
        handler = functools.partial(handler, history=history)

    def finished(out: DataFrame) -> DataFrame:
        if not history:
            return out
        formats = {"timestampNTZFormat": TIME_TEXT, "timestampFormat": TIME_TEXT, "allowNonNumericNumbers": "true"}
        return out.withColumn("previous", F.from_json("previous", T.ArrayType(row_schema), formats))

    if idle_timeout is None:
        return finished(projected.groupBy("session_id", "target_id")
                        .applyInPandasWithState(handler, out_schema, state_schema, "append", GroupStateTimeout.NoTimeout))
    et = projected.schema["event_time"].dataType
    instant = ntz_to_instant(F.col("event_time")) if isinstance(et, T.TimestampNTZType) else F.col("event_time")
    with_wm = (projected.withColumn("_event_instant", instant)
               .withColumn("_event_ms", F.unix_millis(F.col("_event_instant")))
               .withWatermark("_event_instant", idle_timeout))
    idle_ms = _interval_ms(telemetry.sparkSession, idle_timeout)
    handler = functools.partial(handler, idle_ms=idle_ms)
    return finished(with_wm.groupBy("session_id", "target_id")
                    .applyInPandasWithState(handler, out_schema, state_schema, "append", GroupStateTimeout.EventTimeTimeout))


def _interval_ms(spark, text: str) -> int:
    """Milliseconds of an interval text such as ``"2 hours"`` (parsed by Spark)."""
    row = spark.sql(f"SELECT CAST(unix_micros(TIMESTAMP'1970-01-01 00:00:00Z' + INTERVAL {text}) / 1000 AS BIGINT) AS ms").first()
    return int(row["ms"])
