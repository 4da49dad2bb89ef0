"""Declared schemas. Nothing is inferred at run time."""

from pyspark.sql import types as T

# A click as it arrives: JSON body, event time beside it, tie-break sequence.
CLICK_SCHEMA = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("seq", T.LongType()),
])

# The JSON body of one telemetry message.
TELEMETRY_PAYLOAD_SCHEMA = T.StructType([
    T.StructField("session_id", T.StringType()),
    T.StructField("driver_id", T.StringType()),
    T.StructField("race_number", T.ShortType()),
    T.StructField("driver_status", T.StringType()),
    T.StructField("car_position", T.ShortType()),
    T.StructField("current_lap_num", T.ShortType()),
    T.StructField("lap_distance", T.FloatType()),
    T.StructField("speed", T.IntegerType()),
    T.StructField("fuel_in_tank", T.FloatType()),
    T.StructField("fuel_remaining_laps", T.FloatType()),
    T.StructField("g_force_lateral", T.FloatType()),
    T.StructField("g_force_longitudinal", T.FloatType()),
])

# A decoded telemetry record: the payload plus event time and its place: the
# topic partition and the offset there (``seq``), which is counted per partition.
TELEMETRY_COLUMNS = [
    "session_id", "event_time", "partition", "seq", "driver_id", "race_number", "driver_status",
    "car_position", "current_lap_num", "lap_distance", "speed", "fuel_in_tank",
    "fuel_remaining_laps", "g_force_lateral", "g_force_longitudinal",
]

# Fields of one car kept in the neighbour state.
CAR_FIELDS = [
    ("driver_id", T.StringType()),
    ("car_position", T.IntegerType()),
    ("lap", T.IntegerType()),
    ("lap_position", T.FloatType()),
    ("speed_kph", T.IntegerType()),
    ("has_details", T.BooleanType()),
]

# Details of the tracked car that the CSV report needs.
ME_DETAIL_FIELDS = [
    ("race_number", T.IntegerType()),
    ("g_force_lateral", T.FloatType()),
    ("g_force_longitudinal", T.FloatType()),
]

# Columns of the event that caused an output row.
EVENT_OUT_FIELDS = [
    ("event_driver_id", T.StringType()),
    ("driver_status", T.StringType()),
    ("event_car_position", T.IntegerType()),
    ("event_lap", T.IntegerType()),
    ("event_speed", T.IntegerType()),
    ("fuel_in_tank", T.FloatType()),
]


def _car(prefix):
    return [T.StructField(f"{prefix}_{n}", t) for n, t in CAR_FIELDS]


NEIGHBOUR_SCHEMA = T.StructType(
    [
        T.StructField("session_id", T.StringType()),
        T.StructField("target_id", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("seq", T.LongType()),
        T.StructField("event_time", T.TimestampNTZType()),
    ]
    + [T.StructField(n, t) for n, t in EVENT_OUT_FIELDS]
    + _car("me")
    + [T.StructField(f"me_{n}", t) for n, t in ME_DETAIL_FIELDS]
    + _car("follower")
    + _car("leader")
    + [
        T.StructField("tracking", T.BooleanType()),
        # follower id of the key's previous output row (null on the first)
        T.StructField("prev_follower_id", T.StringType()),
    ]
)


def neighbour_schema(event_time_type: T.DataType) -> T.StructType:
    """The neighbour schema with the event-time type of the input."""
    return T.StructType([
        T.StructField(f.name, event_time_type) if f.name == "event_time" else f
        for f in NEIGHBOUR_SCHEMA.fields
    ])


# State carried per (session_id, target_id) in a stream: the three cars,
# the tracking latch and the follower id of the last emitted row (for the
# follower-change pattern, which needs the previous output row).
NEIGHBOUR_STATE_SCHEMA = T.StructType(
    _car("me")
    + [T.StructField(f"me_{n}", t) for n, t in ME_DETAIL_FIELDS]
    + _car("follower")
    + _car("leader")
    + [
        T.StructField("tracking", T.BooleanType()),
        T.StructField("last_follower_id", T.StringType()),
    ]
)
