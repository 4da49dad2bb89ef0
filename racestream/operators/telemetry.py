"""Telemetry operators: decode, drop undecodable records, status text, byte dump."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from racestream.functions.json import STRICT
from racestream.functions.text import java_concat
from racestream.schemas import TELEMETRY_COLUMNS, TELEMETRY_PAYLOAD_SCHEMA

# the parser keeps the text of a record here that it could not read in whole
BAD = "_unreadable"


def _decoded(messages: DataFrame) -> DataFrame:
    """(p, event_time, seq) with ``p`` the parsed body, parsed once per message.

    The row goes through a one-element array and ``inline``: a filter on ``p``
    then stays above the parse. Through a plain projection Catalyst would push
    the filter below it and inline ``from_json`` into it, parsing every
    message twice.
    """
    schema = T.StructType([*TELEMETRY_PAYLOAD_SCHEMA.fields, T.StructField(BAD, T.StringType())])
    body = F.from_json(F.col("value").cast("string"), schema, {**STRICT, "columnNameOfCorruptRecord": BAD})
    return messages.select(F.col("timestamp").alias("event_time"), F.col("partition"), F.col("offset").alias("seq"),
                           F.inline(F.array(F.struct(body.alias("p")))))


def _decodable():
    """The body parsed in whole (no field of a wrong type or out of range) and
    names a driver and a position."""
    return (F.col("p.driver_id").isNotNull() & F.col("p.car_position").isNotNull()
            & F.col(f"p.{BAD}").isNull())


def decode_telemetry(messages: DataFrame, observe: str | None = None) -> DataFrame:
    """Kafka-layout messages -> typed telemetry rows; undecodable ones dropped.

    A message that is null, not JSON, has a field of a wrong type or out of its
    range, or no driver id or position yields no row and no failure. Event time
    is the message timestamp; ``partition`` and ``seq`` (its offset, counted per
    partition) are its place in the topic. With
    ``observe``, the counts of messages read and dropped are reported under
    that name (``Observation`` in batch, ``observedMetrics`` of each
    micro-batch in streams), at no extra pass.
    """
    d = _decoded(messages)
    if observe:
        d = d.observe(observe, F.count(F.lit(1)).alias("n_messages"),
                      F.count_if(~_decodable()).alias("n_dropped"))
    cols = [F.col(f"p.{c}").alias(c) if c not in ("event_time", "partition", "seq") else F.col(c)
            for c in TELEMETRY_COLUMNS]
    return d.filter(_decodable()).select(*cols)


def telemetry_quality(messages: DataFrame) -> DataFrame:
    """One row: messages read, decoded, dropped."""
    d = _decoded(messages)
    return d.agg(
        F.count(F.lit(1)).alias("n_messages"),
        F.count_if(_decodable()).cast("long").alias("n_decoded"),
        F.count_if(~_decodable()).cast("long").alias("n_dropped"))


def status_lines(telemetry: DataFrame) -> DataFrame:
    """The driver status line of each record, next to clean typed columns.

    Kept as the job prints it: after "fuel remaining in laps:" comes the lap
    number glued to the fuel laps, after "fuel in tank:" the speed glued to the
    fuel in the tank.
    """
    c = F.col
    # The labels of the status line, in the order printed.
    line = java_concat(
        "  driverstatus:", c("driver_status"),
        " car-position:", c("car_position"),
        " curr-lap:", c("current_lap_num"),
        " speed:", c("speed"),
        " fuel remaining in laps:", c("current_lap_num"), c("fuel_remaining_laps"),
        " fuel in tank:", c("speed"), c("fuel_in_tank"),
        " driver:", c("driver_id"))
    return telemetry.select("session_id", "seq", "race_number", "driver_id", line.alias("line"))


def dump_bytes(messages: DataFrame) -> DataFrame:
    """Raw message bytes as hexadecimal text, one line per message."""
    return messages.select("offset", F.hex(F.col("value")).alias("hex"))
