"""Gap analysis and the gap reports (stateless, pure Column expressions)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from racestream.functions.arith import seconds_at_speed
from racestream.functions.text import java_concat

GAP_COLUMNS = ["meters_from_follower", "secs_from_follower", "meters_to_leader", "secs_to_leader"]


def with_gaps(neighbours: DataFrame, require_details: bool = False) -> DataFrame:
    """Add the four gaps to neighbour rows.

    metres from follower = me - follower lap position (32-bit float);
    seconds = metres / (0.278 x follower speed) in doubles, then 32-bit;
    metres to leader = leader - me lap position; seconds likewise.
    Computed in that order, and a missing input stops the rest, as the job's
    caught exception does: no follower -> all four null; follower but no
    leader -> only the follower pair. A zero speed gives +-Infinity (NaN at
    zero distance). Lap numbers are ignored. ``require_details`` keeps only rows
    where all three cars are known.
    """
    c = F.col
    ok1 = c("me_lap_position").isNotNull() & c("follower_lap_position").isNotNull()
    ok2 = ok1 & c("follower_speed_kph").isNotNull()
    ok3 = ok2 & c("leader_lap_position").isNotNull()
    ok4 = ok3 & c("leader_speed_kph").isNotNull()
    m_from = c("me_lap_position") - c("follower_lap_position")
    m_to = c("leader_lap_position") - c("me_lap_position")
    out = neighbours.select(
        "*",
        F.when(ok1, m_from).alias("meters_from_follower"),
        F.when(ok2, seconds_at_speed(m_from, c("follower_speed_kph"))).alias("secs_from_follower"),
        F.when(ok3, m_to).alias("meters_to_leader"),
        F.when(ok4, seconds_at_speed(m_to, c("leader_speed_kph"))).alias("secs_to_leader"),
    )
    if require_details:
        out = out.filter(complete_rows())
    return out


def without_gaps(neighbours: DataFrame) -> DataFrame:
    """Neighbour rows with the four gaps null (a report made before any gap step)."""
    return neighbours.select("*", *[F.lit(None).cast("float").alias(c) for c in GAP_COLUMNS])


def complete_rows():
    """All three cars known (each has been taken from an event at least once)."""
    c = F.col
    return c("me_has_details") & c("follower_has_details") & c("leader_has_details")


def gap_report(gaps: DataFrame) -> DataFrame:
    """The three-line gap text of each row, as the monitoring job prints it.

    Null prints as ``null``; "fuel remaining in laps:" prints the lap number;
    the fuel text glues speed and fuel in the tank.
    """
    c = F.col
    # The wording of the gap report, in the order printed.
    text = java_concat(
        "behind : ", c("leader_driver_id"), " by ", c("meters_to_leader"), "m or by ",
        c("secs_to_leader"), "s\n",
        "ahead of : ", c("follower_driver_id"), " by ", c("meters_from_follower"), "m or by ",
        c("secs_from_follower"), "s\n",
        "    (Current driver status:", c("driver_status"), " car-position:", c("event_car_position"),
        " curr-lap:", c("event_lap"), " speed:", c("event_speed"), " fuel remaining in laps:",
        c("event_lap"), "\n",
        " fuel in tank:", c("event_speed"), c("fuel_in_tank"), " driver:", c("event_driver_id"), " ) ")
    return gaps.select("session_id", "target_id", "seq", text.alias("report"))


# Fixed value: the header line of the gap CSV, as the job writes it.
CSV_HEADER = ("Race, MyDriver, FollowerDriver, LeaderDriver, SpeedInKPH, GForceLateral,"
              "GForceLongitudinal, DistanceBehind(meters), DistanceAhead(meters), Position, Lap")
CSV_COLUMNS = ["race", "my_driver", "follower_driver", "leader_driver", "speed_in_kph",
               "g_force_lateral", "g_force_longitudinal", "distance_behind_meters",
               "distance_ahead_meters", "position", "lap"]


def gap_csv(gaps: DataFrame) -> DataFrame:
    """The 11 CSV fields of complete rows, in the job's order.

    Rows where a car is still unknown are dropped; the writer puts the header
    once per file instead of once per such row.
    """
    c = F.col
    return gaps.filter(complete_rows()).select(
        "session_id", "target_id", "seq",
        c("me_race_number").alias("race"),
        c("me_driver_id").alias("my_driver"),
        c("follower_driver_id").alias("follower_driver"),
        c("leader_driver_id").alias("leader_driver"),
        c("me_speed_kph").alias("speed_in_kph"),
        c("me_g_force_lateral").alias("g_force_lateral"),
        c("me_g_force_longitudinal").alias("g_force_longitudinal"),
        c("meters_to_leader").alias("distance_behind_meters"),
        c("meters_from_follower").alias("distance_ahead_meters"),
        c("me_car_position").alias("position"),
        c("me_lap").alias("lap"),
    )


def csv_lines(csv_rows: DataFrame) -> DataFrame:
    """Each CSV row as one comma-joined text line (Java number text)."""
    return csv_rows.select(
        "session_id", "target_id", "seq",
        F.concat_ws(",", *[java_concat(F.col(n)) for n in CSV_COLUMNS]).alias("line"))
