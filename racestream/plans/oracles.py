"""DuckDB SQL for each registered query, written independently of the Spark code.

The telemetry state machine is restated as a recursive query: the state after
event ``rn`` of a session joins event ``rn + 1``.
"""

from __future__ import annotations

import re

TARGET = "DRIVER_07"

CLICKS = """
clicks AS (
  SELECT event_id AS seq, ts,
         CASE event_id % 50
           WHEN 0 THEN '{''user.accountId'':5}'
           WHEN 1 THEN '{"user.accountId":"77"}'
           WHEN 2 THEN '{"user.accountId":3000000000}'
           WHEN 3 THEN 'junk'
           WHEN 4 THEN NULL
           ELSE '{"user.accountId":' || CAST(CASE WHEN event_type = 'error' THEN -1 ELSE user_id END AS VARCHAR)
                || ',"page":"' || event_type || '"}' END AS raw,
         CASE WHEN event_id % 50 >= 5
              THEN CAST(CASE WHEN event_type = 'error' THEN -1 ELSE user_id END AS INTEGER) END AS account_id
  FROM events
),
authed AS (SELECT * FROM clicks WHERE account_id IS NOT NULL AND account_id <> -1)
"""

SLIDING = """
sliding AS (
  SELECT account_id, window_start, window_start + INTERVAL 7 DAY AS window_end, count(*) AS n
  FROM (
    SELECT account_id,
           CAST(date_trunc('day', ts) AS TIMESTAMP) - to_days(CAST(i AS INTEGER)) AS window_start
    FROM authed, range(7) AS t(i)
  ) GROUP BY account_id, window_start
)
"""

TUMBLING = """
tumbling AS (
  SELECT account_id, window_start, window_start + INTERVAL 7 DAY AS window_end, count(*) AS n
  FROM (
    SELECT account_id,
           TIMESTAMP '1970-01-01 00:00:00'
             + to_days(CAST(floor(datediff('day', TIMESTAMP '1970-01-01 00:00:00', ts) / 7) * 7 AS INTEGER))
             AS window_start
    FROM authed
  ) GROUP BY account_id, window_start
)
"""

TELEMETRY = """
tel_src AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
),
telemetry AS (
  SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id,
         CAST(date_trunc('hour', ts) AS TIMESTAMP) AS event_time,
         CAST(event_id % 3 AS INTEGER) AS partition,
         event_id // 3 AS seq,
         'DRIVER_' || lpad(CAST(user_id % 20 AS VARCHAR), 2, '0') AS driver_id,
         CAST(user_id % 20 AS SMALLINT) AS race_number,
         event_type AS driver_status,
         CAST(k % 21 AS SMALLINT) AS car_position,
         CAST(hour(ts) + 1 AS SMALLINT) AS current_lap_num,
         CAST(CAST(CAST(value * 10 AS DECIMAL(18,1)) AS VARCHAR) AS FLOAT) AS lap_distance,
         CAST(3 * k AS INTEGER) AS speed,
         CAST(k AS FLOAT) AS fuel_in_tank,
         CAST(k % 10 AS FLOAT) AS fuel_remaining_laps,
         CAST(CAST(CAST(value / 100 AS DECIMAL(18,4)) AS VARCHAR) AS FLOAT) AS g_force_lateral,
         CAST(CAST(CAST(-(value / 100) AS DECIMAL(18,4)) AS VARCHAR) AS FLOAT) AS g_force_longitudinal
  FROM tel_src
  WHERE k <> 0
)
"""

MESSAGES = """
messages AS (
  SELECT event_id // 3 AS "offset",
         CASE WHEN k <> 0 THEN
           '{"session_id":"' || CAST(CAST(ts AS DATE) AS VARCHAR) || '"'
           || ',"driver_id":"DRIVER_' || lpad(CAST(user_id % 20 AS VARCHAR), 2, '0') || '"'
           || ',"race_number":' || CAST(user_id % 20 AS VARCHAR)
           || ',"driver_status":"' || event_type || '"'
           || ',"car_position":' || CAST(k % 21 AS VARCHAR)
           || ',"current_lap_num":' || CAST(hour(ts) + 1 AS VARCHAR)
           || ',"lap_distance":' || CAST(CAST(value * 10 AS DECIMAL(18,1)) AS VARCHAR)
           || ',"speed":' || CAST(3 * k AS VARCHAR)
           || ',"fuel_in_tank":' || CAST(k AS VARCHAR)
           || ',"fuel_remaining_laps":' || CAST(k % 10 AS VARCHAR)
           || ',"g_force_lateral":' || CAST(CAST(value / 100 AS DECIMAL(18,4)) AS VARCHAR)
           || ',"g_force_longitudinal":' || CAST(CAST(-(value / 100) AS DECIMAL(18,4)) AS VARCHAR)
           || '}'
         WHEN event_id % 9 = 0 THEN NULL
         WHEN event_id % 9 = 1 THEN ''
         WHEN event_id % 9 = 2 THEN 'bad'
         WHEN event_id % 9 = 3 THEN '{}'
         WHEN event_id % 9 BETWEEN 4 AND 6 THEN
           '{"session_id":"' || CAST(CAST(ts AS DATE) AS VARCHAR) || '","driver_id":"DRIVER_07","car_position":'
           || CASE event_id % 9 WHEN 4 THEN '"abc"' WHEN 5 THEN '70000' ELSE '2.5' END || '}'
         WHEN event_id % 9 = 7 THEN '{''driver_id'':''DRIVER_07'',''car_position'':3}'
         ELSE '{"session_id":"' || CAST(CAST(ts AS DATE) AS VARCHAR) || '"}'
         END AS body
  FROM tel_src
)
"""

# State after each event; rn = 0 is the initial state of a session.
NEIGHBOURS = f"""
ev AS (
  SELECT t.*, '{TARGET}' AS target_id,
         row_number() OVER (PARTITION BY session_id ORDER BY event_time, partition, seq) AS rn
  FROM telemetry t
),
st AS (
  SELECT DISTINCT session_id, '{TARGET}' AS target_id, CAST(0 AS BIGINT) AS rn,
         CAST(NULL AS INTEGER) AS partition, CAST(NULL AS BIGINT) AS seq, CAST(NULL AS TIMESTAMP) AS event_time,
         CAST(NULL AS VARCHAR) AS e_id, CAST(NULL AS VARCHAR) AS e_status, CAST(NULL AS INTEGER) AS e_pos,
         CAST(NULL AS INTEGER) AS e_lap, CAST(NULL AS INTEGER) AS e_speed, CAST(NULL AS FLOAT) AS e_fuel,
         'NULL' AS me_id, 0 AS me_pos, CAST(NULL AS INTEGER) AS me_lap, CAST(0 AS FLOAT) AS me_lp,
         CAST(NULL AS INTEGER) AS me_speed, false AS me_has,
         CAST(NULL AS INTEGER) AS me_race, CAST(NULL AS FLOAT) AS me_glat, CAST(NULL AS FLOAT) AS me_glon,
         'NOFOLLOWER' AS f_id, 0 AS f_pos, CAST(NULL AS INTEGER) AS f_lap, CAST(NULL AS FLOAT) AS f_lp,
         CAST(NULL AS INTEGER) AS f_speed, false AS f_has,
         'NOLEADER' AS l_id, 0 AS l_pos, CAST(NULL AS INTEGER) AS l_lap, CAST(NULL AS FLOAT) AS l_lp,
         CAST(NULL AS INTEGER) AS l_speed, false AS l_has,
         false AS tracking, false AS emit, CAST(NULL AS VARCHAR) AS prev_f, CAST(NULL AS VARCHAR) AS last_f
  FROM ev
  UNION ALL
  SELECT session_id, target_id, rn, partition, seq, event_time, e_id, e_status, e_pos, e_lap, e_speed, e_fuel,
         me_id, me_pos, me_lap, me_lp, me_speed, me_has, me_race, me_glat, me_glon,
         CASE WHEN ftake THEN e_id ELSE f_id1 END,
         CASE WHEN ftake THEN e_pos ELSE f_pos END,
         CASE WHEN ftake THEN e_lap ELSE f_lap END,
         CASE WHEN ftake THEN e_lp ELSE f_lp END,
         CASE WHEN ftake THEN e_speed ELSE f_speed END,
         f_has OR ftake,
         CASE WHEN ltake THEN e_id ELSE l_id1 END,
         CASE WHEN ltake THEN e_pos ELSE l_pos END,
         CASE WHEN ltake THEN e_lap ELSE l_lap END,
         CASE WHEN ltake THEN e_lp ELSE l_lp END,
         CASE WHEN ltake THEN e_speed ELSE l_speed END,
         l_has OR ltake,
         tracking2,
         tracking2 AND lower(e_id) IN (lower(me_id), lower(CASE WHEN ftake THEN e_id ELSE f_id1 END),
                                       lower(CASE WHEN ltake THEN e_id ELSE l_id1 END)),
         last_f,
         CASE WHEN tracking2 AND lower(e_id) IN (lower(me_id), lower(CASE WHEN ftake THEN e_id ELSE f_id1 END),
                                                 lower(CASE WHEN ltake THEN e_id ELSE l_id1 END))
              THEN CASE WHEN ftake THEN e_id ELSE f_id1 END ELSE last_f END
  FROM (
    SELECT *,
           tracking OR (ftake AND e_pos > 0) OR (ltake AND e_pos > 0) AS tracking2
    FROM (
      SELECT *,
             NOT is_t AND me_pos <> 0 AND e_pos > me_pos
               AND (f_id1 = 'NOFOLLOWER' OR (e_pos > 0 AND e_pos <= f_pos)) AS ftake,
             NOT is_t AND me_pos <> 0 AND e_pos < me_pos
               AND (l_id1 = 'NOLEADER' OR (e_pos > 0 AND e_pos >= l_pos)) AS ltake
      FROM (
        SELECT s.session_id, s.target_id, e.rn, e.partition, e.seq, e.event_time,
               e.driver_id AS e_id, e.driver_status AS e_status, CAST(e.car_position AS INTEGER) AS e_pos,
               CAST(e.current_lap_num AS INTEGER) AS e_lap, e.speed AS e_speed, e.fuel_in_tank AS e_fuel,
               e.lap_distance AS e_lp,
               lower(e.driver_id) = lower(s.target_id) AS is_t,
               CASE WHEN lower(e.driver_id) = lower(s.target_id) THEN e.driver_id ELSE s.me_id END AS me_id,
               CASE WHEN lower(e.driver_id) = lower(s.target_id) THEN CAST(e.car_position AS INTEGER) ELSE s.me_pos END AS me_pos,
               CASE WHEN lower(e.driver_id) = lower(s.target_id) THEN CAST(e.current_lap_num AS INTEGER) ELSE s.me_lap END AS me_lap,
               CASE WHEN lower(e.driver_id) = lower(s.target_id) THEN e.lap_distance ELSE s.me_lp END AS me_lp,
               CASE WHEN lower(e.driver_id) = lower(s.target_id) THEN e.speed ELSE s.me_speed END AS me_speed,
               s.me_has OR lower(e.driver_id) = lower(s.target_id) AS me_has,
               CASE WHEN lower(e.driver_id) = lower(s.target_id) THEN CAST(e.race_number AS INTEGER) ELSE s.me_race END AS me_race,
               CASE WHEN lower(e.driver_id) = lower(s.target_id) THEN e.g_force_lateral ELSE s.me_glat END AS me_glat,
               CASE WHEN lower(e.driver_id) = lower(s.target_id) THEN e.g_force_longitudinal ELSE s.me_glon END AS me_glon,
               s.f_id, s.f_pos, s.f_lap, s.f_lp, s.f_speed, s.f_has,
               s.l_id, s.l_pos, s.l_lap, s.l_lp, s.l_speed, s.l_has,
               s.tracking, s.last_f
        FROM st s JOIN ev e ON e.session_id = s.session_id AND e.rn = s.rn + 1
      ) x0
      CROSS JOIN LATERAL (
        SELECT CASE WHEN x0.f_pos <= x0.me_pos THEN 'NOFOLLOWER' ELSE x0.f_id END AS f_id1,
               CASE WHEN x0.l_pos >= x0.me_pos THEN 'NOLEADER' ELSE x0.l_id END AS l_id1
      ) r
    ) x1
  ) x2
),
neighbours AS (
  SELECT session_id, target_id, partition, seq, event_time,
         e_id AS event_driver_id, e_status AS driver_status, e_pos AS event_car_position,
         e_lap AS event_lap, e_speed AS event_speed, e_fuel AS fuel_in_tank,
         me_id AS me_driver_id, me_pos AS me_car_position, me_lap, me_lp AS me_lap_position,
         me_speed AS me_speed_kph, me_has AS me_has_details,
         me_race AS me_race_number, me_glat AS me_g_force_lateral, me_glon AS me_g_force_longitudinal,
         f_id AS follower_driver_id, f_pos AS follower_car_position, f_lap AS follower_lap,
         f_lp AS follower_lap_position, f_speed AS follower_speed_kph, f_has AS follower_has_details,
         l_id AS leader_driver_id, l_pos AS leader_car_position, l_lap AS leader_lap,
         l_lp AS leader_lap_position, l_speed AS leader_speed_kph, l_has AS leader_has_details,
         tracking,
         lag(f_id) OVER (PARTITION BY session_id, target_id ORDER BY event_time, partition, seq) AS prev_follower_id
  FROM st WHERE emit
)
"""


def _div(num: str, speed: str) -> str:
    # num / (0.278 * speed) in doubles with IEEE results for a zero divisor, as FLOAT
    d = f"(CAST(0.278 AS DOUBLE) * CAST({speed} AS DOUBLE))"
    n = f"CAST({num} AS DOUBLE)"
    return (f"CAST(CASE WHEN {d} = 0 THEN CASE WHEN {n} > 0 THEN CAST('inf' AS DOUBLE) "
            f"WHEN {n} < 0 THEN CAST('-inf' AS DOUBLE) ELSE CAST('nan' AS DOUBLE) END "
            f"ELSE {n} / {d} END AS FLOAT)")


GAPS = f"""
gaps AS (
  SELECT *,
    CASE WHEN ok1 THEN me_lap_position - follower_lap_position END AS meters_from_follower,
    CASE WHEN ok2 THEN {_div('me_lap_position - follower_lap_position', 'follower_speed_kph')} END AS secs_from_follower,
    CASE WHEN ok3 THEN leader_lap_position - me_lap_position END AS meters_to_leader,
    CASE WHEN ok4 THEN {_div('leader_lap_position - me_lap_position', 'leader_speed_kph')} END AS secs_to_leader
  FROM (
    SELECT *,
      me_lap_position IS NOT NULL AND follower_lap_position IS NOT NULL AS ok1,
      me_lap_position IS NOT NULL AND follower_lap_position IS NOT NULL AND follower_speed_kph IS NOT NULL AS ok2,
      me_lap_position IS NOT NULL AND follower_lap_position IS NOT NULL AND follower_speed_kph IS NOT NULL
        AND leader_lap_position IS NOT NULL AS ok3,
      me_lap_position IS NOT NULL AND follower_lap_position IS NOT NULL AND follower_speed_kph IS NOT NULL
        AND leader_lap_position IS NOT NULL AND leader_speed_kph IS NOT NULL AS ok4
    FROM neighbours
  )
)
"""

NEIGHBOUR_COLS = """session_id, target_id, partition, seq, event_time, event_driver_id, driver_status,
  event_car_position, event_lap, event_speed, fuel_in_tank, me_driver_id, me_car_position, me_lap,
  me_lap_position, me_speed_kph, me_has_details, me_race_number, me_g_force_lateral,
  me_g_force_longitudinal, follower_driver_id, follower_car_position, follower_lap,
  follower_lap_position, follower_speed_kph, follower_has_details, leader_driver_id,
  leader_car_position, leader_lap, leader_lap_position, leader_speed_kph, leader_has_details,
  tracking, prev_follower_id"""


def _jtext(x: str) -> str:
    """Java's text of a 32-bit float: the shortest decimal that reads back as
    the same float; plain for 1e-3 <= |x| < 1e7 (at least one decimal),
    otherwise d.dddE<n>; null, Infinity and NaN spelled as Java does."""
    plain = " ".join(
        f"WHEN CAST(printf('%.{d}f', {x}) AS FLOAT) = {x} THEN printf('%.{d}f', {x})" for d in range(1, 13))
    sci_parts = []
    for d in range(1, 10):
        s = f"printf('%.{d}e', {x})"
        sci_parts.append(
            f"WHEN CAST({s} AS FLOAT) = {x} THEN split_part({s}, 'e', 1) || 'E' "
            f"|| CAST(CAST(split_part({s}, 'e', 2) AS INTEGER) AS VARCHAR)")
    sci = " ".join(sci_parts)
    return (f"(CASE WHEN {x} IS NULL THEN 'null' "
            f"WHEN isinf({x}) AND {x} > 0 THEN 'Infinity' WHEN isinf({x}) THEN '-Infinity' "
            f"WHEN isnan({x}) THEN 'NaN' "
            f"WHEN {x} = 0 THEN CASE WHEN CAST({x} AS VARCHAR) LIKE '-%' THEN '-0.0' ELSE '0.0' END "
            f"WHEN abs({x}) >= 0.001 AND abs({x}) < 10000000 THEN CASE {plain} END "
            f"ELSE CASE {sci} END END)")


def _with(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",".join(c.strip() for c in ctes) + "\n"


ORACLES: dict[str, str] = {
    "click_parse": _with(CLICKS) + "SELECT seq, ts, raw, account_id FROM clicks",
    "click_authenticated": _with(CLICKS) + "SELECT seq, ts, raw, account_id FROM authed",
    "click_skipped": _with(CLICKS) + """
SELECT count(*) FILTER (WHERE account_id IS NULL) AS n_unparsable,
       count(*) FILTER (WHERE account_id = -1) AS n_anonymous,
       count(*) FILTER (WHERE account_id IS NOT NULL AND account_id <> -1) AS n_kept
FROM clicks""",
    "click_counts_sliding": _with(CLICKS, SLIDING) + "SELECT account_id, window_start, window_end, n FROM sliding",
    "click_counts_tumbling": _with(CLICKS, TUMBLING) + "SELECT account_id, window_start, window_end, n FROM tumbling",
    "click_first_event": _with(CLICKS) + """
SELECT account_id, window_start, window_start + INTERVAL 7 DAY AS window_end, count(*) AS n,
       first(raw ORDER BY ts, seq) AS first_raw
FROM (
  SELECT account_id, raw, ts, seq,
         CAST(date_trunc('day', ts) AS TIMESTAMP) - to_days(CAST(i AS INTEGER)) AS window_start
  FROM authed, range(7) AS t(i)
) GROUP BY account_id, window_start""",
    "ten_or_more": _with(CLICKS, SLIDING)
    + "SELECT window_start, window_end, CAST(account_id AS VARCHAR) AS line FROM sliding WHERE n >= 10",
    "nine_or_less": _with(CLICKS, SLIDING)
    + "SELECT window_start, window_end, CAST(account_id AS VARCHAR) AS line FROM sliding WHERE n < 9",
    "console_counts": _with(CLICKS, SLIDING)
    + "SELECT account_id, window_start, window_end, n FROM sliding WHERE n >= 5",
    "click_routes": _with(CLICKS, SLIDING) + """
SELECT 'ten_or_more' AS sink, window_start, window_end, CAST(account_id AS VARCHAR) AS line FROM sliding WHERE n >= 10
UNION ALL
SELECT 'nine_or_less' AS sink, window_start, window_end, CAST(account_id AS VARCHAR) AS line FROM sliding WHERE n < 9""",
    "click_counts_stream": _with(CLICKS, SLIDING) + """
SELECT account_id, window_start, window_end, n FROM sliding""",
    "click_routes_stream": _with(CLICKS, SLIDING) + """
SELECT 'ten_or_more' AS sink, CAST(account_id AS VARCHAR) AS line FROM sliding WHERE n >= 10
UNION ALL
SELECT 'nine_or_less' AS sink, CAST(account_id AS VARCHAR) AS line FROM sliding WHERE n < 9""",
    "telemetry_decode": _with(TELEMETRY) + """
SELECT session_id, event_time, partition, seq, driver_id, race_number, driver_status, car_position,
       current_lap_num, lap_distance, speed, fuel_in_tank, fuel_remaining_laps,
       g_force_lateral, g_force_longitudinal
FROM telemetry""",
    "telemetry_quality": _with(TELEMETRY.split("telemetry AS")[0].rstrip().rstrip(",")) + """
SELECT count(*) AS n_messages, count(*) FILTER (WHERE k <> 0) AS n_decoded,
       count(*) FILTER (WHERE k = 0) AS n_dropped
FROM tel_src""",
    "telemetry_status": _with(TELEMETRY) + """
SELECT session_id, seq, race_number, driver_id,
       '  driverstatus:' || driver_status || ' car-position:' || CAST(car_position AS VARCHAR)
       || ' curr-lap:' || CAST(current_lap_num AS VARCHAR) || ' speed:' || CAST(speed AS VARCHAR)
       || ' fuel remaining in laps:' || CAST(current_lap_num AS VARCHAR) || CAST(fuel_remaining_laps AS VARCHAR)
       || ' fuel in tank:' || CAST(speed AS VARCHAR) || CAST(fuel_in_tank AS VARCHAR)
       || ' driver:' || driver_id AS line
FROM telemetry""",
    "raw_dump": _with(TELEMETRY.split("telemetry AS")[0].rstrip().rstrip(","), MESSAGES)
    + """SELECT "offset", CASE WHEN body IS NULL THEN NULL ELSE upper(hex(encode(body))) END AS hex FROM messages""",
    "neighbours": _with(TELEMETRY, NEIGHBOURS) + f"SELECT {NEIGHBOUR_COLS} FROM neighbours",
    "gaps": _with(TELEMETRY, NEIGHBOURS, GAPS) + f"""
SELECT {NEIGHBOUR_COLS}, meters_from_follower, secs_from_follower, meters_to_leader, secs_to_leader
FROM gaps""",
    "gap_report": _with(TELEMETRY, NEIGHBOURS, GAPS) + f"""
SELECT session_id, target_id, seq,
  'behind : ' || leader_driver_id || ' by ' || {_jtext('meters_to_leader')} || 'm or by '
  || {_jtext('secs_to_leader')} || 's\n'
  || 'ahead of : ' || follower_driver_id || ' by ' || {_jtext('meters_from_follower')} || 'm or by '
  || {_jtext('secs_from_follower')} || 's\n'
  || '    (Current driver status:' || driver_status || ' car-position:' || CAST(event_car_position AS VARCHAR)
  || ' curr-lap:' || CAST(event_lap AS VARCHAR) || ' speed:' || CAST(event_speed AS VARCHAR)
  || ' fuel remaining in laps:' || CAST(event_lap AS VARCHAR) || '\n'
  || ' fuel in tank:' || CAST(event_speed AS VARCHAR) || {_jtext('fuel_in_tank')}
  || ' driver:' || event_driver_id || ' ) ' AS report
FROM gaps""",
    "gap_csv": _with(TELEMETRY, NEIGHBOURS, GAPS) + """
SELECT session_id, target_id, seq, me_race_number AS race, me_driver_id AS my_driver,
       follower_driver_id AS follower_driver, leader_driver_id AS leader_driver,
       me_speed_kph AS speed_in_kph, me_g_force_lateral AS g_force_lateral,
       me_g_force_longitudinal AS g_force_longitudinal, meters_to_leader AS distance_behind_meters,
       meters_from_follower AS distance_ahead_meters, me_car_position AS position, me_lap AS lap
FROM gaps WHERE me_has_details AND follower_has_details AND leader_has_details""",
    "follower_changes": _with(TELEMETRY, NEIGHBOURS) + """
SELECT session_id, target_id, seq, event_time, prev_follower_id AS previous_follower_id,
       follower_driver_id AS follower_id,
       'Pattern Detected:' || prev_follower_id || 'was passed by ' || follower_driver_id AS message
FROM neighbours WHERE prev_follower_id IS NOT NULL AND prev_follower_id <> follower_driver_id""",
    "adjacent_pairs": _with(TELEMETRY, NEIGHBOURS) + """
SELECT session_id, target_id, seq, event_time, prev_follower_id AS previous_follower_id,
       follower_driver_id AS follower_id,
       'Pattern Detected:' || prev_follower_id || 'was passed by ' || follower_driver_id AS message
FROM neighbours WHERE prev_follower_id IS NOT NULL""",
}
ORACLES["neighbours_stream"] = ORACLES["neighbours"]
ORACLES["neighbours_split"] = ORACLES["neighbours"]
ORACLES["follower_changes_stream"] = ORACLES["follower_changes"]
# the report of the same rows with every gap null
_NULL_GAPS = """
gaps AS (
  SELECT *, CAST(NULL AS FLOAT) AS meters_from_follower, CAST(NULL AS FLOAT) AS secs_from_follower,
         CAST(NULL AS FLOAT) AS meters_to_leader, CAST(NULL AS FLOAT) AS secs_to_leader
  FROM neighbours
)
"""
ORACLES["find_follower"] = ORACLES["gap_report"].replace(GAPS.strip(), _NULL_GAPS.strip())
ORACLES["find_follower_stream"] = ORACLES["find_follower"]


def _renamed(sql: str, n: int) -> str:
    return re.sub(r"\b(ev|st|neighbours)\b", rf"\g<1>{n}", sql)


# two targets in ids of another case, the second one on days with an even number
_SECOND = _renamed(NEIGHBOURS, 2).replace(f"'{TARGET}'", "'driver_11'").replace(
    "FROM telemetry t", "FROM telemetry t WHERE CAST(substr(session_id, 9, 2) AS INTEGER) % 2 = 0")
ORACLES["neighbours_targets_table"] = (
    _with(TELEMETRY, NEIGHBOURS.replace(f"'{TARGET}'", "'Driver_07'"), _SECOND)
    + f"SELECT {NEIGHBOUR_COLS} FROM neighbours UNION ALL SELECT {NEIGHBOUR_COLS} FROM neighbours2")
# the whole table as one race: the same state machine over one key
_ONE_RACE = """
telemetry1 AS (SELECT * REPLACE ('all' AS session_id) FROM telemetry)
"""
ORACLES["neighbours_global_key"] = (
    _with(TELEMETRY, _ONE_RACE, NEIGHBOURS.replace("FROM telemetry t", "FROM telemetry1 t"))
    + f"SELECT {NEIGHBOUR_COLS} FROM neighbours")


# patterns over rows next to each other, restated as joins on the row number of a key
_MATCHED = ["partition", "seq", "event_time", "event_driver_id", "me_lap", "follower_driver_id", "follower_car_position",
            "leader_driver_id", "tracking"]
_NUMBERED = """
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY session_id, target_id ORDER BY event_time, partition, seq) AS rn FROM neighbours
)
"""


def _matched(alias: str, step: str) -> str:
    return ", ".join(f"{alias}.{c} AS {step}_{c}" for c in _MATCHED)


_PAIRS = f"""
SELECT a.session_id, a.target_id, {_matched('a', 'first')}, {_matched('b', 'next')}
FROM numbered a JOIN numbered b ON b.session_id = a.session_id AND b.rn = a.rn + 1
WHERE b.follower_driver_id <> a.follower_driver_id"""
ORACLES["pattern_pairs"] = ORACLES["pattern_pairs_stream"] = _with(TELEMETRY, NEIGHBOURS, _NUMBERED) + _PAIRS
ORACLES["pattern_pairs_global_key"] = (
    _with(TELEMETRY, _ONE_RACE, NEIGHBOURS.replace("FROM telemetry t", "FROM telemetry1 t"), _NUMBERED) + _PAIRS)
ORACLES["pattern_three_steps"] = ORACLES["pattern_three_steps_stream"] = _with(TELEMETRY, NEIGHBOURS, _NUMBERED) + f"""
SELECT a.session_id, a.target_id, {_matched('a', 'first')}, {_matched('b', 'next')}, {_matched('c', 'back')}
FROM numbered a JOIN numbered b ON b.session_id = a.session_id AND b.rn = a.rn + 1
JOIN numbered c ON c.session_id = a.session_id AND c.rn = a.rn + 2
WHERE b.follower_driver_id <> a.follower_driver_id AND c.follower_driver_id = a.follower_driver_id
  AND b.follower_car_position <> c.follower_car_position"""

ORACLES["neighbours_global_key_stream"] = ORACLES["neighbours_global_key"]
ORACLES["neighbours_reordered_stream"] = ORACLES["neighbours"]
ORACLES["click_first_event_stream"] = ORACLES["click_first_event"]
# the canonical text by construction: keys in order, nothing between them
ORACLES["click_canonical"] = """
SELECT event_id AS seq, ts,
       CASE WHEN event_id % 50 = 1 THEN '{"user.accountId":"77"}'
            WHEN event_id % 50 = 2 THEN '{"user.accountId":3000000000}'
            WHEN event_id % 50 >= 5 THEN
              '{' || CASE WHEN event_id % 5 = 3 THEN '"more":{"a":null,"b":[1,2,{}]},' ELSE '' END
              || '"page":"' || event_type || '","user.accountId":'
              || CAST(CASE WHEN event_type = 'error' THEN -1 ELSE user_id END AS VARCHAR) || '}' END AS raw,
       CASE WHEN event_id % 50 >= 5
            THEN CAST(CASE WHEN event_type = 'error' THEN -1 ELSE user_id END AS INTEGER) END AS account_id
FROM events"""
ORACLES["telemetry_decode_stream"] = ORACLES["telemetry_decode"]
# four batches in time order, every fifth event one batch late; the watermark of a batch is that of the ones before it
ORACLES["click_late_rows"] = _with(CLICKS) + """
, span AS (
  SELECT CAST(epoch(min(ts)) AS BIGINT) AS a, 3600 * ((CAST(epoch(max(ts)) AS BIGINT) - CAST(epoch(min(ts)) AS BIGINT)) // 14400 + 1) AS len
  FROM events),
placed AS (
  SELECT clicks.*, least(3, CAST(floor((epoch(date_trunc('hour', ts)) - a + 3599) / len) AS BIGINT)
                            + CASE WHEN seq % 5 = 0 THEN 1 ELSE 0 END) AS b
  FROM clicks, span),
mark AS (SELECT k, (SELECT max(ts) FROM placed WHERE b < k) - INTERVAL 60 SECOND AS old FROM range(4) t(k)),
copied AS (
  SELECT account_id, raw, ts, seq, b, CAST(date_trunc('day', ts) AS TIMESTAMP) - to_days(CAST(i AS INTEGER)) AS window_start
  FROM placed, range(7) AS t(i) WHERE account_id IS NOT NULL AND account_id <> -1),
tested AS (
  SELECT copied.*, window_start + INTERVAL 7 DAY AS window_end, coalesce(window_start + INTERVAL 7 DAY <= old, false) AS late
  FROM copied JOIN mark ON mark.k = copied.b)
SELECT 'late' AS kind, account_id, window_start, window_end, CAST(NULL AS BIGINT) AS n, raw AS text, seq FROM tested WHERE late
UNION ALL
SELECT 'window', account_id, window_start, window_end, count(*), first(raw ORDER BY ts, seq), NULL
FROM tested WHERE NOT late GROUP BY account_id, window_start, window_end"""
