"""Telemetry: decode, status text, neighbour tracking, gaps, reports, patterns."""

import datetime as dt
import math
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from racestream.operators.gaps import gap_csv, gap_report, with_gaps
from racestream.operators.neighbours import track_neighbours, track_neighbours_stream
from racestream.operators.patterns import adjacent_pairs, every_pair, follower_changes
from racestream.operators.telemetry import decode_telemetry, dump_bytes, status_lines, telemetry_quality
from racestream.sinks.writers import write_csv

T0 = dt.datetime(2024, 3, 1, 14, 0, 0)
TARGET = "ANTONIO_GIOVINAZZI"

TEL_SCHEMA = T.StructType([
    T.StructField("session_id", T.StringType()),
    T.StructField("event_time", T.TimestampNTZType()),
    T.StructField("seq", T.LongType()),
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

# FIXTURES.md section 4: (seq, driver, position, lap distance, speed)
GOLDEN = [
    (1, "LEWIS", 1, 1200.0, 280), (2, TARGET, 5, 1000.0, 250), (3, "KIMI", 6, 950.5, 240),
    (4, "LANDO", 4, 1080.0, 260), (5, "PIERRE", 8, 700.0, 230), (6, "ALEX", 3, 1100.0, 270),
    (7, TARGET, 5, 1050.0, 0), (8, "KIMI", 7, 960.0, 200), (9, "PIERRE", 6, 1000.0, 0),
    (10, TARGET, 7, 1100.0, 255), (11, "PIERRE", 6, 1160.0, 250), (12, "ESTEBAN", 8, 1000.0, 245),
    (13, "NICO", 0, 0.0, 0), (14, TARGET, 1, 1300.0, 260), (15, "KIMI", 2, 1290.0, 255),
]
# seq -> me pos, follower (id, pos), leader (id, pos), mF, sF, mL, sL
GOLDEN_OUT = {
    3: (5, ("KIMI", 6), ("NOLEADER", 0), 49.5, 0.7419, None, None),
    4: (5, ("KIMI", 6), ("LANDO", 4), 49.5, 0.7419, 80.0, 1.1068),
    7: (5, ("KIMI", 6), ("LANDO", 4), 99.5, 1.4913, 30.0, 0.4151),
    8: (5, ("KIMI", 6), ("LANDO", 4), 99.5, 1.4913, 30.0, 0.4151),
    9: (5, ("PIERRE", 6), ("LANDO", 4), 50.0, math.inf, 30.0, 0.4151),
    10: (7, ("NOFOLLOWER", 6), ("LANDO", 4), 100.0, math.inf, -20.0, -0.2767),
    11: (7, ("NOFOLLOWER", 6), ("PIERRE", 6), 100.0, math.inf, 60.0, 0.8633),
    12: (7, ("ESTEBAN", 8), ("PIERRE", 6), 100.0, 1.4682, 60.0, 0.8633),
    14: (1, ("ESTEBAN", 8), ("NOLEADER", 6), 300.0, 4.4046, -140.0, -2.0144),
    15: (1, ("KIMI", 2), ("NOLEADER", 6), 10.0, 0.1411, -140.0, -2.0144),
}


def tel_rows(events, session="race-1", lap=1, t0=T0):
    """events: (seq, driver, pos, distance, speed) -> telemetry rows."""
    rows = []
    for seq, drv, pos, dist, speed in events:
        rows.append((session, t0 + dt.timedelta(seconds=seq), seq, drv, 7, "ON_TRACK", pos, lap,
                     float(dist), speed, 50.0, 3.0, 0.5, -0.25))
    return rows


def tel(spark, rows, partitions=None):
    df = spark.createDataFrame(rows, TEL_SCHEMA)
    return df.repartition(partitions) if partitions else df


def by_seq(df):
    return {r.seq: r for r in df.collect()}


def _close(a, b):
    if a is None or b is None:
        return a is None and b is None
    if math.isinf(b):
        return a == b
    return abs(a - b) < 5e-4


def test_golden_trace(spark):
    out = by_seq(with_gaps(track_neighbours(tel(spark, tel_rows(GOLDEN)), TARGET)))
    assert sorted(out) == sorted(GOLDEN_OUT)
    for seq, (me_pos, fol, lea, mf, sf, ml, sl) in GOLDEN_OUT.items():
        r = out[seq]
        assert r.me_car_position == me_pos, seq
        assert (r.follower_driver_id, r.follower_car_position) == fol, seq
        assert (r.leader_driver_id, r.leader_car_position) == lea, seq
        assert _close(r.meters_from_follower, mf) and _close(r.secs_from_follower, sf), seq
        assert _close(r.meters_to_leader, ml) and _close(r.secs_to_leader, sl), seq
        assert r.tracking is True


def test_golden_patterns_and_csv(spark):
    n = track_neighbours(tel(spark, tel_rows(GOLDEN)), TARGET)
    changes = follower_changes(n).collect()
    assert sorted(r.seq for r in changes) == [9, 10, 12, 15]
    msg = {r.seq: r.message for r in changes}
    assert msg[9] == "Pattern Detected:KIMIwas passed by PIERRE"
    assert sorted(r.seq for r in adjacent_pairs(n, every_pair()).collect()) == [4, 7, 8, 9, 10, 11, 12, 14, 15]
    csv = gap_csv(with_gaps(n)).collect()
    assert sorted(r.seq for r in csv) == [4, 7, 8, 9, 10, 11, 12, 14, 15]


def test_gap_report_text(spark):
    rep = by_seq(gap_report(with_gaps(track_neighbours(tel(spark, tel_rows(GOLDEN)), TARGET))))
    assert rep[3].report == (
        "behind : NOLEADER by nullm or by nulls\n"
        "ahead of : KIMI by 49.5m or by 0.74190646s\n"
        "    (Current driver status:ON_TRACK car-position:6 curr-lap:1 speed:240 fuel remaining in laps:1\n"
        " fuel in tank:24050.0 driver:KIMI ) ")
    assert "by Infinitys" in rep[9].report


def test_target_case_insensitive(spark):
    lower = [(s, d.lower() if d == TARGET else d, p, x, v) for s, d, p, x, v in GOLDEN]
    out = by_seq(track_neighbours(tel(spark, tel_rows(lower)), TARGET))
    assert sorted(out) == sorted(GOLDEN_OUT)
    assert out[3].me_driver_id == TARGET.lower()


def test_position_zero_first_leader_does_not_track(spark):
    ev = [(1, TARGET, 3, 100.0, 200), (2, "ZERO", 0, 50.0, 100), (3, TARGET, 3, 110.0, 200)]
    assert track_neighbours(tel(spark, tel_rows(ev)), TARGET).count() == 0
    ev += [(4, "BEHIND", 5, 90.0, 150), (5, TARGET, 3, 120.0, 200)]
    out = by_seq(track_neighbours(tel(spark, tel_rows(ev)), TARGET))
    assert sorted(out) == [4, 5]
    assert (out[5].leader_driver_id, out[5].leader_car_position) == ("ZERO", 0)


def test_leader_without_follower_gives_null_gaps(spark):
    ev = [(1, TARGET, 5, 100.0, 200), (2, "AHEAD", 4, 150.0, 210)]
    out = by_seq(with_gaps(track_neighbours(tel(spark, tel_rows(ev)), TARGET)))
    r = out[2]
    assert r.follower_driver_id == "NOFOLLOWER" and r.leader_driver_id == "AHEAD"
    assert (r.meters_from_follower, r.secs_from_follower, r.meters_to_leader, r.secs_to_leader) == (None,) * 4


def test_zero_distance_zero_speed_is_nan(spark):
    ev = [(1, TARGET, 5, 100.0, 200), (2, "BEHIND", 6, 100.0, 0)]
    r = by_seq(with_gaps(track_neighbours(tel(spark, tel_rows(ev)), TARGET)))[2]
    assert r.meters_from_follower == 0.0 and math.isnan(r.secs_from_follower)


def test_two_sessions_and_two_targets(spark):
    rows = tel_rows(GOLDEN, "a") + tel_rows(GOLDEN, "b", t0=T0 + dt.timedelta(milliseconds=500))
    rows += tel_rows([(100 + s, "X" if d == "KIMI" else d, p, x, v) for s, d, p, x, v in GOLDEN], "a",
                     t0=T0 + dt.timedelta(milliseconds=250) - dt.timedelta(seconds=100))
    df = tel(spark, rows, partitions=3)
    out = track_neighbours(df, [TARGET, "LANDO"]).collect()
    a_target = [r.seq for r in out if r.session_id == "b" and r.target_id == TARGET]
    assert sorted(a_target) == sorted(GOLDEN_OUT)
    assert {r.target_id for r in out} == {TARGET, "LANDO"}


def test_targets_table_join(spark):
    rows = tel_rows(GOLDEN, "a") + tel_rows(GOLDEN, "b")
    targets = spark.createDataFrame([("a", TARGET)], "session_id string, target_id string")
    out = track_neighbours(tel(spark, rows), targets).collect()
    assert {r.session_id for r in out} == {"a"} and len(out) == len(GOLDEN_OUT)


# -- an independent restatement ---------------------

def restated(events, target):
    me = ("NULL", 0, None, 0.0, None)
    fol = ("NOFOLLOWER", 0, None, None, None)
    lea = ("NOLEADER", 0, None, None, None)
    tracking = False
    out = []
    for seq, drv, p, dist, speed in events:
        info = (drv, p, 1, dist, speed)
        t = drv.lower() == target.lower()
        if t:
            me = info
        m = me[1]
        if fol[1] <= m:
            fol = ("NOFOLLOWER",) + fol[1:]
        if lea[1] >= m:
            lea = ("NOLEADER",) + lea[1:]
        ftake = not t and m != 0 and p > m and (fol[0] == "NOFOLLOWER" or (p > 0 and p <= fol[1]))
        ltake = not t and m != 0 and p < m and (lea[0] == "NOLEADER" or (p > 0 and p >= lea[1]))
        if ftake:
            fol = info
        if ltake:
            lea = info
        tracking = tracking or ((ftake or ltake) and p > 0)
        if tracking and drv.lower() in (me[0].lower(), fol[0].lower(), lea[0].lower()):
            out.append((seq, me[0], me[1], fol[0], fol[1], lea[0], lea[1]))
    return out


def random_events(rng, n, drivers=8, max_pos=6):
    names = [TARGET] + [f"D{i}" for i in range(drivers - 1)]
    return [(i + 1, rng.choice(names), rng.randint(0, max_pos), float(rng.randint(0, 5000)) / 2,
             rng.randint(0, 300)) for i in range(n)]


@pytest.mark.parametrize("partitions,batch", [(1, 10000), (8, 7), (3, 1)])
def test_random_against_restatement(spark, partitions, batch):
    rng = random.Random(partitions * 1000 + batch)
    sessions = {f"s{k}": random_events(rng, rng.randint(5, 120)) for k in range(12)}
    rows = []
    for s, ev in sessions.items():
        rows += tel_rows(ev, s)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = track_neighbours(tel(spark, rows, partitions=5), TARGET, num_partitions=partitions).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    got_by = {}
    for r in got:
        got_by.setdefault(r.session_id, []).append(
            (r.seq, r.me_driver_id, r.me_car_position, r.follower_driver_id, r.follower_car_position,
             r.leader_driver_id, r.leader_car_position))
    for s, ev in sessions.items():
        assert sorted(got_by.get(s, [])) == restated(ev, TARGET), s


# -- stream equals batch -------------------------------------------------------------

def test_stream_equals_batch(spark, tmpdir_path):
    rng = random.Random(7)
    sessions = {f"s{k}": random_events(rng, 60) for k in range(4)}
    rows = []
    for s, ev in sessions.items():
        rows += tel_rows(ev, s)
    df = tel(spark, rows)
    src, out, ckpt = (f"{tmpdir_path}/{x}" for x in ("src", "out", "ckpt"))
    # three arrivals, in event-time order, each picked up by its own run
    for lo, hi in ((0, 20), (20, 45), (45, 1000)):
        df.filter((F.col("seq") > lo) & (F.col("seq") <= hi)).write.mode("append").parquet(src)
        stream = spark.readStream.schema(TEL_SCHEMA).parquet(src)
        q = (track_neighbours_stream(stream, TARGET).writeStream.format("parquet")
             .option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination()
    cols = ["session_id", "seq", "me_driver_id", "follower_driver_id", "leader_driver_id",
            "follower_car_position", "leader_car_position", "prev_follower_id", "tracking"]
    got = sorted(tuple(r) for r in spark.read.parquet(out).select(*cols).collect())
    want = sorted(tuple(r) for r in track_neighbours(df, TARGET).select(*cols).collect())
    assert got == want and len(got) > 0


# -- decode, text, sinks -------------------------------------------------------------

def kafka(spark, bodies):
    rows = [(None, None if b is None else b.encode(), "t", 0, i, T0, 0) for i, b in enumerate(bodies)]
    return spark.createDataFrame(
        rows, "key binary, value binary, topic string, partition int, offset long, timestamp timestamp_ntz, "
              "timestampType int")


GOOD = ('{"session_id":"r","driver_id":"KIMI","race_number":7,"driver_status":"ON","car_position":3,'
        '"current_lap_num":2,"lap_distance":10.5,"speed":200,"fuel_in_tank":5.5,"fuel_remaining_laps":1.5,'
        '"g_force_lateral":0.1,"g_force_longitudinal":-0.2}')


def test_decode_drops_bad_messages(spark):
    half_bad = [GOOD.replace('"car_position":3', f'"car_position":{v}') for v in ('"abc"', "70000", "2.5", "null")]
    half_bad += [GOOD.replace('"speed":200', '"speed":"x"'), GOOD.replace("10.5", "NaN"), GOOD.replace('"', "'")]
    msgs = kafka(spark, [GOOD, None, "", "bad", "{}", '{"session_id":"r"}', GOOD])
    more = kafka(spark, [GOOD, *half_bad])
    assert [r.seq for r in decode_telemetry(more).collect()] == [0]
    assert tuple(telemetry_quality(more).first()) == (8, 1, 7)
    out = decode_telemetry(msgs).collect()
    assert [r.seq for r in out] == [0, 6]
    r = out[0]
    assert (r.driver_id, r.car_position, r.lap_distance, r.speed, r.event_time) == ("KIMI", 3, 10.5, 200, T0)
    q = telemetry_quality(msgs).collect()[0]
    assert (q.n_messages, q.n_decoded, q.n_dropped) == (7, 2, 5)


def test_status_line(spark):
    line = status_lines(decode_telemetry(kafka(spark, [GOOD]))).collect()[0].line
    assert line == ("  driverstatus:ON car-position:3 curr-lap:2 speed:200 fuel remaining in laps:21.5"
                    " fuel in tank:2005.5 driver:KIMI")


def test_dump_bytes(spark):
    out = dump_bytes(kafka(spark, ["AB", None])).collect()
    assert [r.hex for r in out] == ["4142", None]


def test_csv_sink(spark, tmpdir_path):
    rows = gap_csv(with_gaps(track_neighbours(tel(spark, tel_rows(GOLDEN)), TARGET)))
    path = f"{tmpdir_path}/gaps.csv"
    write_csv(rows.coalesce(1), path)
    files = [f for f in os.listdir(path) if f.endswith(".csv")]
    text = open(os.path.join(path, files[0])).read().splitlines()
    assert text[0].startswith("Race,MyDriver,FollowerDriver,LeaderDriver,SpeedInKPH")
    assert len(text) == 1 + 9
    with pytest.raises(Exception):
        write_csv(rows, path)  # the default mode fails when the file exists


def test_stream_idle_timeout_drops_finished_races(spark, tmpdir_path):
    rows = tel_rows(GOLDEN, "early", t0=T0) + tel_rows(GOLDEN, "late", t0=T0 + dt.timedelta(hours=5))
    df = tel(spark, rows)
    src, out, ckpt = (f"{tmpdir_path}/{x}" for x in ("src", "out", "ckpt"))
    progress = []
    for session in ("early", "late"):
        df.filter(F.col("session_id") == session).write.mode("append").parquet(src)
        stream = spark.readStream.schema(TEL_SCHEMA).parquet(src)
        q = (track_neighbours_stream(stream, TARGET, idle_timeout="1 hour").writeStream.format("parquet")
             .option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination()
        progress += [p for p in q.recentProgress if p.get("stateOperators")]
    got = spark.read.parquet(out)
    assert got.count() == 2 * len(GOLDEN_OUT)  # the same rows as without a timeout
    # once the late race moved the watermark on, the early race's state is gone
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] == 1


def test_repeated_target_id_counts_once(spark):
    df = tel(spark, tel_rows(GOLDEN))
    assert sorted(by_seq(track_neighbours(df, [TARGET, TARGET]))) == sorted(GOLDEN_OUT)


def test_csv_line_text(spark):
    from racestream.operators.gaps import csv_lines
    rows = gap_csv(with_gaps(track_neighbours(tel(spark, tel_rows(GOLDEN)), TARGET)))
    line = {r.seq: r.line for r in csv_lines(rows).collect()}[4]
    # race, me, follower, leader, speed, lateral g, longitudinal g, m to leader, m from follower, position, lap
    assert line == "7,ANTONIO_GIOVINAZZI,KIMI,LANDO,250,0.5,-0.25,80.0,49.5,5,1"
