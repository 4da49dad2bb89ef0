"""Streams in event order with a versioned state: same rows as batch, also replayed, late and held rows apart."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from racestream.operators.neighbours import track_neighbours
from racestream.streaming.ordered import OrderedNeighbours, start_ordered_neighbours
from tests.test_telemetry import T0, TARGET, random_events

MESSAGES = ("key binary, value binary, topic string, partition int, offset long, timestamp timestamp_ntz, timestampType int")
DECODED_COLUMNS = ["session_id", "target_id", "seq", "event_time", "me_driver_id", "follower_driver_id", "leader_driver_id",
                   "follower_car_position", "leader_car_position", "prev_follower_id", "tracking"]


def message(session, seq, driver, pos, dist, speed):
    body = {"session_id": session, "driver_id": driver, "car_position": pos, "lap_distance": dist, "speed": speed}
    return (None, json.dumps(body).encode(), "t", seq % 3, seq, T0 + dt.timedelta(seconds=seq), 0)


def hot_and_small(seed):
    rng = random.Random(seed)
    out = [message("hot", *e) for e in random_events(rng, 300, drivers=7, max_pos=6)]
    return out + [message(None, *e) for e in random_events(rng, 90, drivers=5, max_pos=5)]


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*DECODED_COLUMNS).collect()), key=repr)


def batch_rows(spark, messages):
    from racestream.operators.telemetry import decode_telemetry

    return rows_of(track_neighbours(decode_telemetry(spark.createDataFrame(messages, MESSAGES)), [TARGET]))


def test_displaced_events_late_ones_and_replays(spark, tmpdir_path):
    messages = hot_and_small(3)
    rng = random.Random(3)
    # four batches of 80 seconds; some events come one batch late, which the delay covers, and two far too late
    batches = [[] for _ in range(5)]
    late = []
    for m in messages:
        k = min((m[4] - 1) // 80, 3)
        if m[4] in (5, 17):
            late.append(m)
            batches[4].append(m)
        else:
            batches[min(3, k + (rng.random() < 0.25))].append(m)
    on_time = [m for m in messages if m not in late]
    job = OrderedNeighbours(spark, [TARGET], f"{tmpdir_path}/out", f"{tmpdir_path}/state", delay="161 seconds", num_slices=5)
    for k, some in enumerate(batches):
        df = spark.createDataFrame(some, MESSAGES)
        job(df, k)
        if k == 2:  # replayed: as if it had stopped before its end was noted
            before = rows_of(spark.read.parquet(f"{tmpdir_path}/out/rows/batch_id=2"))
            job(df, k)
            assert rows_of(spark.read.parquet(f"{tmpdir_path}/out/rows/batch_id=2")) == before
    job.finish(4)
    job.finish(4)
    assert rows_of(job.rows()) == batch_rows(spark, on_time)
    assert sorted((r.session_id or "", r.seq) for r in job.late().collect()) == sorted(
        ("" if b"null" in m[1].split(b",")[0] else "hot", m[4]) for m in late)


def test_a_lost_version_is_an_error(spark, tmpdir_path):
    job = OrderedNeighbours(spark, [TARGET], f"{tmpdir_path}/out", f"{tmpdir_path}/state", num_slices=2)
    with pytest.raises(RuntimeError):
        job(spark.createDataFrame(hot_and_small(1)[:5], MESSAGES), 3)


def test_stream_restarts_on_its_state(spark, tmpdir_path):
    messages = hot_and_small(8)
    src = f"{tmpdir_path}/in"
    for k in range(3):
        part = [m for m in messages if k * 100 < m[4] <= (k + 1) * 100]
        spark.createDataFrame(part, MESSAGES).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(MESSAGES).parquet(src)
        query, job = start_ordered_neighbours(stream, [TARGET], f"{tmpdir_path}/out", f"{tmpdir_path}/state",
                                              f"{tmpdir_path}/ck", available_now=True, num_slices=4)
        query.awaitTermination()
    assert rows_of(job.rows()) == batch_rows(spark, messages)
    batches = spark.read.parquet(f"{tmpdir_path}/out/rows").select("batch_id").distinct()
    assert sorted(str(r[0]) for r in batches.collect()) == ["0", "1", "2"]
    assert job.rows().where(F.col("session_id") == "hot").count() > 50
