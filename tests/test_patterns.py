"""Patterns of named steps: batch over blocks, streams over history, against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from racestream.operators.neighbours import track_neighbours, track_neighbours_stream
from racestream.operators.patterns import (
    PASSED, REPASSED, Pattern, match_neighbours, match_pattern, match_previous, passing_message,
)
from racestream.operators.slices import with_previous
from tests.test_telemetry import TARGET, random_events, tel, tel_rows

ROWS = "k string, t long, v int"


def some_rows(seed, n, keys):
    rng = random.Random(seed)
    return [(rng.choice(keys), i, rng.choice([None, 0, 1, 2, 3])) for i in range(n)]


def by_key(rows):
    out = {}
    for r in sorted(rows, key=lambda r: r[1]):
        out.setdefault(r[0], []).append(r)
    return out


@pytest.mark.parametrize("count,slices,block,broadcast", [(1, 7, 5, 20_000), (3, 13, 4, 0), (3, 1, 1 << 16, 20_000), (2, 40, 2, 20_000)])
def test_previous_rows_over_slices_and_blocks(spark, count, slices, block, broadcast):
    rows = some_rows(count, 120, ["a", "a", "a", "b", None])
    df = spark.createDataFrame(rows, ROWS).repartition(5)
    got = with_previous(df, ["k"], ["t"], count, slices, block_rows=block, broadcast_slices=broadcast)
    want = {(r[0], r[1]): rs[max(0, i - count):i] for rs in by_key(rows).values() for i, r in enumerate(rs)}
    found = {(r.k, r.t): [tuple(p) for p in r.previous] for r in got.collect()}
    assert found == want and len(found) == 120


def test_wrong_counts(spark):
    df = spark.createDataFrame([], ROWS)
    for count in (0, 9):
        with pytest.raises(ValueError):
            with_previous(df, ["k"], ["t"], count, block_rows=8)
    assert with_previous(df, ["k"], ["t"], 2, 3).collect() == []


RISING = (Pattern.begin("low", lambda row, m: row["v"] <= 1)
          .next("mid", lambda row, m: row["v"] > m["low"]["v"])
          .next("high", lambda row, m: row["v"] >= m["low"]["v"] + m["mid"]["v"]))


def test_three_steps_overlap_and_see_all_earlier_rows(spark):
    rows = some_rows(3, 400, ["a", "a", "b"])
    df = spark.createDataFrame(rows, ROWS)
    want = sorted((a[1], b[1], c[1]) for rs in by_key(rows).values() for a, b, c in zip(rs, rs[1:], rs[2:])
                  if None not in (a[2], b[2], c[2]) and a[2] <= 1 and b[2] > a[2] and c[2] >= a[2] + b[2])
    got = match_pattern(df, RISING, ["k"], ["t"], slices=9, block_rows=7)
    assert got.columns == ["k", "low", "mid", "high"]
    assert sorted((r.low.t, r.mid.t, r.high.t) for r in got.collect()) == want and len(want) > 10


def test_one_step_and_within(spark):
    rows = [("a", 0, 1), ("a", 1, 2), ("a", 9, 3)]
    df = spark.createDataFrame(rows, ROWS).withColumn("time", F.timestamp_seconds("t"))
    one = match_pattern(df, Pattern.begin("only", lambda row, m: row["v"] > 1), ["k"], ["t"])
    assert sorted(r.only.t for r in one.collect()) == [1, 9]
    near = match_pattern(df, Pattern.begin("x").next("y").in_time("2 seconds"), ["k"], ["t"], time="time")
    assert [(r.x.t, r.y.t) for r in near.collect()] == [(0, 1)]
    with pytest.raises(ValueError):
        Pattern.begin("x").next("x")


def test_the_original_message(spark):
    rng = random.Random(5)
    rows = tel_rows(random_events(rng, 300, drivers=6, max_pos=5), "s")
    n = track_neighbours(tel(spark, rows), [TARGET], num_partitions=6)
    out = passing_message(match_neighbours(n, PASSED)).collect()
    ordered = sorted(n.collect(), key=lambda r: (r.event_time, r.partition, r.seq))
    want = [f"Pattern Detected:{a.follower_driver_id}was passed by {b.follower_driver_id}"
            for a, b in zip(ordered, ordered[1:]) if a.follower_driver_id != b.follower_driver_id]
    assert sorted(r.message for r in out) == sorted(want) and want


@pytest.mark.parametrize("pattern", [PASSED, REPASSED, Pattern.begin("a").next("b").next("c").next("d")])
def test_stream_over_many_batches_equals_batch(spark, tmpdir_path, pattern):
    rng = random.Random(len(pattern.steps))
    events = random_events(rng, 300, drivers=6, max_pos=5)
    rows = tel_rows(events, "hot") + tel_rows(random_events(rng, 60, drivers=5, max_pos=4), "small")
    src = f"{tmpdir_path}/in"
    for k in range(4):  # in time order, so that arrival order is event order
        part = [r for r in rows if k * 80 < r[2] <= (k + 1) * 80]
        tel(spark, part).coalesce(1).write.mode("append").parquet(src)
    df = tel(spark, rows)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).option("maxFilesPerTrigger", 1).parquet(src)
    tracked = track_neighbours_stream(stream, [TARGET], history=pattern.history)
    q = (match_neighbours(tracked, pattern).writeStream.format("parquet").option("path", f"{tmpdir_path}/out")
         .option("checkpointLocation", f"{tmpdir_path}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    want = match_neighbours(track_neighbours(df, [TARGET]), pattern)
    got = spark.read.parquet(f"{tmpdir_path}/out").select(want.columns)

    def plain(frame):
        return sorted([r.asDict(recursive=True) for r in frame.collect()], key=repr)
    assert plain(got) == plain(want)
    with pytest.raises(ValueError):
        match_neighbours(track_neighbours_stream(stream, [TARGET]), pattern)


@pytest.mark.parametrize("history", [0, 2])
def test_a_long_key_leaves_the_stream_in_short_frames(monkeypatch, history):
    import pandas as pd

    from racestream.operators import neighbours as N

    class State:
        hasTimedOut, exists, get = False, False, None

        def update(self, value):
            self.get = value

    rng, n = random.Random(7), 3 * 8192 + 5
    frame = pd.DataFrame({
        "event_time": pd.to_datetime([rng.choice([None, 0, 3600, 7200]) for _ in range(n)], unit="s"),
        "partition": pd.array([rng.randint(0, 2) for _ in range(n)], dtype="int32"), "seq": range(n),
        "driver_id": [rng.choice([TARGET, "a", "B", "c", None]) for _ in range(n)],
        "driver_status": [rng.choice(["x", None]) for _ in range(n)],
        "car_position": pd.array([rng.randint(0, 5) for _ in range(n)], dtype="int32"),
        "current_lap_num": [rng.choice([None, 1.0, 2.0]) for _ in range(n)], "speed": 3, "race_number": 7,
        **{c: pd.Series([rng.choice([None, 0.5, 1.5]) for _ in range(n)], dtype="float32")
           for c in ("lap_distance", "fuel_in_tank", "g_force_lateral", "g_force_longitudinal")}})

    def run():
        state = State()
        parts = (frame.iloc[at:at + 1000] for at in range(0, n, 1000))
        return list(N.stream_handler(("s", TARGET), parts, state, history=history)), state.get

    got, last = run()
    assert len(got) > 3 and max(map(len, got)) <= 8192
    monkeypatch.setattr(N, "STREAM_ROWS", n)
    whole, same = run()
    assert len(whole) == 1 and last == same
    pd.testing.assert_frame_equal(pd.concat(got, ignore_index=True), whole[0])
    order = whole[0][["event_time", "partition", "seq"]]
    assert order.equals(order.sort_values(["event_time", "partition", "seq"], kind="stable"))


def test_rows_that_bring_their_history(spark):
    df = spark.createDataFrame([("a", 2, 5, [("a", 1, 4)]), ("a", 1, 4, [])], f"{ROWS}, previous array<struct<{ROWS.replace(' ', ':').replace(',:', ',')}>>")
    got = match_previous(df, Pattern.begin("x").next("y", lambda row, m: row["v"] > m["x"]["v"]), ["k"])
    assert [(r.x.t, r.y.t) for r in got.collect()] == [(1, 2)]
