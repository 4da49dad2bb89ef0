"""The split plan gives exactly the rows of the sequential state machine."""

import json
import random

import pytest

from racestream.operators.neighbours import STATE_OUT_COLUMNS, NeighbourState, fold_id, step, track_neighbours
from racestream.operators.neighbours_split import (
    SUMMARY, advance_neighbours, entry_states, last_states, track_neighbours_split,
)
from racestream.operators.transfer import Segment, Transfer, state_list, state_of
from tests.test_telemetry import GOLDEN, TARGET, random_events, tel, tel_rows


def sequential(rows, targets):
    """(session, target, seq, state columns) of telemetry rows, one key after the other."""
    out = []
    for target in targets:
        for session in {r[0] for r in rows}:
            st = NeighbourState()
            for r in sorted((r for r in rows if r[0] == session), key=lambda r: (r[1], r[2])):
                if step(st, fold_id(target), r[3], r[6], r[7], r[8], r[9], (r[4], r[12], r[13])):
                    out.append((session, target, r[2], *st.output()))
                    st.last_follower_id = st.follower[0]
    return sorted(out, key=repr)


def tracked(df, targets, slices, **kwargs):
    out = track_neighbours_split(df, targets, slices, **kwargs) if kwargs else track_neighbours(df, targets, num_partitions=slices)
    return sorted((tuple(r) for r in out.select("session_id", "target_id", "seq", *STATE_OUT_COLUMNS).collect()), key=repr)


@pytest.mark.parametrize("slices", [1, 4])
def test_golden(spark, slices):
    rows = tel_rows(GOLDEN)
    assert tracked(tel(spark, rows), [TARGET], slices) == sequential(rows, [TARGET])


@pytest.mark.parametrize("seed,slices,batch", [(1, 7, 10000), (2, 16, 5), (3, 31, 3)])
def test_hot_and_small_sessions(spark, seed, slices, batch):
    rng = random.Random(seed)
    rows = []
    # one hot session, several small ones, two targets
    sessions = {"hot": random_events(rng, 900, drivers=10, max_pos=8)}
    for k in range(6):
        sessions[f"s{k}"] = random_events(rng, rng.randint(1, 60), drivers=6, max_pos=5)
    for s, ev in sessions.items():
        rows += tel_rows(ev, s)
    df = tel(spark, rows, partitions=4)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = tracked(df, [TARGET, "D1"], slices)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert got == sequential(rows, [TARGET, "D1"]) and len(got) > 100


def test_slices_without_output_carry_the_previous_follower(spark):
    # the tracked cars fall silent for many slices in the middle of the race
    quiet = [(100 + i, f"Q{i % 5}", 0, 10.0, 100) for i in range(400)]
    ev = GOLDEN + quiet + [(600 + s, d, p, x, v) for s, d, p, x, v in GOLDEN]
    rows = tel_rows(ev)
    got = tracked(tel(spark, rows), [TARGET], 25)
    assert got == sequential(rows, [TARGET])


def test_negative_positions_and_case(spark):
    rng = random.Random(11)
    names = [TARGET, TARGET.lower(), "D1", "d1", "D2", "D3"]
    ev = [(i + 1, rng.choice(names), rng.randint(-3, 7), float(rng.randint(0, 900)), rng.randint(0, 300))
          for i in range(700)]
    rows = tel_rows(ev, "one")
    got = tracked(tel(spark, rows), [TARGET], 23)
    assert got == sequential(rows, [TARGET]) and len(got) > 50


def test_null_session_is_one_key(spark):
    rng = random.Random(4)
    rows = tel_rows(random_events(rng, 300), None) + tel_rows(random_events(rng, 200), "s1")
    got = tracked(tel(spark, rows), [TARGET], 9)
    assert got == sequential(rows, [TARGET]) and any(r[0] is None for r in got)


def test_order_is_total_over_partitions(spark):
    """Same time and offset on three partitions: the rows do not depend on the input's order."""
    from pyspark.sql import functions as F

    ev = [(1, TARGET, 5, 100.0, 200), (1, "A", 6, 90.0, 190), (1, "B", 4, 120.0, 210)]
    seen = set()
    for order in ([0, 1, 2], [2, 1, 0], [1, 2, 0]):
        parts = [tel(spark, tel_rows([ev[i]])).withColumn("partition", F.lit(i)) for i in order]
        df = parts[0].unionByName(parts[1]).unionByName(parts[2])
        out = track_neighbours(df, TARGET).orderBy("partition").select("partition", "follower_driver_id", "leader_driver_id")
        seen.add(tuple(tuple(r) for r in out.collect()))
    assert seen == {((1, "A", "NOLEADER"), (2, "A", "B"))}


@pytest.mark.parametrize("fanout,broadcast", [(3, 20_000), (4, 0)])
def test_tree_of_summaries_and_join_without_broadcast(spark, fanout, broadcast):
    rng = random.Random(fanout)
    rows = tel_rows(random_events(rng, 700, drivers=8, max_pos=7), "hot")
    for k in range(4):
        rows += tel_rows(random_events(rng, 40, drivers=6, max_pos=5), f"s{k}")
    got = tracked(tel(spark, rows), [TARGET], 30, fanout=fanout, broadcast_slices=broadcast)
    assert got == sequential(rows, [TARGET]) and len(got) > 50


# -- transfers ------------------------------------------------------------------------


def learned(events):
    t = Transfer()
    for driver, pos, *rest in events:
        t.feed((driver, pos, *rest, True), fold_id(driver) == "t", (1, 2.0, 3.0))
    return reloaded(t.done())


def reloaded(t):
    return Transfer.load(json.loads(json.dumps(t.dump())))


def stretch(rng, n, positions, target):
    return [("T" if rng.random() < target else rng.choice("ABCDEFGH"), rng.randint(*positions), rng.randint(1, 3),
             float(rng.randint(0, 50)), rng.randint(0, 9)) for _ in range(n)]


def test_transfers_compose_in_any_order():
    rng = random.Random(7)
    for _ in range(1500):
        positions = rng.choice([(1, 8), (-3, 6), (0, 5), (-2, 2), (1, 30000)])
        target = rng.choice([0, 0.05, 0.3])
        st = NeighbourState()

        def run(events):
            for driver, pos, *rest in events:
                if step(st, "t", driver, pos, *rest, (1, 2.0, 3.0)):
                    st.last_follower_id = st.follower[0]
        run(stretch(rng, rng.randint(0, 20), positions, rng.choice([0, 0.2])))
        before = json.loads(json.dumps(state_list(st)))
        assert state_of(before).last_follower_id == st.last_follower_id
        parts = [stretch(rng, rng.randint(0, 8), positions, target) for _ in range(rng.randint(1, 6))]
        for p in parts:
            run(p)
        transfers = [learned(p) for p in parts]
        state = before
        for t in transfers:
            state = t.apply(state)
        assert state == state_list(st)
        while len(transfers) > 1:
            k = rng.randrange(len(transfers) - 1)
            transfers[k:k + 2] = [reloaded(transfers[k].then(transfers[k + 1]))]
        assert transfers[0].apply(before) == state_list(st)


def test_a_summary_does_not_grow_with_the_events():
    rng = random.Random(1)
    dumps = [len(json.dumps(learned(stretch(rng, n, (1, 20), 0.05)).dump())) for n in (500, 50_000)]
    assert dumps[1] < 2 * dumps[0] + 500


def test_ten_thousand_slices(spark):
    """Summaries alone: 10,000 slices of one race, composed on the executors, against the plain sequence."""
    rng = random.Random(12)
    st, rows, want = NeighbourState(), [], {}
    for k in range(10_000):
        key = ["race" if k < 9_000 else f"r{k // 10}", "T"]
        if rows and key != json.loads(rows[-1][1])[1]:
            st = NeighbourState()
        elif rows:
            want[k] = [key, state_list(st)]
        events = stretch(rng, rng.randint(1, 4), (1, 9), 0.1)
        rows.append((k, Segment(key, key, learned(events), None).dump()))
        for driver, pos, *rest in events:
            step(st, "t", driver, pos, *rest, (1, 2.0, 3.0))
    df = spark.createDataFrame(rows, SUMMARY).repartition(8)
    got = {r.slice: json.loads(r.entry) for r in entry_states(df, 10_000).collect()}
    missing = set(want) - set(got)
    assert not missing and all(got[k] == json.loads(json.dumps(want[k])) for k in want)


# -- from given states on --------------------------------------------------------------


def test_batches_one_after_the_other(spark):
    rng = random.Random(21)
    sessions = {s: tel_rows(random_events(rng, n, drivers=7, max_pos=6), s) for s, n in (("hot", 400), ("a", 30), (None, 60))}
    rows = [r for rs in sessions.values() for r in rs]
    want = sequential(rows, [TARGET])
    got, states = [], None
    for part in range(3):
        some = [r for rs in sessions.values() for r in rs[part * len(rs) // 3:(part + 1) * len(rs) // 3]]
        out = advance_neighbours(tel(spark, some), [TARGET], states, num_slices=6).cache()
        states = spark.createDataFrame(last_states(out).collect(), "session_id string, target_id string, state string")
        got += [tuple(r) for r in out.where("state is null").select("session_id", "target_id", "seq", *STATE_OUT_COLUMNS).collect()]
        out.unpersist()
    assert sorted(got, key=repr) == want and states.count() == 3
