"""Property tests of the neighbour state machine (pure Python, many cases).

``two_step`` is the step table of SURVEY section 2.5 written out rule by rule
(steps 0-6, both take rules of each car separately); ``step`` in the package
folds each pair of take rules into one branch, and the SQL oracle uses the
shortened form. All three must agree on any sequence of events, including
negative positions and ids that differ only in case.
"""

from hypothesis import given, settings
from hypothesis import strategies as st

from racestream.operators.neighbours import NeighbourState, step

TARGET = "Tgt"


def two_step(events, target):
    me = ["NULL", 0]
    fol = ["NOFOLLOWER", 0]
    lea = ["NOLEADER", 0]
    tracking = False
    out = []
    for i, (drv, p) in enumerate(events):
        t = drv.lower() == target.lower()
        if t:                                                     # 1
            me = [drv, p]
        m = me[1]
        if fol[1] <= m:                                           # 2
            fol[0] = "NOFOLLOWER"
        if not t and fol[0] == "NOFOLLOWER" and m != 0 and p > m:  # 3a
            fol = [drv, p]
        if not t and p > 0 and p > m and m != 0 and p <= fol[1]:   # 3b
            fol = [drv, p]
            tracking = True
        if lea[1] >= m:                                           # 4
            lea[0] = "NOLEADER"
        if not t and m != 0 and lea[0] == "NOLEADER" and p < m:   # 5a
            lea = [drv, p]
        if not t and m != 0 and p > 0 and p < m and p >= lea[1]:  # 5b
            lea = [drv, p]
            tracking = True
        ids = (me[0].lower(), fol[0].lower(), lea[0].lower())
        if tracking and drv.lower() in ids:                       # 6
            out.append((i, me[0], me[1], fol[0], fol[1], lea[0], lea[1]))
    return out


def shortened(events, target):
    me, fol, lea, tracking, out = ("NULL", 0), ("NOFOLLOWER", 0), ("NOLEADER", 0), False, []
    for i, (drv, p) in enumerate(events):
        t = drv.lower() == target.lower()
        if t:
            me = (drv, p)
        m = me[1]
        if fol[1] <= m:
            fol = ("NOFOLLOWER", fol[1])
        if lea[1] >= m:
            lea = ("NOLEADER", lea[1])
        ftake = not t and m != 0 and p > m and (fol[0] == "NOFOLLOWER" or (p > 0 and p <= fol[1]))
        ltake = not t and m != 0 and p < m and (lea[0] == "NOLEADER" or (p > 0 and p >= lea[1]))
        if ftake:
            fol = (drv, p)
        if ltake:
            lea = (drv, p)
        tracking = tracking or (ftake and p > 0) or (ltake and p > 0)
        if tracking and drv.lower() in (me[0].lower(), fol[0].lower(), lea[0].lower()):
            out.append((i, me[0], me[1], fol[0], fol[1], lea[0], lea[1]))
    return out


def package(events, target):
    s = NeighbourState()
    out = []
    for i, (drv, p) in enumerate(events):
        if step(s, target.lower(), drv, p, 1, 0.0, 100):
            out.append((i, s.me[0], s.me[1], s.follower[0], s.follower[1], s.leader[0], s.leader[1]))
    return out


drivers = st.sampled_from(["Tgt", "tgt", "TGT", "a", "A", "b", "c", "d"])
events = st.lists(st.tuples(drivers, st.integers(min_value=-3, max_value=8)), max_size=60)


@settings(max_examples=600, deadline=None)
@given(events)
def test_step_matches_rule_table(ev):
    assert package(ev, TARGET) == two_step(ev, TARGET)


@settings(max_examples=600, deadline=None)
@given(events)
def test_shortened_form_matches_rule_table(ev):
    assert shortened(ev, TARGET) == two_step(ev, TARGET)


# -- the split plan against the rule table, through Spark -------------------------------

def _spark_rows(spark, sessions):
    import datetime as dt

    from tests.test_telemetry import TEL_SCHEMA
    t0 = dt.datetime(2024, 5, 1)
    rows = []
    for s, ev in sessions.items():
        for i, (drv, p) in enumerate(ev):
            rows.append((s, t0 + dt.timedelta(seconds=i), i, drv, 1, "x", p, 1, 0.0, 100, 1.0, 1.0, 0.0, 0.0))
    return spark.createDataFrame(rows, TEL_SCHEMA)


@settings(max_examples=8, deadline=None)
@given(st.dictionaries(st.sampled_from(["r1", "r2", "r3"]), events, min_size=1, max_size=3),
       st.integers(min_value=2, max_value=12))
def test_split_plan_matches_rule_table(spark, sessions, slices):
    from racestream.operators.neighbours import track_neighbours
    df = _spark_rows(spark, sessions)
    got = {}
    for r in track_neighbours(df, TARGET, num_partitions=slices).collect():
        got.setdefault(r.session_id, []).append(
            (r.seq, r.me_driver_id, r.me_car_position, r.follower_driver_id, r.follower_car_position,
             r.leader_driver_id, r.leader_car_position))
    for s, ev in sessions.items():
        assert sorted(got.get(s, [])) == two_step(ev, TARGET), s
