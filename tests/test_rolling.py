"""Rolling parts: few files, each line once, also when an attempt stops between any two steps."""

import glob
import random

import pytest

from racestream.sinks import rolling
from racestream.sinks.rolling import RollingPolicy, RollingSink


class Stop(Exception):
    pass


def frame(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "line string")


def lines_of(sink):
    return sorted(r.value for r in sink.lines().collect())


def data_files(base):
    return glob.glob(f"{base}/bucket=b/part=*/part-*")


def test_many_batches_few_parts(spark, tmpdir_path):
    now = [0.0]
    sink = RollingSink(spark, tmpdir_path, "b", RollingPolicy(60, 180, 10_000), clock=lambda: now[0])
    for k in range(13):  # a line every 10 seconds, as from many micro-batches
        sink.write(frame(spark, [f"line {k}"]), k)
        now[0] += 10
    assert lines_of(sink) == sorted(f"line {k}" for k in range(7))  # the oldest was 60 seconds old
    sink.finish()
    sink.finish()
    assert lines_of(sink) == sorted(f"line {k}" for k in range(13))
    assert len(data_files(tmpdir_path)) == 2
    sink.write(frame(spark, ["after"]), 13)  # the query goes on
    sink.finish(13)
    assert lines_of(sink) == sorted([f"line {k}" for k in range(13)] + ["after"])
    assert sorted(r.value for r in spark.read.text(f"{tmpdir_path}/bucket=b").select("value").collect()) == lines_of(sink)


def test_rolls_by_size_and_by_idleness(spark, tmpdir_path):
    now = [0.0]
    sink = RollingSink(spark, tmpdir_path, "b", RollingPolicy(1000, 50, 100), clock=lambda: now[0])
    sink.write(frame(spark, ["x" * 30]), 0)
    assert lines_of(sink) == []
    sink.write(frame(spark, ["y" * 200] * 2), 1)
    assert len(lines_of(sink)) == 3 and len(data_files(tmpdir_path)) > 1
    sink.write(frame(spark, ["z"]), 2)
    now[0] += 51
    sink.write(frame(spark, []), 3)  # nothing came
    assert len(lines_of(sink)) == 4
    with pytest.raises(RuntimeError):
        sink.write(frame(spark, ["q"]), 9)


def test_stops_between_any_two_steps(spark, tmpdir_path, monkeypatch):
    rng = random.Random(2)
    now = [0.0]
    sink = RollingSink(spark, tmpdir_path, "b", RollingPolicy(25, 180, 10_000), clock=lambda: now[0])
    steps = {"left": None}

    def counted(fn):
        def run(*args, **kwargs):
            if steps["left"] is not None:
                if not steps["left"]:
                    raise Stop
                steps["left"] -= 1
            return fn(*args, **kwargs)
        return run

    for name in ("delete_path", "path_size", "write_text", "read_text"):
        monkeypatch.setattr(rolling, name, counted(getattr(rolling, name)))
    monkeypatch.setattr(RollingSink, "_roll", counted(RollingSink._roll))
    want, stopped = [], 0
    for k in range(8):
        lines = [f"{k}-{i}" for i in range(rng.randint(0, 3))]
        want += lines
        for attempt in range(3):  # the last attempt gets through, after which Spark commits the batch
            steps["left"] = rng.randint(0, 7) if attempt < 2 else None
            try:
                sink.write(frame(spark, lines), k)
            except Stop:
                stopped += 1
            now[0] += 5
    sink.finish(7)
    assert lines_of(sink) == sorted(want) and stopped > 5
    assert sorted(r.value for r in spark.read.text(f"{tmpdir_path}/bucket=b").select("value").collect()) == sorted(want)
