"""Windows by panes with late clicks apart, against a plain loop; replays."""

import datetime as dt
import random

import pytest

from racestream.options import ClickOptions
from racestream.streaming.panes import PaneWindows

T0 = dt.datetime(2024, 3, 1, 12, 0, 0)
SCHEMA = "value string, ts timestamp_ntz, seq long"
OPTS = ClickOptions().replace(window_size_mins=10, window_slide_secs=240, watermark_delay="2 minutes")


def expected(batches):
    size, slide = 600, 240
    epoch = dt.datetime(1970, 1, 1)
    windows, late, latest = {}, [], None
    for batch in batches:
        mark = None if latest is None else latest - dt.timedelta(minutes=2)
        for value, ts, seq in batch:
            if not value or "-1" in value or "{" not in value:
                continue
            account = int(value.split(":")[1].rstrip("}"))
            at = int((ts - epoch).total_seconds())
            start = at // slide * slide
            while start > at - size:
                end = epoch + dt.timedelta(seconds=start + size)
                if mark is not None and end <= mark:
                    late.append((account, seq, end))
                else:
                    windows.setdefault((account, end), []).append((ts, seq, value))
                start -= slide
        latest = max([t for _, t, _ in batch] + ([latest] if latest else []), default=None)
    return sorted((a, e, len(c), min(c)[2]) for (a, e), c in windows.items()), sorted(late)


def test_windows_and_late_clicks(spark, tmpdir_path):
    rng = random.Random(6)
    batches = []
    for k in range(5):
        batch = []
        for i in range(60):
            minute = k * 8 + rng.random() * 8 - (rng.random() * 25 if rng.random() < 0.3 else 0)
            body = rng.choice(['{"user.accountId":1}', '{"user.accountId":2}', '{"user.accountId":-1}', "junk", None])
            batch.append((body, T0 + dt.timedelta(seconds=int(minute * 60)), k * 100 + i))
        batches.append(batch)
    batches.insert(2, [])
    job = PaneWindows(spark, OPTS, f"{tmpdir_path}/out", f"{tmpdir_path}/state")

    def rows():
        got = [(r.account_id, r.window_end, r.n, r.first_raw) for r in job.windows().collect()]
        late = [(r.account_id, r.seq, r.window_end) for r in job.late().collect()]
        return sorted(got), sorted(late)

    for k, batch in enumerate(batches):
        df = spark.createDataFrame(batch, SCHEMA).coalesce(2)
        job(df, k)
        if k == 3:
            before = rows()
            job(df, k)
            assert rows() == before
    job.finish(5)
    job.finish(5)
    assert rows() == expected(batches) and rows()[1]
    with pytest.raises(RuntimeError):
        job(spark.createDataFrame([], SCHEMA), 9)
