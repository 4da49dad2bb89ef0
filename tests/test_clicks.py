"""Click operators: parsing, filters, windows, routing (batch)."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import Row, functions as F

from racestream.operators import clicks as C
from racestream.options import PRODUCTION, TEST, ClickOptions
from racestream.schemas import CLICK_SCHEMA

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)

# FIXTURES.md section 1: the parse table.
PARSE_CASES = [
    ('{"user.accountId":88}', 88),
    ('{"user.accountId":3.7}', 3),
    ('{"user.accountId":-3.9}', -3),
    ('{"user.accountId":-1}', -1),
    ('{"user.accountId":1e3}', 1000),
    ('{"user.accountId":"88"}', None),
    ('{"user.accountId":"NaN"}', None),
    ('{"user.accountId":3000000000}', None),
    ('{"user.accountId":null}', None),
    ('{"user.accountId":true}', None),
    ('{"user":{"accountId":5}}', None),
    ('[{"user.accountId":7}]', None),
    ("bad", None),
    ("", None),
    ('{"user.accountId":5} trailing', 5),
    ('{"user.accountId":5', None),
    ('{"user.accountId":5,"user.accountId":6}', 6),
]


def click(account, ms, seq):
    body = json.dumps({"user.ip": "192.168.1.1", "user.accountId": account, "page": "someurl",
                       "host.timestamp": ms, "host": "host", "host.sequence": "sequence"})
    return (body, T0 + dt.timedelta(milliseconds=ms), seq)


def frame(spark, rows):
    return spark.createDataFrame(rows, CLICK_SCHEMA)


def test_parse_table(spark):
    rows = [(v, T0, i) for i, (v, _) in enumerate(PARSE_CASES)]
    got = {r.seq: r.account_id for r in C.parse_clicks(frame(spark, rows)).collect()}
    for i, (v, want) in enumerate(PARSE_CASES):
        assert got[i] == want, v


def test_parse_null_body(spark):
    got = C.parse_clicks(frame(spark, [(None, T0, 1)])).collect()
    assert got[0].account_id is None


def test_authenticated_and_skipped(spark):
    rows = [click(5, 0, 1), click(-1, 1, 2), click(-7, 2, 3), ("junk", T0, 4)]
    parsed = C.parse_clicks(frame(spark, rows))
    kept = sorted(r.account_id for r in C.authenticated(parsed).collect())
    assert kept == [-7, 5]  # only -1 is anonymous
    s = C.skipped_counts(parsed).collect()[0]
    assert (s.n_unparsable, s.n_anonymous, s.n_kept) == (1, 1, 2)


def test_observe_skipped(spark):
    rows = [click(5, 0, 1), click(-1, 1, 2), ("junk", T0, 3)]
    observed, obs = C.observe_skipped(C.parse_clicks(frame(spark, rows)))
    observed.write.format("noop").mode("overwrite").save()
    assert obs.get == {"n_unparsable": 1, "n_anonymous": 1}


def counts_of(spark, rows, opts):
    return C.click_counts(C.authenticated(C.parse_clicks(frame(spark, rows))), opts)


def lines(df):
    return sorted(r.line for r in df.collect())


def route(spark, rows, opts):
    r = C.routes(counts_of(spark, rows, opts), opts)
    return lines(r[C.SINK_TEN_OR_MORE]), lines(r[C.SINK_NINE_OR_LESS])


# FIXTURES.md section 2, tumbling 10 min, thresholds 10 and 9.
def test_nine_or_less(spark):
    rows = [click(88, ms, i) for i, ms in enumerate([100, 200, 300, 300])]
    assert route(spark, rows, TEST) == ([], ["88"])


def test_ten_or_more(spark):
    rows = [click(99, ms, i) for i, ms in enumerate([10, 20, 30, 40, 50, 60, 70, 80, 90, 90])]
    assert route(spark, rows, TEST) == (["99"], [])


def test_longer_span(spark):
    ms = [0, 7500, 15000, 22500, 30000, 37500, 45000, 45500, 46000, 46500, 47000, 47500, 47500]
    rows = [click(77, m, i) for i, m in enumerate(ms)]
    assert route(spark, rows, TEST) == (["77"], [])


def test_exactly_nine_goes_nowhere(spark):
    rows = [click(66, i * 1000, i) for i in range(9)]
    assert route(spark, rows, TEST) == ([], [])


def test_anonymous_never_routed(spark):
    rows = [click(-1, i * 1000, i) for i in range(10)]
    assert route(spark, rows, TEST) == ([], [])


def test_two_windows(spark):
    rows = [click(55, i * 1000, i) for i in range(10)]
    rows += [click(55, 10 * 60 * 1000 + i * 1000, 100 + i) for i in range(2)]
    assert route(spark, rows, TEST) == (["55"], ["55"])


def test_overlapping_thresholds(spark):
    opts = TEST.replace(ten_or_more_threshold=6, nine_or_less_threshold=9)
    rows = [click(44, i * 1000, i) for i in range(7)]
    assert route(spark, rows, opts) == (["44"], ["44"])


def test_slide_that_does_not_divide_the_size(spark):
    opts = ClickOptions(window_size_mins=1, window_slide_secs=25)
    rng = random.Random(2)
    rows = [click(rng.randint(1, 3), rng.randint(0, 300_000), i) for i in range(80)]
    epoch, want = dt.datetime(1970, 1, 1), {}
    for body, ts, seq in rows:
        t = (ts - epoch).total_seconds()
        start = t // 25 * 25
        while start > t - 60:  # windows are half-open and aligned to the epoch
            want.setdefault((json.loads(body)["user.accountId"], epoch + dt.timedelta(seconds=start)), []).append((ts, seq, body))
            start -= 25
    authed = C.authenticated(C.parse_clicks(frame(spark, rows)))
    counts = {(r.account_id, r.window_start): r.n for r in C.click_counts(authed, opts).collect()}
    first = {(r.account_id, r.window_start): (r.n, r.first_raw) for r in C.first_events(authed, opts).collect()}
    assert counts == {k: len(v) for k, v in want.items()}
    assert first == {k: (len(v), min(v)[2]) for k, v in want.items()}


def test_sliding_counts_every_covering_window(spark):
    opts = PRODUCTION  # 10 min sliding by 60 s
    rows = [click(3, 0, 1), click(3, 90_000, 2)]
    got = {(r.window_start - T0).total_seconds(): r.n for r in counts_of(spark, rows, opts).collect()}
    assert len(got) == 11
    assert got[0] == 2 and got[60] == 1 and got[-540] == 1


def test_first_event_by_time_then_seq(spark):
    rows = [click(9, 500, 7), click(9, 100, 5), click(9, 100, 3)]
    opts = TEST
    got = C.first_events(C.authenticated(C.parse_clicks(frame(spark, rows))), opts).collect()
    assert len(got) == 1 and got[0].n == 3
    assert got[0].first_raw == rows[2][0]


def test_routed_lines_single_pass(spark):
    opts = TEST.replace(ten_or_more_threshold=6, nine_or_less_threshold=9)
    rows = [click(44, i * 1000, i) for i in range(7)] + [click(12, 0, 50)]
    got = sorted((r.sink, r.line) for r in C.routed_lines(counts_of(spark, rows, opts), opts).collect())
    assert got == [("nine_or_less", "12"), ("nine_or_less", "44"), ("ten_or_more", "44")]


def test_console_branch_only_when_enabled(spark):
    rows = [click(1, 0, 1)]
    assert "console" in C.routes(counts_of(spark, rows, TEST), TEST)
    assert "console" not in C.routes(counts_of(spark, rows, PRODUCTION), PRODUCTION)


def test_options_from_properties(tmpdir_path):
    path = f"{tmpdir_path}/job.properties"
    with open(path, "w") as fh:
        fh.write("# comment\nWindowSizeMins:5\nWindowSlideSecs=30\nConsoleOutput:TRUE\n"
                 "TenOrMoreThreshold:12\n")
    o = ClickOptions.from_properties(path)
    assert (o.window_size_mins, o.window_slide_secs, o.console_output, o.ten_or_more_threshold) == (5, 30, True, 12)
    assert o.nine_or_less_threshold == 9  # default kept
    assert ClickOptions.from_properties(f"{tmpdir_path}/missing") == ClickOptions()


def test_reference_settings_files():
    assert (PRODUCTION.window_size_mins, PRODUCTION.window_slide_secs) == (10, 60)
    assert PRODUCTION.console_output is False and PRODUCTION.console_output_count_threshold == 1
    assert TEST.tumbling and TEST.console_output and TEST.console_output_count_threshold == 0
    assert (TEST.ten_or_more_threshold, TEST.nine_or_less_threshold) == (10, 9)
    assert ClickOptions().ten_or_more_threshold == 6  # the job's own default


def test_slide_larger_than_size_refused():
    with pytest.raises(ValueError):
        ClickOptions(window_size_mins=1, window_slide_secs=120)
