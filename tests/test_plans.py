"""Physical plan properties that the design relies on (guards against regressions)."""

import contextlib
import io
import re

from racestream.plans import queries as Q

SMALL = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def exchanges(text: str) -> list:
    return re.findall(r"Arguments: (hashpartitioning|rangepartitioning|roundrobinpartitioning|SinglePartition)[^\n]*", text)


def test_click_counts_partial_count_of_panes_pruned_scan(spark):
    text = plan(Q.q_click_counts_sliding(spark, SMALL))
    physical = text.split("\n\n")[0].splitlines()
    keyed = [e for e in re.findall(r"Arguments: (hashpartitioning\([^)]*\))", text)]
    # one shuffle of the partial counts, one of the pane counts; copies into windows are not shuffled
    assert len(keyed) == 2 and all("account_id" in k for k in keyed)
    copies = next(i for i, x in enumerate(physical) if "Generate" in x)
    assert not any("Exchange" in x for x in physical[:copies]) and "Expand" not in text
    assert "partial_count(1)" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in text


def test_routes_read_the_aggregate_once(spark):
    text = plan(Q.q_click_routes(spark, SMALL))
    assert text.count("partial_count(1)") == 1
    assert "Union" not in text


def test_decode_parses_each_message_once(spark):
    text = plan(Q.q_telemetry_decode(spark, SMALL))
    physical = text.split("\n\n")[0]
    assert "Generate" in physical
    # from_json appears in the Generate only, not also in a pushed-down Filter
    filters = [line for line in text.splitlines() if line.startswith("Condition")]
    assert filters and not any("from_json" in f for f in filters)


def test_neighbours_run_in_slices_and_changes_need_no_window(spark):
    for query in (Q.q_neighbours, Q.q_gaps, Q.q_gap_report, Q.q_gap_csv, Q.q_follower_changes, Q.q_adjacent_pairs):
        text = plan(query(spark, SMALL))
        # the sorted slices are read from the checkpoint: the rows pass through Python twice and no shuffle
        # of them is left, only that of the summaries (one row per slice)
        physical = text.split("\n\n")[0]
        assert physical.count("MapInArrow") == 2 and "Window" not in text and "session_id" not in "".join(exchanges(text))
        assert [e for e in exchanges(text)] == ["hashpartitioning"] and "BroadcastExchange" in physical


def test_first_events_expand_panes_not_clicks(spark):
    physical = plan(Q.q_click_first_event(spark, SMALL)).split("\n\n")[0]
    # bottom up: the clicks are aggregated into panes before any copy into windows
    lines = [x for x in physical.splitlines() if "Aggregate" in x or "Generate" in x]
    copies = next(i for i, x in enumerate(lines) if "Generate" in x)
    assert all("Aggregate" in x for x in lines[copies + 1:copies + 3]) and "Expand" not in physical


def test_batch_queries_add_no_round_robin(spark):
    for query in (Q.q_click_counts_sliding, Q.q_telemetry_decode):
        assert "roundrobin" not in plan(query(spark, SMALL)).lower()
