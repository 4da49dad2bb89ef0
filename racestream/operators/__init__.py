"""Operators: each is DataFrame -> DataFrame and has no action inside (the
neighbour plan's slice summaries aside)."""

from racestream.operators.clicks import (
    as_lines, authenticated, click_counts, console_counts, first_events, nine_or_less,
    observe_skipped, parse_clicks, routed_lines, routes, skipped_counts, ten_or_more,
)
from racestream.operators.gaps import csv_lines, gap_csv, gap_report, with_gaps
from racestream.operators.neighbours import attach_targets, track_neighbours, track_neighbours_stream
from racestream.operators.patterns import adjacent_pairs, every_pair, follower_changed, follower_changes
from racestream.operators.telemetry import decode_telemetry, dump_bytes, status_lines, telemetry_quality

__all__ = [
    "as_lines", "authenticated", "click_counts", "console_counts", "first_events", "nine_or_less",
    "observe_skipped", "parse_clicks", "routed_lines", "routes", "skipped_counts", "ten_or_more",
    "csv_lines", "gap_csv", "gap_report", "with_gaps",
    "attach_targets", "track_neighbours", "track_neighbours_stream",
    "adjacent_pairs", "every_pair", "follower_changed", "follower_changes",
    "decode_telemetry", "dump_bytes", "status_lines", "telemetry_quality",
]
