"""Registered queries over the driver tables: ``(spark, sf_dir) -> DataFrame``.

Every query reads the whole ``events`` table (clicks and telemetry are derived
from it by Spark), so its work grows with the table.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from racestream.operators import clicks as C
from racestream.operators.gaps import gap_csv, gap_report, with_gaps, without_gaps
from racestream.operators.neighbours import track_neighbours
from racestream.operators.patterns import (
    PASSED, REPASSED, adjacent_pairs, every_pair, follower_changes, match_neighbours,
)
from racestream.operators.telemetry import (
    decode_telemetry, dump_bytes, status_lines, telemetry_quality,
)
from racestream.options import DRIVER_TABLES, ClickOptions, TelemetryOptions
from racestream.plans.jobs import find_follower_stream, measure_gap_stream
from racestream.session import cores, scoped_conf, scratch_path
from racestream.sources.clicks import clicks_from_events, clicks_in_other_spellings, read_events
from racestream.sources.log import append_log, read_log
from racestream.sources.telemetry import kafka_layout_from_events
from racestream.sinks.rolling import RollingPolicy
from racestream.streaming.clicks import (
    click_sinks, start_click_job, windowed_counts_stream, with_end_marker, write_end_marker,
)
from racestream.streaming.ordered import start_ordered_neighbours
from racestream.streaming.panes import PaneWindows
from racestream.streaming.telemetry import neighbours_stream, start_to_files

# Fixed value: the tracked driver in the telemetry derived from ``events``.
DRIVER_TABLES_TARGET = "DRIVER_07"

OPTS: ClickOptions = DRIVER_TABLES
CONSOLE: ClickOptions = OPTS.replace(console_output_count_threshold=ClickOptions().console_output_count_threshold)


# -- shared inputs ----------------------------------------------------------------

def parsed_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.parse_clicks(clicks_from_events(read_events(spark, sf_dir)))


def authed_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.authenticated(parsed_clicks(spark, sf_dir))


def counts(spark: SparkSession, sf_dir: str, opts: ClickOptions = OPTS) -> DataFrame:
    return C.click_counts(authed_clicks(spark, sf_dir), opts)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kafka_layout_from_events(read_events(spark, sf_dir))


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_telemetry(messages(spark, sf_dir))


def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return track_neighbours(telemetry(spark, sf_dir), [DRIVER_TABLES_TARGET])


def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_gaps(neighbours(spark, sf_dir))


# -- clicks ----------------------------------------------------------------------

def q_click_parse(spark, sf_dir):
    return parsed_clicks(spark, sf_dir)


def q_click_canonical(spark, sf_dir):
    """Parsed clicks whose bodies are spelled in several ways, with the body written anew."""
    return C.parse_clicks(clicks_in_other_spellings(read_events(spark, sf_dir)), canonical=True)


def q_click_authenticated(spark, sf_dir):
    return authed_clicks(spark, sf_dir)


def q_click_skipped(spark, sf_dir):
    return C.skipped_counts(parsed_clicks(spark, sf_dir))


def q_click_counts_sliding(spark, sf_dir):
    return counts(spark, sf_dir)


def q_click_counts_tumbling(spark, sf_dir):
    return counts(spark, sf_dir, OPTS.replace(window_slide_secs=OPTS.window_size_mins * 60))


def q_click_first_event(spark, sf_dir):
    return C.first_events(authed_clicks(spark, sf_dir), OPTS)


def q_ten_or_more(spark, sf_dir):
    return C.as_lines(C.ten_or_more(counts(spark, sf_dir), OPTS))


def q_nine_or_less(spark, sf_dir):
    return C.as_lines(C.nine_or_less(counts(spark, sf_dir), OPTS))


def q_console_counts(spark, sf_dir):
    return C.console_counts(counts(spark, sf_dir), CONSOLE)


def q_click_routes(spark, sf_dir):
    return C.routed_lines(counts(spark, sf_dir), OPTS)


def _closed(spark, sf_dir, start) -> None:
    """Run a click stream over ``events`` to its end, in two starts on one checkpoint:
    the second finds the end marker, which closes the windows still open."""
    marker = scratch_path(spark, "end_marker")
    clicks = clicks_from_events(read_events(spark, sf_dir, stream=True))
    for end in (False, True):
        write_end_marker(spark, clicks, marker, end=end)
        start(with_end_marker(clicks, marker)).awaitTermination()


def q_click_counts_stream(spark, sf_dir):
    """The sliding counts as a stream over ``events`` (append mode), every window closed."""
    base = scratch_path(spark, "click_counts_stream")
    _closed(spark, sf_dir, lambda clicks: start_to_files(
        windowed_counts_stream(clicks, OPTS), f"{base}/out", f"{base}/checkpoint", state_partitions=cores(spark)))
    return spark.read.parquet(f"{base}/out")


def q_click_first_event_stream(spark, sf_dir):
    """Counts with each window's first click as a stream: pane state, then window state, in one append query."""
    base = scratch_path(spark, "click_first_event_stream")
    _closed(spark, sf_dir, lambda clicks: start_to_files(
        windowed_counts_stream(clicks, OPTS, first=True, chained=True), f"{base}/out", f"{base}/checkpoint", state_partitions=cores(spark)))
    return spark.read.parquet(f"{base}/out")


def q_click_routes_stream(spark, sf_dir):
    """The click job as it runs: a stream, one state store, every closed window
    sent by ``foreachBatch`` to the high-count and low-count rolling text sinks; the
    result is what the finished parts of the two hold, one account id per line."""
    base = scratch_path(spark, "click_routes_stream")
    _closed(spark, sf_dir, lambda clicks: start_click_job(
        clicks, OPTS, f"{base}/out", f"{base}/checkpoint", available_now=True, console=False,
        state_partitions=cores(spark), rolling=RollingPolicy()))
    parts = []
    for name, sink in click_sinks(spark, f"{base}/out").items():
        sink.finish()
        parts.append(sink.lines().select(F.lit(name).alias("sink"), F.col("value").alias("line")))
    return parts[0].unionByName(parts[1])


# -- telemetry -------------------------------------------------------------------

def q_telemetry_decode(spark, sf_dir):
    return telemetry(spark, sf_dir)


def q_telemetry_decode_stream(spark, sf_dir):
    """Decoding as a stream over a partitioned log (offsets per partition), in two starts on one checkpoint: the
    second one resumes at the offsets of the first, after more was appended."""
    base = scratch_path(spark, "telemetry_decode_stream")
    written = messages(spark, sf_dir)
    half = written.agg(F.max("offset")).first()[0] // 2
    for late in (False, True):
        append_log(written.where((F.col("offset") >= half) == late), f"{base}/log")
        decoded = decode_telemetry(read_log(spark, f"{base}/log", stream=True, topic="telemetry"))
        start_to_files(decoded, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/out")


def q_telemetry_quality(spark, sf_dir):
    return telemetry_quality(messages(spark, sf_dir))


def q_telemetry_status(spark, sf_dir):
    return status_lines(telemetry(spark, sf_dir))


def q_raw_dump(spark, sf_dir):
    return dump_bytes(messages(spark, sf_dir))


def q_neighbours(spark, sf_dir):
    return neighbours(spark, sf_dir)


def _slices(spark: SparkSession) -> int:
    # two slices per core: every core busy, slices as large as possible
    return max(8, 2 * cores(spark))


def q_neighbours_split(spark, sf_dir):
    """The same rows from another number of slices (two for each core)."""
    return track_neighbours(telemetry(spark, sf_dir), [DRIVER_TABLES_TARGET], num_partitions=_slices(spark))


def targets_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracked drivers by session, in ids of another case: one in every session, a
    second one on days with an even number."""
    sessions = telemetry(spark, sf_dir).select("session_id").distinct()
    second = F.when(F.substring("session_id", 9, 2).cast("int") % 2 == 0, F.lit("driver_11"))
    ids = F.filter(F.array(F.lit("Driver_07"), second), lambda x: x.isNotNull())
    return sessions.select("session_id", F.explode(ids).alias("target_id"))


def q_neighbours_targets_table(spark, sf_dir):
    """Neighbours of the drivers of a targets table."""
    return track_neighbours(telemetry(spark, sf_dir), targets_table(spark, sf_dir))


def q_find_follower(spark, sf_dir):
    """The neighbour report, printed before any gap is known."""
    return gap_report(without_gaps(neighbours(spark, sf_dir)))


def q_find_follower_stream(spark, sf_dir):
    """The same report as a stream over ``events``, written to files and read back."""
    return _telemetry_stream(spark, sf_dir, find_follower_stream, "find_follower_stream")


# Fixed value: the session id given to every event when the whole stream is
# one state machine, as the original jobs key everything by one constant.
GLOBAL_SESSION = "all"


def q_neighbours_global_key(spark, sf_dir):
    """All telemetry as one race (one key for the whole table, the original
    jobs' keying): the hottest key possible, run by the split plan so that it
    still spreads over every core."""
    one_race = telemetry(spark, sf_dir).withColumn("session_id", F.lit(GLOBAL_SESSION))
    return track_neighbours(one_race, [DRIVER_TABLES_TARGET], num_partitions=_slices(spark))


def q_gaps(spark, sf_dir):
    return gaps(spark, sf_dir)


def q_gap_report(spark, sf_dir):
    return gap_report(gaps(spark, sf_dir))


def q_gap_csv(spark, sf_dir):
    return gap_csv(gaps(spark, sf_dir))


def q_follower_changes(spark, sf_dir):
    return follower_changes(neighbours(spark, sf_dir))


def q_adjacent_pairs(spark, sf_dir):
    return adjacent_pairs(neighbours(spark, sf_dir), every_pair())


def q_neighbours_stream(spark, sf_dir):
    """Neighbour tracking as a stream over ``events``, written to files and read back."""
    base = scratch_path(spark, "neighbours_stream")
    stream = kafka_layout_from_events(read_events(spark, sf_dir, stream=True))
    start_to_files(neighbours_stream(stream, [DRIVER_TABLES_TARGET]), f"{base}/out", f"{base}/checkpoint",
                   state_partitions=cores(spark)).awaitTermination()
    return spark.read.parquet(f"{base}/out")


def _telemetry_stream(spark, sf_dir, job, name):
    base = scratch_path(spark, name)
    stream = kafka_layout_from_events(read_events(spark, sf_dir, stream=True))
    with scoped_conf(spark, {"spark.sql.shuffle.partitions": cores(spark)}):
        q = job(stream, TelemetryOptions(target_ids=(DRIVER_TABLES_TARGET,)), f"{base}/checkpoint",
                path=f"{base}/out", fmt="parquet", available_now=True)
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out")


def q_follower_changes_stream(spark, sf_dir):
    """The follower-change job as a stream (the previous row's follower is kept
    in the neighbour state), written to files and read back."""
    return _telemetry_stream(spark, sf_dir, measure_gap_stream, "follower_changes_stream")


# -- patterns of named steps --------------------------------------------------------

MATCHED_COLUMNS = ["partition", "seq", "event_time", "event_driver_id", "me_lap", "follower_driver_id", "follower_car_position",
                   "leader_driver_id", "tracking"]


def _flat(matches: DataFrame, pattern) -> DataFrame:
    """The columns of every step's row side by side, named ``<step>_<column>``."""
    return matches.select("session_id", "target_id", *[
        F.col(f"{s.name}.{c}").alias(f"{s.name}_{c}") for s in pattern.steps for c in MATCHED_COLUMNS])


def q_pattern_pairs(spark, sf_dir):
    """Who passed whom as a two-step pattern whose second condition reads the first row."""
    return _flat(match_neighbours(neighbours(spark, sf_dir), PASSED), PASSED)


def q_pattern_three_steps(spark, sf_dir):
    """A follower that loses the place and has it back in the next row."""
    return _flat(match_neighbours(neighbours(spark, sf_dir), REPASSED), REPASSED)


def q_pattern_pairs_global_key(spark, sf_dir):
    """The two-step pattern with the whole table as one race: one key, many tasks."""
    return _flat(match_neighbours(q_neighbours_global_key(spark, sf_dir), PASSED), PASSED)


def _pattern_stream(spark, sf_dir, pattern, name):
    base = scratch_path(spark, name)
    stream = kafka_layout_from_events(read_events(spark, sf_dir, stream=True))
    rows = neighbours_stream(stream, [DRIVER_TABLES_TARGET], history=pattern.history)
    start_to_files(_flat(match_neighbours(rows, pattern), pattern), f"{base}/out", f"{base}/checkpoint",
                   state_partitions=cores(spark)).awaitTermination()
    return spark.read.parquet(f"{base}/out")


def q_pattern_pairs_stream(spark, sf_dir):
    """The same as a stream: the last output rows of a key are part of its state."""
    return _pattern_stream(spark, sf_dir, PASSED, "pattern_pairs_stream")


def q_pattern_three_steps_stream(spark, sf_dir):
    return _pattern_stream(spark, sf_dir, REPASSED, "pattern_three_steps_stream")


# -- streams in event order, any size of key ------------------------------------------

CHUNKS = 4


def _in_chunks(spark, sf_dir, base: str, displaced: bool, derive=kafka_layout_from_events) -> tuple[DataFrame, int]:
    """What ``derive`` makes of the events as a stream of ``CHUNKS`` micro-batches, one file each, and a chunk's
    length in seconds.

    The chunks follow in event time. ``displaced``: every fifth event comes one chunk late.
    """
    events = read_events(spark, sf_dir)
    span = events.agg(F.unix_seconds(F.min("ts").cast("timestamp")).alias("a"),
                      F.unix_seconds(F.max("ts").cast("timestamp")).alias("b")).first()
    length = 3600 * ((span.b - span.a) // (3600 * CHUNKS) + 1)  # whole hours, as the messages' times are
    chunk = F.floor((F.unix_seconds(F.date_trunc("hour", F.col("ts").cast("timestamp"))) - span.a + 3599) / length)
    if displaced:
        chunk = chunk + F.when(F.col("event_id") % 5 == 0, 1).otherwise(0)
    chunk = F.least(chunk, F.lit(CHUNKS - 1))
    for k in range(CHUNKS):
        derive(events.where(chunk == k)).coalesce(1).write.mode("append").parquet(f"{base}/chunks")
    schema = spark.read.parquet(f"{base}/chunks").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/chunks"), length


def q_click_late_rows(spark, sf_dir):
    """Clicks of which every fifth comes one chunk late: the windows with what was in time, and the late clicks
    with each window they were late for."""
    base = scratch_path(spark, "click_late_rows")
    stream, _ = _in_chunks(spark, sf_dir, base, displaced=True, derive=clicks_from_events)
    job = PaneWindows(spark, OPTS, f"{base}/out", f"{base}/state")
    (stream.writeStream.option("checkpointLocation", f"{base}/checkpoint").foreachBatch(job)
     .trigger(availableNow=True).start().awaitTermination())
    job.finish(CHUNKS - 1)
    late = job.late().select(F.lit("late").alias("kind"), "account_id", "window_start", "window_end",
                             F.lit(None).cast("long").alias("n"), F.col("raw").alias("text"), "seq")
    windows = job.windows().select(F.lit("window").alias("kind"), "account_id", "window_start", "window_end", "n",
                                   F.col("first_raw").alias("text"), F.lit(None).cast("long").alias("seq"))
    return late.unionByName(windows)


def q_neighbours_global_key_stream(spark, sf_dir):
    """All telemetry as one race in a stream of several micro-batches: each is cut into slices, and the race's
    state goes from one to the next in a versioned table."""
    base = scratch_path(spark, "neighbours_global_key_stream")
    stream, _ = _in_chunks(spark, sf_dir, base, displaced=False)
    one_race = stream.withColumn("value", F.regexp_replace(
        F.col("value").cast("string"), '"session_id":"[^"]*"', f'"session_id":"{GLOBAL_SESSION}"').cast("binary"))
    query, job = start_ordered_neighbours(one_race, [DRIVER_TABLES_TARGET], f"{base}/out", f"{base}/state",
                                          f"{base}/checkpoint", available_now=True, num_slices=_slices(spark))
    query.awaitTermination()
    return job.rows()


def q_neighbours_reordered_stream(spark, sf_dir):
    """A stream whose batches hold events out of order: they wait for the watermark and are taken in event order."""
    base = scratch_path(spark, "neighbours_reordered_stream")
    stream, length = _in_chunks(spark, sf_dir, base, displaced=True)
    query, job = start_ordered_neighbours(stream, [DRIVER_TABLES_TARGET], f"{base}/out", f"{base}/state", f"{base}/checkpoint",
                                          delay=f"{length + 3600} seconds", available_now=True, num_slices=_slices(spark))
    query.awaitTermination()
    job.finish(CHUNKS - 1)
    return job.rows()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "click_parse": q_click_parse,
    "click_authenticated": q_click_authenticated,
    "click_canonical": q_click_canonical,
    "click_skipped": q_click_skipped,
    "click_counts_sliding": q_click_counts_sliding,
    "click_counts_tumbling": q_click_counts_tumbling,
    "click_first_event": q_click_first_event,
    "ten_or_more": q_ten_or_more,
    "nine_or_less": q_nine_or_less,
    "console_counts": q_console_counts,
    "click_routes": q_click_routes,
    "click_counts_stream": q_click_counts_stream,
    "click_routes_stream": q_click_routes_stream,
    "click_first_event_stream": q_click_first_event_stream,
    "telemetry_decode": q_telemetry_decode,
    "telemetry_decode_stream": q_telemetry_decode_stream,
    "telemetry_quality": q_telemetry_quality,
    "telemetry_status": q_telemetry_status,
    "raw_dump": q_raw_dump,
    "neighbours": q_neighbours,
    "neighbours_split": q_neighbours_split,
    "neighbours_targets_table": q_neighbours_targets_table,
    "find_follower": q_find_follower,
    "find_follower_stream": q_find_follower_stream,
    "neighbours_global_key": q_neighbours_global_key,
    "gaps": q_gaps,
    "gap_report": q_gap_report,
    "gap_csv": q_gap_csv,
    "follower_changes": q_follower_changes,
    "adjacent_pairs": q_adjacent_pairs,
    "neighbours_stream": q_neighbours_stream,
    "follower_changes_stream": q_follower_changes_stream,
    "pattern_pairs": q_pattern_pairs,
    "pattern_three_steps": q_pattern_three_steps,
    "pattern_pairs_global_key": q_pattern_pairs_global_key,
    "pattern_pairs_stream": q_pattern_pairs_stream,
    "pattern_three_steps_stream": q_pattern_three_steps_stream,
    "neighbours_global_key_stream": q_neighbours_global_key_stream,
    "click_late_rows": q_click_late_rows,
    "neighbours_reordered_stream": q_neighbours_reordered_stream,
}
