"""End-to-end jobs, one per job of the original project, batch and stream.

Each takes an input frame (static or streaming) and a destination, builds the
chain of operators and starts the write. Only these functions and the sinks
start work; the operators themselves are lazy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from racestream.operators import clicks as C
from racestream.operators.gaps import CSV_COLUMNS, gap_csv, gap_report, with_gaps, without_gaps
from racestream.operators.neighbours import track_neighbours, track_neighbours_stream
from racestream.operators.patterns import follower_changes
from racestream.operators.telemetry import decode_telemetry, dump_bytes, status_lines
from racestream.options import ClickOptions, TelemetryOptions
from racestream.sinks.writers import console_writer, print_rows, refuse_existing, write_csv, write_text_dump
from racestream.streaming.clicks import start_click_job

# -- clicks ----------------------------------------------------------------------


def click_job_batch(clicks: DataFrame, opts: ClickOptions, output_base: str) -> None:
    """Click counts of a finite input: every window closes at the end of input.

    One pass, no cache: each window is tagged with the sinks it goes to and the
    lines are written partitioned by sink (one account id per line per window),
    in the layout of the stream: ``<base>/bucket=Tenclickusers/batch_id=0`` and
    ``<base>/bucket=Nineclickusers/batch_id=0``. Existing output is refused. The
    console branch, when enabled, prints every count.
    """
    refuse_existing(clicks.sparkSession, output_base, C.SINK_FOLDERS.values())
    counts = C.click_counts(C.authenticated(C.parse_clicks(clicks)), opts)
    folder = F.element_at(F.create_map(*[F.lit(x) for kv in C.SINK_FOLDERS.items() for x in kv]), F.col("sink"))
    (C.routed_lines(counts, opts)
     .select(folder.alias("bucket"), F.lit(0).alias("batch_id"), "line")
     .write.mode("append").partitionBy("bucket", "batch_id").text(output_base))
    if opts.console_output:
        print_rows(C.console_counts(counts, opts))


def click_job_stream(clicks: DataFrame, opts: ClickOptions, output_base: str,
                     checkpoint: str | None = None, available_now: bool = False) -> StreamingQuery:
    """The click job on an unbounded input (see ``streaming.clicks``).

    Checkpoint folder: the argument, else ``CheckpointDir`` of the settings,
    else ``_checkpoint`` in the output folder, so that a restart goes on where
    the last run ended.
    """
    checkpoint = checkpoint or opts.checkpoint_dir or f"{output_base.rstrip('/')}/_checkpoint"
    return start_click_job(clicks, opts, output_base, checkpoint, available_now=available_now)


# -- telemetry: batch ------------------------------------------------------------


def find_follower_job(messages: DataFrame, opts: TelemetryOptions) -> DataFrame:
    """Decode, track neighbours, three-line report with the gaps left null (the
    job prints the report before any gap step runs)."""
    return gap_report(without_gaps(_tracked(messages, opts)))


def _tracked(messages: DataFrame, opts: TelemetryOptions) -> DataFrame:
    """Decoded and tracked, batch or stream alike."""
    telemetry, targets = decode_telemetry(messages), opts.targets(messages.sparkSession)
    if messages.isStreaming:
        return track_neighbours_stream(telemetry, targets, idle_timeout=opts.idle_timeout)
    return track_neighbours(telemetry, targets)


def monitor_gap_job(messages: DataFrame, opts: TelemetryOptions) -> DataFrame:
    """Decode, track neighbours, gaps, three-line report."""
    return gap_report(with_gaps(_tracked(messages, opts)))


def monitor_gap_csv_job(messages: DataFrame, opts: TelemetryOptions, path: str) -> None:
    """Decode, track neighbours, gaps, then the 11-field CSV of complete rows."""
    rows = gap_csv(with_gaps(_tracked(messages, opts)))
    write_csv(rows, path)


def measure_gap_job(messages: DataFrame, opts: TelemetryOptions) -> DataFrame:
    """Decode, track neighbours, report each change of follower."""
    return follower_changes(_tracked(messages, opts))


def status_job(messages: DataFrame) -> DataFrame:
    """Decode and print one status line per record."""
    return status_lines(decode_telemetry(messages))


def validate_bytes_job(messages: DataFrame, path: str) -> None:
    """Dump raw messages as hexadecimal text, replacing the folder."""
    write_text_dump(dump_bytes(messages), path)


# -- telemetry: streams ----------------------------------------------------------


def _start(df: DataFrame, fmt: str, path: str | None, checkpoint: str, available_now: bool,
           processing_time: str) -> StreamingQuery:
    w = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if fmt == "console":
        w = w.foreachBatch(console_writer())
    else:
        w = w.format(fmt).option("path", path)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def monitor_gap_stream(messages: DataFrame, opts: TelemetryOptions, checkpoint: str,
                       path: str | None = None, fmt: str = "console", available_now: bool = False,
                       processing_time: str = "15 seconds") -> StreamingQuery:
    """The gap report as a stream (console by default, or text/parquet files)."""
    return _start(_report_lines(with_gaps(_tracked(messages, opts)), fmt), fmt, path, checkpoint, available_now,
                  processing_time)


def _report_lines(gaps: DataFrame, fmt: str) -> DataFrame:
    report = gap_report(gaps)
    return report.select(F.col("report").alias("value")) if fmt in ("text", "console") else report


def find_follower_stream(messages: DataFrame, opts: TelemetryOptions, checkpoint: str,
                         path: str | None = None, fmt: str = "console", available_now: bool = False,
                         processing_time: str = "15 seconds") -> StreamingQuery:
    """The neighbour report, gaps left null, as a stream (console by default)."""
    return _start(_report_lines(without_gaps(_tracked(messages, opts)), fmt), fmt, path, checkpoint, available_now,
                  processing_time)


def status_stream(messages: DataFrame, checkpoint: str, path: str | None = None, fmt: str = "console",
                  available_now: bool = False, processing_time: str = "15 seconds") -> StreamingQuery:
    """One status line per record as a stream (console by default)."""
    lines = status_job(messages)
    if fmt in ("text", "console"):
        lines = lines.select(F.col("line").alias("value"))
    return _start(lines, fmt, path, checkpoint, available_now, processing_time)


def monitor_gap_csv_stream(messages: DataFrame, opts: TelemetryOptions, path: str, checkpoint: str,
                           available_now: bool = False,
                           processing_time: str = "15 seconds") -> StreamingQuery:
    """The gap CSV as a stream of CSV files, each with the header line once."""
    from racestream.sinks.writers import csv_header_names

    rows = gap_csv(with_gaps(_tracked(messages, opts)))
    out = rows.select(*[F.col(c).alias(h) for c, h in zip(CSV_COLUMNS, csv_header_names())])
    w = (out.writeStream.format("csv").option("header", True).outputMode("append")
         .option("path", path).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def measure_gap_stream(messages: DataFrame, opts: TelemetryOptions, checkpoint: str,
                       path: str | None = None, fmt: str = "console", available_now: bool = False,
                       processing_time: str = "15 seconds") -> StreamingQuery:
    """Follower changes as a stream; the previous row's follower is kept in the
    neighbour state, since row-based ``lag`` is not available on streams."""
    return _start(follower_changes(_tracked(messages, opts)), fmt, path, checkpoint, available_now, processing_time)
