"""The click job as a stream: watermark, sliding windows, several sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from racestream.functions.time import instant_to_ntz, ntz_to_instant
from racestream.operators import clicks as C
from racestream.options import ClickOptions
from racestream.session import scoped_conf
from racestream.sinks.rolling import RollingPolicy, RollingSink
from racestream.sinks.writers import batch_folder_writer, console_writer, fan_out, require_matching_checkpoint


def with_event_time(clicks: DataFrame, opts: ClickOptions, ts: str = "ts") -> DataFrame:
    """Event time as ``TIMESTAMP`` (wall clock read as UTC) plus the watermark.

    The watermark sits on the source, before any filter, like a source that
    emits ``max time - delay`` for every record it reads.
    """
    dt = clicks.schema[ts].dataType.typeName()
    if dt == "timestamp_ntz":
        clicks = clicks.withColumn(ts, ntz_to_instant(F.col(ts)))
    return clicks.withWatermark(ts, opts.watermark_delay)


def with_end_marker(clicks: DataFrame, marker_dir: str) -> DataFrame:
    """The click stream together with the marker folder (see ``write_end_marker``)."""
    markers = clicks.sparkSession.readStream.schema(clicks.schema).parquet(marker_dir)
    return clicks.unionByName(markers)


def write_end_marker(spark: SparkSession, clicks: DataFrame, marker_dir: str, end: bool = True) -> None:
    """Say in ``marker_dir`` that the input has ended (``end=False``: only make the folder).

    The marker is an anonymous click of the year 9999. The watermark sits before
    the filter that drops it, so it moves past every window and closes them all;
    clicks that come later on the same checkpoint are late.
    """
    kind = clicks.schema["ts"].dataType
    row = spark.range(1 if end else 0).select(
        F.lit('{"user.accountId":%d}' % C.ANONYMOUS).alias("value"),
        F.to_timestamp(F.lit("9999-12-31 00:00:00")).cast(kind).alias("ts"), F.lit(-1).cast("long").alias("seq"))
    row.write.mode("append").parquet(marker_dir)


QUALITY_METRICS = "click_quality"


def windowed_counts_stream(clicks: DataFrame, opts: ClickOptions, ntz_output: bool = True,
                           observe: bool = True, first: bool = False, chained: bool = False) -> DataFrame:
    """Counts per account and window; a window is emitted once, when it closes.

    ``first``: with the raw text of the window's first click (``first_raw``).
    ``chained``: panes are aggregated first and then added up to windows, two
    stateful aggregations in one append query, which copies no click into its
    windows but drops a click once its pane is closed, also from windows that are
    still open (``streaming.panes`` has neither drawback).

    With ``observe``, every micro-batch reports how many clicks it skipped as
    unparsable or anonymous under ``observedMetrics['click_quality']`` in the
    query progress (no extra pass over the data).
    """
    parsed = C.parse_clicks(with_event_time(clicks, opts))
    if observe:
        parsed = parsed.observe(
            QUALITY_METRICS,
            F.count_if(C.is_unparsable()).alias("n_unparsable"),
            F.count_if(F.coalesce(C.is_anonymous(), F.lit(False))).alias("n_anonymous"))
    counts = (C.first_events if first else C.click_counts)(C.authenticated(parsed), opts, chained=chained)
    if ntz_output:
        counts = counts.withColumns({c: instant_to_ntz(F.col(c)) for c in ("window_start", "window_end")})
    return counts


def start_click_job(clicks: DataFrame, opts: ClickOptions, output_base: str, checkpoint: str,
                    available_now: bool = False, console: bool | None = None,
                    state_partitions: int | None = None, rolling: RollingPolicy | None = None) -> StreamingQuery:
    """Run the click job: every closed window goes to the high-count and the
    low-count text sinks (``Tenclickusers`` and ``Nineclickusers`` folders) and,
    when enabled, to the console. One state store serves all sinks. Batch ids
    belong to the checkpoint: a new one on existing output is refused.
    ``rolling``: the lines go into rolling parts (``sinks.rolling``, see ``click_sinks``) instead
    of a folder per batch."""
    require_matching_checkpoint(clicks.sparkSession, output_base, C.SINK_FOLDERS.values(), checkpoint)
    counts = windowed_counts_stream(clicks, opts)
    branches = {
        "ten": lambda b: C.as_lines(C.ten_or_more(b, opts)),
        "nine": lambda b: C.as_lines(C.nine_or_less(b, opts)),
    }
    folders = {"ten": C.SINK_FOLDERS[C.SINK_TEN_OR_MORE], "nine": C.SINK_FOLDERS[C.SINK_NINE_OR_LESS]}
    if rolling is None:
        writers = {k: batch_folder_writer(output_base, folder) for k, folder in folders.items()}
    else:
        writers = {k: RollingSink(clicks.sparkSession, output_base, folder, rolling) for k, folder in folders.items()}
    if opts.console_output if console is None else console:
        branches["console"] = lambda b: C.console_counts(b, opts)
        writers["console"] = console_writer()
    w = (counts.writeStream.outputMode("append")
         .option("checkpointLocation", checkpoint)
         .foreachBatch(fan_out(branches, writers)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=opts.trigger_interval)
    with scoped_conf(clicks.sparkSession, {"spark.sql.shuffle.partitions": state_partitions}):
        return w.start()


def click_sinks(spark: SparkSession, output_base: str, rolling: RollingPolicy = RollingPolicy()) -> dict[str, RollingSink]:
    """The rolling sinks of a click job by branch, to finish and read them."""
    return {name: RollingSink(spark, output_base, folder, rolling) for name, folder in C.SINK_FOLDERS.items()}
