"""Click operators: parse, filter, windowed counts, routing by count."""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame, Observation, functions as F

from racestream.functions.json import canonical_json, int32_or_null, json_number
from racestream.options import ClickOptions

ANONYMOUS = -1

SINK_TEN_OR_MORE = "ten_or_more"
SINK_NINE_OR_LESS = "nine_or_less"
SINK_CONSOLE = "console"

# The bucket folder of each file sink, as the job names them.
SINK_FOLDERS = {SINK_TEN_OR_MORE: "Tenclickusers", SINK_NINE_OR_LESS: "Nineclickusers"}


def parse_clicks(clicks: DataFrame, canonical: bool = False) -> DataFrame:
    """(value, ts, seq) -> (seq, ts, raw, account_id); account_id null if unparsable.

    ``canonical``: ``raw`` is the body written anew (``canonical_json``) instead of as it came,
    null where the body is no JSON document.

    The body is parsed once: the parsed number goes through a one-element array
    and ``inline``, so neither the range check (which reads it three times) nor
    a later filter on ``account_id`` (which Catalyst pushes down) copies
    ``from_json``. Measured about 25% faster than the plain projection.
    """
    parsed = clicks.select("seq", "ts", "value",
                           F.inline(F.array(F.struct(json_number(F.col("value")).alias("_d")))))
    # only the parsed number goes through the generator: the other columns stay
    # outside it, where column pruning still drops the ones a query does not use
    raw = canonical_json(F.col("value")) if canonical else F.col("value")
    return parsed.select("seq", "ts", raw.alias("raw"),
                         int32_or_null(F.col("_d")).alias("account_id"))


def is_unparsable() -> Column:
    return F.col("account_id").isNull()


def is_anonymous() -> Column:
    return F.col("account_id") == F.lit(ANONYMOUS)


def authenticated(parsed: DataFrame) -> DataFrame:
    """Keep clicks of known users: drops the anonymous id -1 and unparsable rows."""
    return parsed.filter(F.col("account_id").isNotNull() & ~is_anonymous())


def skipped_counts(parsed: DataFrame) -> DataFrame:
    """One row: clicks dropped as unparsable, as anonymous, and clicks kept."""
    return parsed.agg(
        F.count_if(is_unparsable()).cast("long").alias("n_unparsable"),
        F.count_if(F.coalesce(is_anonymous(), F.lit(False))).cast("long").alias("n_anonymous"),
        F.count_if(F.col("account_id").isNotNull() & ~is_anonymous()).cast("long").alias("n_kept"),
    )


def observe_skipped(parsed: DataFrame, name: str = "click_quality"):
    """Attach skip counters that fill in as a side effect of the next action.

    Works in batch and in streams (one value per micro-batch), at no extra pass.
    """
    obs = Observation(name)
    observed = parsed.observe(
        obs,
        F.count_if(is_unparsable()).alias("n_unparsable"),
        F.count_if(F.coalesce(is_anonymous(), F.lit(False))).alias("n_anonymous"),
    )
    return observed, obs


def _window(opts: ClickOptions, ts: Column) -> Column:
    if opts.tumbling:
        return F.window(ts, opts.window_duration)
    return F.window(ts, opts.window_duration, opts.slide_duration)


def _panes(authed: DataFrame, opts: ClickOptions, ts: str, aggregates: list[Column]) -> DataFrame:
    """Aggregates per account and pane, a pane being the greatest common divisor of size and slide, so that every
    window is a whole number of panes."""
    size, slide = opts.window_size_mins * 60, opts.window_slide_secs
    pane = F.window(ts, f"{gcd(size, slide)} seconds")
    return authed.groupBy(F.col("account_id"), pane.alias("pane")).agg(*aggregates)


def into_windows(rows: DataFrame, opts: ClickOptions, at: Column) -> DataFrame:
    """Rows copied into each window that covers the time ``at``, with ``window_start`` and ``window_end``.

    By ``explode`` and not by a sliding ``window``: the generator keeps the rows' partitioning, an expansion loses it.
    """
    size, slide = opts.window_size_mins * 60, opts.window_slide_secs
    seconds = lambda n: F.expr(f"INTERVAL '{n}' SECOND")
    latest = F.window(at, opts.slide_duration)["start"]  # the last window that covers it
    starts = F.transform(F.sequence(F.lit(0), F.lit((size - 1) // slide)), lambda k: F.col("_latest") - k * seconds(slide))
    return (rows.withColumn("_latest", latest)
            .withColumn("window_start", F.explode(F.filter(starts, lambda w: w > at - seconds(size))))
            .withColumn("window_end", F.col("window_start") + seconds(size)).drop("_latest"))


def _windows_of(panes: DataFrame, opts: ClickOptions, aggregates: list[Column]) -> DataFrame:
    """Aggregates of the panes per account and window.

    Batch: the pane rows are brought together by account, and their copies into the windows are made and
    aggregated there, so no copy is shuffled. Streams: a second stateful aggregation in the same query.
    """
    if panes.isStreaming:
        windows = (panes.groupBy(F.col("account_id"), _window(opts, F.window_time("pane")).alias("window")).agg(*aggregates))
        return windows.withColumns({"window_start": F.col("window.start"), "window_end": F.col("window.end")})
    copies = into_windows(panes.repartition("account_id"), opts, F.col("pane.start"))
    return copies.groupBy("account_id", "window_start", "window_end").agg(*aggregates)


def _direct(authed: DataFrame, opts: ClickOptions, ts: str, aggregates: list[Column]) -> DataFrame:
    """Aggregates per account and window straight from the clicks."""
    return (authed.groupBy(F.col("account_id"), _window(opts, F.col(ts)).alias("window")).agg(*aggregates)
            .withColumns({"window_start": F.col("window.start"), "window_end": F.col("window.end")}))


def click_counts(authed: DataFrame, opts: ClickOptions, ts: str = "ts", chained: bool = True) -> DataFrame:
    """Clicks per account in each event-time window that holds at least one click.

    Windows are half-open and aligned to the epoch; an event is counted in every
    window that covers it. Clicks are counted per pane first (partial counts are
    combined map-side, so a hot account costs one row per pane and map task), then
    the panes are added up per window: no click is copied into its windows.

    In streams a pane closes when the watermark passes its end: a click that comes
    later is dropped from all its windows, also from those still open. With
    ``chained=False`` it counts in the open ones (each click is copied into its windows).
    """
    one = [F.count(F.lit(1)).alias("n")]
    if opts.tumbling or not chained:  # a tumbling window is a pane
        counts = _direct(authed, opts, ts, one)
    else:
        counts = _windows_of(_panes(authed, opts, ts, one), opts, [F.sum("n").alias("n")])
    return counts.select("account_id", "window_start", "window_end", "n")


def first_events(authed: DataFrame, opts: ClickOptions, ts: str = "ts", chained: bool = True) -> DataFrame:
    """Counts with the raw text of each window's first click (by event time, then seq).

    Panes as in ``click_counts``: each pane has one text, and the clicks' texts are
    never copied into each window. Batch and streams (in append mode) alike.
    """
    first = F.struct(F.col(ts).alias("ts"), F.col("seq"), F.col("raw"))
    aggregates = [F.count(F.lit(1)).alias("n"), F.min(first).alias("first")]
    if chained:
        windows = _windows_of(_panes(authed, opts, ts, aggregates), opts, [F.sum("n").alias("n"), F.min("first").alias("first")])
    else:
        windows = _direct(authed, opts, ts, aggregates)
    return windows.select("account_id", "window_start", "window_end", "n", F.col("first.raw").alias("first_raw"))


def ten_or_more(counts: DataFrame, opts: ClickOptions) -> DataFrame:
    """Windows with at least ``ten_or_more_threshold`` clicks."""
    return counts.filter(F.col("n") >= opts.ten_or_more_threshold)


def nine_or_less(counts: DataFrame, opts: ClickOptions) -> DataFrame:
    """Windows with fewer than ``nine_or_less_threshold`` clicks (strictly less).

    Independent of ``ten_or_more``: with thresholds 10 and 9 a count of exactly 9
    goes to neither branch; with 6 and 9, counts 6 to 8 go to both.
    """
    return counts.filter(F.col("n") < opts.nine_or_less_threshold)


def console_counts(counts: DataFrame, opts: ClickOptions) -> DataFrame:
    """Windows shown on the console: at least ``console_output_count_threshold`` clicks."""
    return counts.filter(F.col("n") >= opts.console_output_count_threshold)


def as_lines(counts: DataFrame) -> DataFrame:
    """One text line per window: the account id as text."""
    return counts.select("window_start", "window_end",
                         F.col("account_id").cast("string").alias("line"))


def routes(counts: DataFrame, opts: ClickOptions) -> dict[str, DataFrame]:
    """Every branch of the click job, each seeing every window."""
    out = {
        SINK_TEN_OR_MORE: as_lines(ten_or_more(counts, opts)),
        SINK_NINE_OR_LESS: as_lines(nine_or_less(counts, opts)),
    }
    if opts.console_output:
        out[SINK_CONSOLE] = console_counts(counts, opts)
    return out


def routed_lines(counts: DataFrame, opts: ClickOptions) -> DataFrame:
    """Both file branches in one frame, labelled by sink.

    One pass over ``counts``: each window is tagged with the sinks whose
    predicate holds (zero, one or both) and exploded, instead of a union of two
    filters that would evaluate the aggregate twice.
    """
    n = F.col("n")
    tags = F.array(
        F.when(n >= opts.ten_or_more_threshold, F.lit(SINK_TEN_OR_MORE)),
        F.when(n < opts.nine_or_less_threshold, F.lit(SINK_NINE_OR_LESS)),
    )
    return counts.select(
        F.explode(F.filter(tags, lambda t: t.isNotNull())).alias("sink"),
        "window_start", "window_end", F.col("account_id").cast("string").alias("line"))
