"""End-to-end jobs on the driver's smallest tables and on fixtures."""

import glob
import os

from pyspark.sql import functions as F

from racestream.options import TEST, TelemetryOptions
from racestream.plans import jobs
from racestream.plans.queries import DRIVER_TABLES_TARGET, messages
from racestream.schemas import CLICK_SCHEMA
from racestream.sources.clicks import clicks_from_events, read_events
from tests.test_clicks import click

SMALL = "/root/testdata/sf0.001"
OPTS = TelemetryOptions(target_ids=(DRIVER_TABLES_TARGET,))


def _lines(path):
    out = []
    for f in glob.glob(f"{path}/part-*"):
        out += [x.rstrip("\n") for x in open(f)]
    return sorted(out)


def test_click_job_batch(spark, tmpdir_path):
    rows = [click(99, 10 * i, i) for i in range(10)] + [click(88, 100, 20)]
    jobs.click_job_batch(spark.createDataFrame(rows, CLICK_SCHEMA), TEST.replace(console_output=False),
                         tmpdir_path)
    assert _lines(f"{tmpdir_path}/bucket=Tenclickusers/batch_id=0") == ["99"]
    assert _lines(f"{tmpdir_path}/bucket=Nineclickusers/batch_id=0") == ["88"]


def test_click_job_on_driver_tables(spark, tmpdir_path):
    from racestream.options import DRIVER_TABLES
    jobs.click_job_batch(clicks_from_events(read_events(spark, SMALL)), DRIVER_TABLES, tmpdir_path)
    assert len(_lines(f"{tmpdir_path}/bucket=Nineclickusers/batch_id=0")) > 0


def test_telemetry_jobs(spark, tmpdir_path):
    msgs = messages(spark, SMALL)
    follow = jobs.find_follower_job(msgs, OPTS).collect()
    monitor = jobs.monitor_gap_job(msgs, OPTS).collect()
    assert len(follow) == len(monitor) > 0
    assert all("by nullm or by nulls" in r.report for r in follow)
    changes = jobs.measure_gap_job(msgs, OPTS).collect()
    assert all(r.message.startswith("Pattern Detected:") for r in changes)
    assert jobs.status_job(msgs).count() == msgs.filter("value LIKE '%race_number%'").count()
    jobs.monitor_gap_csv_job(msgs, OPTS, f"{tmpdir_path}/csv")
    assert glob.glob(f"{tmpdir_path}/csv/*.csv")
    jobs.validate_bytes_job(msgs, f"{tmpdir_path}/bytes")
    assert len(_lines(f"{tmpdir_path}/bytes")) == msgs.count()


def test_measure_gap_stream_to_files(spark, tmpdir_path):
    src = f"{tmpdir_path}/src"
    messages(spark, SMALL).write.parquet(src)
    schema = spark.read.parquet(src).schema
    stream = spark.readStream.schema(schema).parquet(src)
    q = jobs.measure_gap_stream(stream, OPTS, f"{tmpdir_path}/ckpt", path=f"{tmpdir_path}/out",
                                fmt="parquet", available_now=True)
    q.awaitTermination()
    got = spark.read.parquet(f"{tmpdir_path}/out").count()
    assert got == jobs.measure_gap_job(messages(spark, SMALL), OPTS).count()


def test_gap_csv_stream_and_targets_table(spark, tmpdir_path):
    src = f"{tmpdir_path}/src"
    messages(spark, SMALL).write.parquet(src)
    schema = spark.read.parquet(src).schema
    stream = spark.readStream.schema(schema).parquet(src)
    q = jobs.monitor_gap_csv_stream(stream, OPTS, f"{tmpdir_path}/csv", f"{tmpdir_path}/ckpt",
                                    available_now=True)
    q.awaitTermination()
    files = glob.glob(f"{tmpdir_path}/csv/part-*.csv")
    assert files and all(open(f).readline().startswith("Race,MyDriver") for f in files)
    got = spark.read.option("header", True).csv(f"{tmpdir_path}/csv").count()
    from racestream.operators.gaps import gap_csv, with_gaps
    from racestream.operators.neighbours import track_neighbours, track_neighbours_stream
    from racestream.operators.telemetry import decode_telemetry
    want = gap_csv(with_gaps(track_neighbours(decode_telemetry(messages(spark, SMALL)),
                                              [DRIVER_TABLES_TARGET]))).count()
    assert got == want
    # a static targets table joined to the stream
    sessions = decode_telemetry(messages(spark, SMALL)).select("session_id").distinct().limit(3)
    targets = sessions.withColumn("target_id", F.lit(DRIVER_TABLES_TARGET))
    stream2 = spark.readStream.schema(schema).parquet(src)
    q2 = (track_neighbours_stream(decode_telemetry(stream2), targets).writeStream.format("parquet")
          .option("path", f"{tmpdir_path}/n").option("checkpointLocation", f"{tmpdir_path}/c2")
          .trigger(availableNow=True).start())
    q2.awaitTermination()
    n = spark.read.parquet(f"{tmpdir_path}/n")
    keep = [r.session_id for r in targets.collect()]
    batch = track_neighbours(decode_telemetry(messages(spark, SMALL)), [DRIVER_TABLES_TARGET]).filter(
        F.col("session_id").isin(keep))
    assert n.count() == batch.count() > 0


def test_telemetry_stream_reports_dropped_messages(spark, tmpdir_path):
    from racestream.streaming.telemetry import QUALITY_METRICS, neighbours_stream, start_to_files
    src = f"{tmpdir_path}/src"
    msgs = messages(spark, SMALL)
    msgs.write.parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    q = start_to_files(neighbours_stream(stream, [DRIVER_TABLES_TARGET]), f"{tmpdir_path}/o", f"{tmpdir_path}/c")
    q.awaitTermination()
    seen = [p["observedMetrics"][QUALITY_METRICS] for p in q.recentProgress
            if p.get("observedMetrics", {}).get(QUALITY_METRICS)]
    dropped = msgs.filter("value IS NULL OR value NOT LIKE '%race_number%'").count()
    assert sum(m["n_messages"] for m in seen) == msgs.count()
    assert sum(m["n_dropped"] for m in seen) == dropped > 0


def test_click_job_stream_checkpoint_from_settings(spark, tmpdir_path):
    rows = [click(99, 10 * i, i) for i in range(10)] + [click(1, 3_600_000, 50)]
    src = f"{tmpdir_path}/clicks"
    spark.createDataFrame(rows, CLICK_SCHEMA).write.parquet(src)
    opts = TEST.replace(console_output=False, checkpoint_dir=f"{tmpdir_path}/from_settings")
    stream = spark.readStream.schema(CLICK_SCHEMA).parquet(src)
    jobs.click_job_stream(stream, opts, f"{tmpdir_path}/out", available_now=True).awaitTermination()
    assert os.path.isdir(f"{tmpdir_path}/from_settings/offsets")
    assert any(_lines(p) == ["99"] for p in glob.glob(f"{tmpdir_path}/out/bucket=Tenclickusers/batch_id=*"))


def _click_stream(spark, src):
    return spark.readStream.schema(CLICK_SCHEMA).parquet(src)


def test_restart_keeps_earlier_lines(spark, tmpdir_path):
    import pytest

    src, out = f"{tmpdir_path}/clicks", f"{tmpdir_path}/out"
    opts = TEST.replace(console_output=False)
    hour = 3_600_000
    for k, account in enumerate((99, 77)):
        rows = [click(account, k * hour + 10 * i, 100 * k + i) for i in range(10)] + [click(1, (k + 1) * hour, 100 * k + 50)]
        spark.createDataFrame(rows, CLICK_SCHEMA).write.mode("append").parquet(src)
        jobs.click_job_stream(_click_stream(spark, src), opts, out, available_now=True).awaitTermination()
    lines = [x for p in glob.glob(f"{out}/bucket=Tenclickusers/batch_id=*") for x in _lines(p)]
    assert sorted(lines) == ["77", "99"]
    # a new checkpoint would count batches from 0 again and replace them
    with pytest.raises(ValueError, match="another run"):
        jobs.click_job_stream(_click_stream(spark, src), opts, out, f"{tmpdir_path}/new", available_now=True)
    with pytest.raises(ValueError, match="another run"):
        jobs.click_job_batch(spark.read.parquet(src), opts, out)
    assert sorted(x for p in glob.glob(f"{out}/bucket=Tenclickusers/batch_id=*") for x in _lines(p)) == ["77", "99"]


def test_late_clicks_are_dropped_per_window(spark, tmpdir_path):
    from racestream.streaming.clicks import windowed_counts_stream, with_end_marker, write_end_marker

    src, marker = f"{tmpdir_path}/clicks", f"{tmpdir_path}/marker"
    minute = 60_000
    batches = [[click(5, 0, 1), click(5, 25 * minute, 2)],   # the watermark reaches minute 24
               [click(5, 5 * minute, 3), click(5, 24 * minute, 4)]]  # late for [0, 10); in time for [20, 30)
    for k, rows in enumerate([*batches, []]):
        if rows:
            spark.createDataFrame(rows, CLICK_SCHEMA).write.mode("append").parquet(src)
        write_end_marker(spark, spark.read.schema(CLICK_SCHEMA).parquet(src), marker, end=not rows)
        counts = windowed_counts_stream(with_end_marker(_click_stream(spark, src), marker), TEST, ntz_output=False)
        (counts.writeStream.format("parquet").option("path", f"{tmpdir_path}/o").option("checkpointLocation", f"{tmpdir_path}/c")
         .trigger(availableNow=True).start().awaitTermination())
    got = {(r.window_start.minute, r.n) for r in spark.read.parquet(f"{tmpdir_path}/o").collect()}
    assert got == {(0, 1), (20, 2)}


def test_every_row_reaches_the_console(spark, tmpdir_path):
    from racestream.sinks.writers import console_writer, print_rows

    path = f"{tmpdir_path}/console"

    def emit(text):  # what a row prints, kept where the test can read it
        with open(path, "a") as fh:
            fh.write(text + "\n")

    df = spark.range(25).selectExpr("id AS account_id", "id * 2 AS n")
    print_rows(df, emit)
    assert sorted(open(path)) == sorted(f"account_id={i}, n={2 * i}\n" for i in range(25))
    src = f"{tmpdir_path}/src"
    df.selectExpr("cast(n AS string) AS value").write.parquet(src)
    stream = spark.readStream.schema("value string").parquet(src)
    (stream.writeStream.foreachBatch(console_writer(emit)).option("checkpointLocation", f"{tmpdir_path}/c")
     .trigger(availableNow=True).start().awaitTermination())
    assert len(list(open(path))) == 50


def test_console_jobs_run(spark, tmpdir_path):
    rows = [click(100 + i, i, i) for i in range(25)]
    jobs.click_job_batch(spark.createDataFrame(rows, CLICK_SCHEMA), TEST.replace(console_output_count_threshold=1),
                         f"{tmpdir_path}/batch")
    src = f"{tmpdir_path}/src"
    messages(spark, SMALL).write.parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    for job in (jobs.find_follower_stream, jobs.monitor_gap_stream, jobs.measure_gap_stream):
        job(stream, OPTS, f"{tmpdir_path}/{job.__name__}", available_now=True).awaitTermination()
    jobs.status_stream(stream, f"{tmpdir_path}/status", available_now=True).awaitTermination()
