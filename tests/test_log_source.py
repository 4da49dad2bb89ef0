"""The log source: offsets per partition, starts, bounds, restarts."""

import datetime as dt
import time

from pyspark.sql import functions as F

from racestream.sources.log import LogFiles, LogStreamReader, append_log, bounded, read_log

LAYOUT = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp_ntz, timestampType int"
T0 = dt.datetime(2024, 3, 1, 12, 0, 0, 123456)


def some(spark, lo, hi, partitions=3):
    rows = [(b"k" if o % 2 else None, None if o % 7 == 0 else f"{p}/{o}\n\xe9".encode(), "t", p, o, T0 + dt.timedelta(seconds=o), 0)
            for p in range(partitions) for o in range(lo, hi + p)]
    return spark.createDataFrame(rows, LAYOUT)


def plain(df):
    return sorted((tuple(r) for r in df.select("key", "value", "partition", "offset", "timestamp").collect()), key=lambda r: r[2:])


def test_batch_reads_what_was_written(spark, tmpdir_path):
    df = some(spark, 0, 50)
    append_log(df, f"{tmpdir_path}/log", segments=7)
    got = read_log(spark, f"{tmpdir_path}/log", topic="t")
    assert plain(got) == plain(df) and got.first().topic == "t"
    assert got.rdd.getNumPartitions() >= 7  # a partition is read by many tasks
    assert read_log(spark, f"{tmpdir_path}/none").collect() == []


def run(spark, path, base, **options):
    q = (read_log(spark, path, stream=True, **options).writeStream.format("parquet").option("path", f"{base}/out")
         .option("checkpointLocation", f"{base}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    return plain(spark.read.parquet(f"{base}/out"))


def test_stream_resumes_at_its_offsets(spark, tmpdir_path):
    log = f"{tmpdir_path}/log"
    first, more = some(spark, 0, 30, 2), some(spark, 40, 60, 3)  # a gap in the offsets, and a new partition
    append_log(first, log, 3)
    assert run(spark, log, f"{tmpdir_path}/a") == plain(first)
    assert run(spark, log, f"{tmpdir_path}/a") == plain(first)  # nothing new
    append_log(more, log, 3)
    assert run(spark, log, f"{tmpdir_path}/a") == plain(first.unionByName(more))


def test_starting_offsets(spark, tmpdir_path):
    log = f"{tmpdir_path}/log"
    append_log(some(spark, 0, 20, 2), log, 2)
    run(spark, log, f"{tmpdir_path}/latest", startingOffsets="latest")
    append_log(some(spark, 30, 40, 2), log, 2)
    assert {r[3] for r in run(spark, log, f"{tmpdir_path}/latest", startingOffsets="latest")} == set(range(30, 41))
    given = run(spark, log, f"{tmpdir_path}/given", startingOffsets='{"0": 35}')
    assert min(r[3] for r in given if r[2] == 0) == 35 and min(r[3] for r in given if r[2] == 1) == 0


def test_bounded_batches_take_everything_once(spark, tmpdir_path):
    log = f"{tmpdir_path}/log"
    append_log(some(spark, 0, 25, 3), log, 4)
    reader = LogStreamReader(LogFiles(log), "earliest", 10)
    at, taken = reader.initialOffset(), 0
    while (end := reader.latestOffset()) != at:
        n = sum(s.end - s.start for s in reader.partitions(at, end))
        assert 0 < n <= 10
        at, taken = end, taken + n
    assert taken == 25 + 26 + 27
    assert bounded({"0": 0, "1": 0}, {"0": 100, "1": 1}, 5) == {"0": 5, "1": 0}
    assert bounded({"0": 3}, {"0": 4}, 5) == {"0": 4}
    for target in (40, 78):  # two starts; the second one is bounded too
        q = (read_log(spark, log, stream=True, maxOffsetsPerTrigger=10, progressPath=f"{tmpdir_path}/b/progress")
             .writeStream.format("parquet").option("path", f"{tmpdir_path}/b/out")
             .option("checkpointLocation", f"{tmpdir_path}/b/ck").trigger(processingTime="0 seconds").start())
        if target == 78:
            q.processAllAvailable()
        else:
            while not q.lastProgress or q.lastProgress.batchId < 2:
                time.sleep(0.1)
        q.stop()
        assert q.recentProgress and max(p.numInputRows for p in q.recentProgress) <= 10
    assert plain(spark.read.parquet(f"{tmpdir_path}/b/out")) == plain(some(spark, 0, 25, 3))
