"""Sinks and sources that the job tests do not reach."""

import glob

import pytest

from racestream.options import TelemetryOptions
from racestream.sinks.writers import batch_folder_writer, fan_out
from racestream.sources.telemetry import read_kafka


def _lines(path):
    out = []
    for f in glob.glob(f"{path}/part-*"):
        out += [x.rstrip("\n") for x in open(f)]
    return sorted(out)


def test_replayed_batch_is_not_duplicated(spark, tmpdir_path):
    df = spark.createDataFrame([("7",), ("8",)], "line string")
    write = batch_folder_writer(tmpdir_path, "Tenclickusers")
    write(df, 3)
    write(df, 3)  # the same micro-batch again, as after a failure
    assert _lines(f"{tmpdir_path}/bucket=Tenclickusers/batch_id=3") == ["7", "8"]


def test_fan_out_sends_every_branch(spark, tmpdir_path):
    df = spark.createDataFrame([(1, 12), (2, 3)], "account_id int, n long")
    seen = {}
    run = fan_out(
        {"high": lambda b: b.filter("n >= 10"), "low": lambda b: b.filter("n < 9")},
        {"high": lambda b, i: seen.setdefault("high", b.count()),
         "low": lambda b, i: seen.setdefault("low", b.count())})
    run(df, 0)
    assert seen == {"high": 1, "low": 1}


def test_kafka_source_needs_servers(spark):
    with pytest.raises(ValueError):
        read_kafka(spark, TelemetryOptions())


def test_kafka_source_without_connector(spark):
    with pytest.raises(RuntimeError, match="connector"):  # not on the classpath of the tests
        read_kafka(spark, TelemetryOptions(bootstrap_servers="localhost:1"))


def test_telemetry_settings_file(spark, tmpdir_path):
    path = f"{tmpdir_path}/t.properties"
    with open(path, "w") as fh:
        fh.write("KafkaPort:9093\nstartFromLatest:true\nDriverName=KIMI\nCheckpointDir:/x\nOther:1\n")
    opts = TelemetryOptions.from_properties(path, idle_timeout="1 hour")
    assert (opts.bootstrap_servers, opts.starting_offsets, opts.target_ids, opts.checkpoint_dir, opts.idle_timeout) == (
        "localhost:9093", "latest", ("KIMI",), "/x", "1 hour")
    with open(path, "w") as fh:
        fh.write("KafkaPort:many\n")
    assert TelemetryOptions.from_properties(path) == TelemetryOptions() == TelemetryOptions.from_properties(None)


def test_scratch_tables_can_be_cleared(spark):
    from racestream.session import clear_scratch, scratch_path
    from racestream.sinks.writers import path_exists

    path = scratch_path(spark, "test")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    clear_scratch(spark)
    assert not path_exists(spark, path)
